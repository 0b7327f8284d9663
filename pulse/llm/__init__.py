"""Operators of a training-data pipeline (see README, "Training-data operators").

Nothing outside this subpackage imports it; ``__spark_entry__`` registers its
queries when it is present.
"""
