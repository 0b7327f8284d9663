"""pulse: popularity and virality analytics as Spark DataFrame jobs.

Tables (see ``pulse.schemas``):

* ``movies``              -- title dimension, one row per ``movie_id``
* ``snapshots``           -- daily time series, one row per (``movie_id``, ``snapshot_date``)
* ``metrics``             -- aggregated metrics, one row per (``movie_id``, ``calculation_date``)

Every operator is a plain function ``DataFrame(s) -> DataFrame`` built from
built-in Spark SQL expressions, so Catalyst sees one plan end to end.
"""

from pulse.config import DEFAULT_THRESHOLDS, Thresholds

__all__ = ["DEFAULT_THRESHOLDS", "Thresholds"]
