import random

import pytest


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def variant(rng, text, share):
    """The text with about this share of its words replaced."""
    return " ".join(f"v{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text): unrelated texts, copies, near copies, shared passages, odd cases."""
    rng = random.Random(5)
    out = []
    bases = [prose(rng, rng.choice([3, 6, 30, 80, 200]), 4000) for _ in range(12)]
    passage = prose(rng, 45, 10**6)
    for b in bases:
        out.append(b)
        for _ in range(rng.choice([0, 1, 6, 15])):
            out.append(variant(rng, b, rng.choice([0, 0.005, 0.02, 0.05, 0.1])))
    out += [prose(rng, 40, 10**6) + "\n" + passage + " " + prose(rng, 20, 10**6) for _ in range(8)]
    out += [passage, passage.upper(), "", " \n\t", None, None, "one two three", "one  two\nTHREE", "x " * 120, "Line a b\nLine a b\nother\n\n", prose(rng, 3000, 900)]
    rng.shuffle(out)
    ids = rng.sample(range(10_000), len(out))
    return list(zip(ids, out))


@pytest.fixture(scope="session")
def corpus_df(spark, corpus):
    return spark.createDataFrame(corpus, "doc_id bigint, text string").repartition(5)
