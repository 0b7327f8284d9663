import random

import numpy as np
import pytest

from pulse.llm import suffix_dedup as module
from pulse.llm.suffix_dedup import SuffixDedup, remove_substrings
from pulse.llm.suffix_merge import merge, repeats, transform

from .brute import suffix_dedup
from .conftest import prose, variant


def _rows(df):
    order = lambda r: ((r[0] is None, r[0] or 0), r[1:])
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in df.collect()), key=order)


def _random_strings(rng, letter, n=60):
    base = bytes(rng.randrange(97, 101) for _ in range(90))
    parts = []
    for _ in range(n):
        s = bytes(rng.randrange(97, 100) for _ in range(rng.randrange(50, 120)))
        parts.append(s + base[: rng.randrange(50, 90)] if rng.random() < 0.5 else s)
    return parts, [x + b"\0" * (-len(x) % letter) for x in parts]


@pytest.mark.parametrize("letter", [1, 2, 5, 10])
@pytest.mark.parametrize("shard", [1, 400, 10**6])
def test_intervals_of_merged_transforms(letter, shard):
    parts, padded = _random_strings(random.Random(letter), letter)
    s, ends = np.frombuffer(b"".join(padded), np.uint8), np.cumsum([len(x) for x in padded])
    found = repeats(s, ends, 50, letter, shard)
    assert sorted(found.place.tolist()) == list(range(len(s)))
    text, begin = s.tobytes(), ends - [len(x) for x in padded]
    real = {b + i: text[b + i : b + i + 50] for b, x in zip(begin, parts) for i in range(len(x) - 49)}
    interval = dict(zip(found.place.tolist(), found.interval.tolist()))
    slots = [p for p in found.place.tolist() if p in real]
    windows = [real[p] for p in slots]
    assert windows == sorted(windows)
    by = {}
    for p, w in real.items():
        assert by.setdefault(w, interval[p]) == interval[p]
    assert len(set(by.values())) == len(by)


def test_merge_reads_transforms_only():
    """The classical form: letters of one byte, whole cycles sorted; the merge is their common order."""
    words = [b"mississippi", b"missouri__", b"ippimississ"]
    shards = []
    for w in words:
        n = len(w)
        codes = np.frombuffer(w, np.uint8).astype(np.int64)
        shards.append(transform(codes, (np.arange(n) + 1) % n, (np.arange(n) - 1) % n, 6))
    source, interval = merge(shards, 6)
    rows = sorted((((w * 3)[i : i + 6], k) for k, w in enumerate(words) for i in range(len(w))))
    assert [r[1] for r in rows] == source.tolist()
    want = np.cumsum([0] + [a[0] != b[0] for a, b in zip(rows, rows[1:])])
    assert want.tolist() == interval.tolist()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    passage = prose(rng, 30, 10**6)
    bases = [prose(rng, rng.choice([5, 30, 90]), 5000) for _ in range(10)]
    out = [variant(rng, b, rng.choice([0, 0.02, 0.1])) for b in bases for _ in range(rng.choice([1, 3, 9]))]
    out += [prose(rng, 12, 10**6) + " " + passage + " " + prose(rng, 9, 10**6) for _ in range(25)]
    out += [passage, "é" * 60 + passage, "", None, None, "x" * 49, "x" * 50, "x" * 51, "x" * 300, "ab" * 80, "ab" * 26, "\0" * 120, "\0" * 60, prose(rng, 2000, 300)]
    rng.shuffle(out)
    return list(zip(rng.sample(range(10**6), len(out)), out))


@pytest.mark.parametrize("p", [SuffixDedup(), SuffixDedup(shard_bytes=300, flush=50), SuffixDedup(warm_docs=2, hot_docs=8), SuffixDedup(letter=2, gram=8, warm_docs=1, hot_docs=1)])
def test_as_by_brute_force(spark, texts, p, monkeypatch):
    monkeypatch.setattr(module, "CHUNK", 1000)
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(5)
    got = _rows(remove_substrings(df, p))
    want = suffix_dedup(texts)
    assert sum(r[2] for r in want) > 5000 and got == want


def test_ties_nulls_and_clashing_columns(spark):
    rng = random.Random(2)
    a, b = prose(rng, 30, 10**6), prose(rng, 30, 10**6)
    rows = [(1, a), (1, a), (None, a), (None, b), (None, b), (-5, b[:80]), (2, b), (2, a[:60] + "|" + b)]
    df = spark.createDataFrame([(*r, "n", 7, "k") for r in rows], "doc_id bigint, text string, pack string, n_removed int, row string")
    out = remove_substrings(df)
    assert out.columns == ["doc_id", "pack", "row", "kept", "n_bytes", "n_removed", "n_spans"]
    assert _rows(out) == suffix_dedup(rows)
    assert {(r["pack"], r["row"]) for r in out.collect()} == {("n", "k")}


def test_empty_table(spark):
    assert remove_substrings(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_a_passage_in_most_documents_is_spread(spark, monkeypatch):
    """Windows over the borders of a hot passage differ, but share its fingerprints."""
    rng = random.Random(4)
    passage = prose(rng, 14, 10**6)
    rows = [(i, prose(rng, 15, 10**6) + " " + passage + " " + prose(rng, 15, 10**6)) for i in range(600)]
    n_blocks = module.SUB * 8
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    p = SuffixDedup(hot_docs=100)
    packs = module._stored_packs(df, "doc_id", "text")
    shared = module._shared(module._sent(packs, p, n_blocks), p, n_blocks)
    sizes = [len(r["data"]) for r in module._dealt(packs, shared, p, n_blocks).where(f"block < {n_blocks}").groupBy("block").agg({"data": "max"}).withColumnRenamed("max(data)", "data").collect()]
    assert max(sizes) < 20 * sum(sizes) / n_blocks
    assert _rows(remove_substrings(df, p)) == suffix_dedup(rows)
