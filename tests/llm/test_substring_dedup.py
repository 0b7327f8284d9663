import random

from pyspark.sql import functions as F

from pulse.llm.substring_dedup import SubstringDedup, SuffixAutomaton, joined_words, remove_repeats, repeated_letters, sliding_min

from .brute import substring_dedup


def _rows(df):
    out = df.select("doc_id", "n_words", "n_removed", F.sha2(joined_words(F.col("text")), 256).alias("h"))
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["h"]) for r in out.collect()}


def test_as_by_brute_force(corpus, corpus_df):
    want = substring_dedup(sorted(corpus))
    assert sum(x[1] for x in want.values()) > 1000
    assert _rows(remove_repeats(corpus_df)) == want
    # small parts: what a task finds alone and what shards find must come together
    assert _rows(remove_repeats(corpus_df, SubstringDedup(flush=50))) == want


def test_other_widths(corpus, corpus_df):
    p = SubstringDedup(window=7, route_words=3)
    assert _rows(remove_repeats(corpus_df, p)) == substring_dedup(sorted(corpus), 7)


def test_text_between_kept_words_stays(spark):
    shared = " ".join(f"s{i}" for i in range(25))
    docs = [(1, f"a  b\n{shared}\tc"), (2, f"d\n\ne {shared}  f\tg\n"), (3, None), (4, "")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("spans", F.lit(1)).withColumn("n_words", F.lit("x"))
    out = remove_repeats(df)
    assert out.columns == ["doc_id", "text", "spans", "n_words", "n_removed"]
    got = {r["doc_id"]: (r["text"], r["n_words"], r["n_removed"]) for r in out.collect()}
    assert got == {1: (f"a  b\n{shared}\tc", 28, 0), 2: ("d\n\ne f\tg\n", 29, 25), 3: (None, 0, 0), 4: ("", 0, 0)}


def test_repeated_rows_and_null_ids(spark):
    t = " ".join(f"s{i}" for i in range(30))
    docs = [(2, t), (2, t), (None, t), (1, t), (None, None)]
    out = remove_repeats(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3))
    got = sorted(str((r["doc_id"], r["n_words"], r["n_removed"])) for r in out.collect())
    assert got == sorted(map(str, [(1, 30, 0), (2, 30, 30), (2, 30, 30), (None, 30, 30), (None, 0, 0)]))
    alone = remove_repeats(spark.createDataFrame([(2, t), (2, t)], "doc_id bigint, text string").repartition(2))
    assert [r["n_removed"] for r in alone.collect()] == [0, 0]


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_automaton_accepts_exactly_the_substrings():
    rng = random.Random(3)
    for _ in range(30):
        seqs = [[rng.randrange(3) for _ in range(rng.randrange(1, 12))] for _ in range(4)]
        a = SuffixAutomaton()
        for s in seqs:
            last = 0
            for c in s:
                last = a.extend(last, c)
        have = {tuple(s[i:j]) for s in seqs for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        probe = [rng.randrange(4) for _ in range(40)]
        state = matched = 0
        for i, c in enumerate(probe):
            state, matched = a.step(state, matched, c)
            longest = max((n for n in range(i + 2) if tuple(probe[i + 1 - n : i + 1]) in have), default=0)
            assert matched == longest


def test_repeated_letters_and_sliding_min():
    assert repeated_letters([[1, 2, 3], [9, 2, 3, 4], [4, 4]]) == [[False] * 3, [False, True, True, False], [True, True]]
    import numpy as np

    a = np.random.default_rng(0).integers(0, 99, 60).astype(np.uint64)
    for width in (1, 2, 5, 8, 13):
        assert sliding_min(a, width).tolist() == [a[i : i + width].min() for i in range(60 - width + 1)]
