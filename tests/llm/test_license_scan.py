import random

from pulse.llm.license_scan import NOTICES, LicenseScan, scan

from .brute import license_places

COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels"]


def _scan(spark, docs, **kw):
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    return {r["doc_id"]: r for r in scan(df, **kw).collect()}


def test_places_as_by_brute_force(spark, corpus):
    rng = random.Random(1)
    parts = ["GNU General Public License", "apache", "license", "MIT\nLicense", "CC-BY", "cc by cc by", "gnu general public", "x", "mit_license", "MIT licenses", "ccby"]
    docs = [*corpus, *((20_000 + i, ", ".join(rng.choices(parts, k=rng.randrange(1, 30)))) for i in range(60)), (30_000, "mit license " * 4000), (30_001, None)]
    for p in (LicenseScan(), LicenseScan(most_grams=0)):
        got = _scan(spark, docs, p=p)
        assert {i: tuple(got[i][c] for c in COLUMNS) for i, _ in docs} == {i: license_places(t) for i, t in docs}
        assert all(r["score"] == 1 for r in got.values() if r["n_base"])


def test_notices_with_insertions_and_gaps(spark):
    text, label = NOTICES[0]
    w = text.split()
    changed = " ".join(w[:20] + ["really", "and"] + w[20:40] + w[41:])
    half = " ".join(w[: len(w) // 3])
    got = _scan(spark, [(1, "before " + text + " after"), (2, changed), (3, half), (4, text.upper().replace(" ", "\n"))])
    assert [got[i]["labels"] for i in (1, 2, 3, 4)] == [label, label, "", label]
    assert got[1]["score"] == 1 and 0.6 <= got[2]["score"] < 1 and got[3]["score"] == 0
    assert all(r["base_labels"] == "" and r["n_base"] == 0 for r in got.values())


def test_repeated_rows_null_ids_empty_table(spark):
    rows = scan(spark.createDataFrame([(1, "cc by"), (1, "cc by"), (None, "mit license and cc by")], "doc_id bigint, text string")).collect()
    assert sorted((str(r["doc_id"]), r["labels"]) for r in rows) == [("1", "cc-by"), ("1", "cc-by"), ("None", "cc-by,mit")]
    assert scan(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
