"""The registered queries over the smallest supplied tables."""

import pytest

from pulse.llm.oracle import oracle_sql
from pulse.llm.queries import queries
from tests.oracle_harness import compare, duck_connection

SF = "/root/testdata/sf0.001"
COLUMNS = {
    1: ["doc_id", "held_out", "lang_pred", "score"],
    2: ["page_id", "host", "path", "rule", "verdict"],
    3: ["doc_id", "n_shingles", "component_id"],
    4: ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    5: ["doc_id", "size", "source_size", "target", "taken"],
    6: ["query_id", "rank", "vec_id", "score"],
    7: ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    8: ["doc_id", "held_out", "score", "predicted"],
    9: ["doc_id", "n_words", "n_removed", "kept_sha256"],
    10: ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    11: ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
    12: ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
    13: ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
}


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == sorted(COLUMNS)


@pytest.mark.parametrize("name", sorted(queries()))
def test_columns_and_rows(spark, name):
    df = queries()[name](spark, SF)
    assert set(COLUMNS[int(name[2:].split("_")[0])]) <= set(df.columns)
    if name not in oracle_sql():
        assert df.count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_as_by_sql(spark, name):
    ok, n, _, detail = compare(spark, name, queries()[name], oracle_sql()[name], SF, duck_connection(SF))
    assert ok and n > 0, detail
