import random

import numpy as np
import pyarrow as pa
import pytest

from pulse.llm.language_id import LanguageId, Model, Scorer, characters, fit, identify
from pulse.llm.text import blocks

SYLLABLES = {"aa": ["ba", "bo", "ka", "ti"], "bb": ["zu", "xi", "wo", "ti"], "cc": ["ñe", "éa", "üo", "ti"]}


def _say(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(2, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(8)
    return [(i, lang := rng.choice(list(SYLLABLES)), _say(rng, lang, rng.randrange(3, 60))) for i in range(400)]


def _block(texts):
    return next(blocks(iter([pa.record_batch([pa.array(texts)], names=["text"])]), "text"))


def test_characters():
    c, first = characters(_block(["A1b,,c", None, "", "É  ßx!", "123"]))
    got = ["".join(map(chr, c[a:b])) for a, b in zip(first[:-1], first[1:])]
    assert got == [" a b c", "", "", " é ßx ", " "] or got == [" a b c", " ", " ", " é ßx ", " "]


def test_model_is_a_distribution():
    rng = random.Random(1)
    counts = {}
    text = _say(rng, "aa", 300)
    for i in range(len(text) - 2):
        counts[text[i : i + 3]] = counts.get(text[i : i + 3], 0) + 1
    m = Model({"aa": counts}, 3)
    letters = sorted(set(text)) + ["#"]  # any unseen character has the floor's share
    for context in ["ba", "ti", "xx", " b"]:
        grams = np.array([[ord(x) for x in context + c] for c in letters], dtype=np.uint32)
        assert np.isclose((2 ** -m.score(grams)[:, 0]).sum(), 1, atol=1e-4)


def test_scorer_does_not_depend_on_its_memory():
    rng = random.Random(2)
    counts = {lang: {} for lang in SYLLABLES}
    for lang, c in counts.items():
        t = _say(rng, lang, 200)
        for i in range(len(t) - 3):
            c[t[i : i + 4]] = c.get(t[i : i + 4], 0) + 1
    m = Model(counts, 4)
    texts = [_say(rng, lang, 30) for lang in SYLLABLES]
    a = Scorer(m).entropies(_block(texts))[0]
    small = Scorer(m, most=10)
    small.entropies(_block(texts[::-1]))
    assert np.allclose(a, small.entropies(_block(texts))[0], atol=1e-5)
    one = np.concatenate([Scorer(m).entropies(_block([t]))[0] for t in texts])
    assert np.allclose(a, one, atol=1e-5)


def test_held_out_accuracy_and_odd_texts(spark, spoken):
    train = spark.createDataFrame([r for r in spoken if r[0] % 4 != 2] + [(9000, None, "zzz"), (9001, "aa", None)], "doc_id bigint, lang string, text string")
    fitted = fit(train, LanguageId(calibrate_every=5))
    odd = [(5000, None, ""), (5001, None, None), (5002, None, "123 !?"), (5003, None, "b"), (5004, None, "日本語" * 30), (5005, None, "ba" * 200_000)]
    docs = spark.createDataFrame([*((i, lang, t) for i, lang, t in spoken if i % 4 == 2), *odd, odd[3]], "doc_id bigint, score string, text string")
    rows = identify(docs, fitted).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == docs.count()
    truth = {i: lang for i, lang, _ in spoken if i % 4 == 2}
    assert np.mean([got[i]["lang_pred"] == lang for i, lang in truth.items()]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert [got[i]["lang_pred"] for i in (5000, 5001, 5002)] == ["und"] * 3 and got[5000]["score"] == 0
    assert got[5003]["lang_pred"] in SYLLABLES and got[5005]["lang_pred"] == "aa"
    assert got[5004]["rejected"] and np.mean([got[i]["rejected"] for i in truth]) < 0.1


def test_nothing_to_learn_and_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, lang string, text string")
    assert fit(empty) is None
    docs = spark.createDataFrame([(1, "abc")], "doc_id bigint, text string")
    assert identify(docs, None).first()["lang_pred"] == "und"
    fitted = fit(spark.createDataFrame([(1, "aa", "ba bo ka ti ba bo")], "doc_id bigint, lang string, text string"), LanguageId(calibrate_every=1000))
    assert identify(docs.limit(0), fitted).collect() == []


def test_every_counted_gram_is_in_the_model(spark, spoken):
    """Whatever bound the shared costs have, a text's entropy is that of the model of all counts."""
    train = [(lang, t) for i, lang, t in spoken if i % 4 != 2]
    counts = {}
    for lang, t in train:
        t = " " + t
        for i in range(len(t) - 3):
            held = counts.setdefault(lang, {})
            held[t[i : i + 4]] = held.get(t[i : i + 4], 0) + 1
    m = Model(counts, 4)
    texts = [t for i, _, t in spoken if i % 4 == 2] + ["ba bo zuxi qqq ñe", "zzzz yyyy"]
    want = Scorer(m).entropies(_block(texts))[0].min(axis=1)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    train = spark.createDataFrame(train, "lang string, text string")
    for most in (30, 400_000):
        fitted = fit(train, LanguageId(most_grams=most, calibrate_every=10**9))
        rows = identify(docs, fitted).collect()
        assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
        got = {r["doc_id"]: r["cross_entropy"] for r in rows}
        assert np.allclose([got[i] for i in range(len(texts))], want, atol=1e-4)


def test_calibrating_texts_are_counted_too(spark):
    """A language whose only texts calibrate is learned."""
    train = spark.createDataFrame([("aa", "ba bo ka ti ba bo"), ("bb", "zu xi wo zu xi")], "lang string, text string")
    fitted = fit(train, LanguageId(calibrate_every=1))
    docs = spark.createDataFrame([(1, "ba bo ka"), (2, "zu xi wo")], "doc_id bigint, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in identify(docs, fitted).collect()} == {1: "aa", 2: "bb"}
