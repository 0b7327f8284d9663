"""The pipeline against a plain restatement, stage by stage on what the stage before kept."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from pulse.llm.quality_rules import QualityRules
from pulse.llm.queries import tokenizer_path
from pulse.llm.text import hash_bytes

from .brute import base_failed, components, quality_counts, shares, substring_dedup, words
from .conftest import variant

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _corpus():
    rng = random.Random(12)
    common = ["the", "of", "and", "to", "in"]

    def text(n):
        return " ".join(rng.choice(common) if rng.random() < 0.5 else f"w{rng.randrange(10**6)}x" for _ in range(n)) + "."

    docs = []
    shared = text(60)
    for i in range(160):
        kind = rng.random()
        if kind < 0.5 or not docs:
            t = text(rng.randrange(25, 160))
        elif kind < 0.65:
            t = variant(rng, rng.choice(docs) or "x", rng.choice([0, 0.01, 0.04]))
        elif kind < 0.75:
            t = text(40) + "\n" + shared + "\n" + text(30)
        elif kind < 0.85:
            t = " ".join(w.upper() + "***$$" for w in text(80).split())
        elif kind < 0.92:
            t = "again and again the same " * 30
        else:
            t = rng.choice([None, "", "too short", " ".join(["the"] * 400)])
        docs.append(t or "")
    ids = rng.sample(range(5000), len(docs))
    return [(i, t, rng.choice(["en", "en", None]), rng.choice(["hot", "hot", "a", "b", None]), len(t)) for i, t in zip(ids, docs)]


def _histogram(text):
    classes = Counter()
    for c in text:
        b = c.encode()[0]
        if b >= 0xC0:
            classes["other"] += 1
        elif c.islower():
            classes["lower"] += 1
        elif c.isupper():
            classes["upper"] += 1
        elif c.isdigit():
            classes["digit"] += 1
        elif c in " \t\n\x0b\x0c\r":
            classes["space"] += 1
        elif b < 0x20:
            classes["control"] += 1
        else:
            classes["stop" if c in ".,;:" else "quote" if c in "'\"()-" else "symbol"] += 1
    return classes, Counter(w.lower() for w in words(text))


def _distance(a, b):
    keys = set(a) | set(b)
    p, q = ({k: x.get(k, 0) / max(sum(x.values()), 1) for k in keys} for x in (a, b))
    m = {k: (p[k] + q[k]) / 2 for k in keys}
    kl = lambda x: sum(v * math.log2(v / m[k]) for k, v in x.items() if v)
    return math.sqrt(max((kl(p) + kl(q)) / 2, 0))


def _kept_by_quality(docs):
    rules = QualityRules()
    ref_classes, ref_words = Counter(), Counter()
    for _, t, lang, _, _ in docs:
        if lang == "en":
            c, w = _histogram(t)
            ref_classes += c
            ref_words += w
    signed = lambda w: int(np.array([hash_bytes(w.encode())], dtype=np.uint64).view(np.int64)[0])
    sure = set(sorted(ref_words, key=lambda w: (-ref_words[w], signed(w)))[: rules.common_words])
    out = []
    for d in docs:
        counts = quality_counts(d[1])
        if base_failed(counts):
            continue
        if counts[0] >= rules.min_words:
            c, w = _histogram(d[1])
            by = {k: n for k, n in w.items() if k in sure}
            ref = {k: n for k, n in ref_words.items() if k in sure}
            by[None], ref[None] = sum(w.values()) - sum(by.values()), sum(ref_words.values()) - sum(ref.values())
            a, b = _distance(c, ref_classes), _distance(by, ref)
            if a > rules.class_limit or b > rules.word_limit:
                continue
        out.append(d)
    return out


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = _corpus()
    folder = str(tmp_path_factory.mktemp("pipeline"))
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, folder)
        df.write.parquet(f"{folder}/{name}")
        df = spark.read.parquet(f"{folder}/{name}")
        out.append([tuple(r) for r in df.collect()])
        columns = df.columns
        if name != corpus_pipeline.STAGES[-1][0]:
            assert columns == ["doc_id", "text", "lang", "source", "n_chars"]
    return out


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "substring_dedup", "mixing", "best_fit_packing"]


def test_quality_stage(stages):
    assert Counter(stages[1]) == Counter(_kept_by_quality(stages[0]))
    assert 0 < len(stages[1]) < len(stages[0])


def test_jaccard_stage(stages):
    found = components([(d[0], d[1]) for d in stages[1]])
    assert Counter(stages[2]) == Counter(d for d in stages[1] if found[d[0]][1] == d[0])
    assert len(stages[2]) < len(stages[1])


def test_substring_stage(stages):
    found = substring_dedup(sorted((d[0], d[1]) for d in stages[2]))
    got = {d[0]: d for d in stages[3]}
    want = {d[0]: d for d in stages[2] if found[d[0]][1] < found[d[0]][0] or found[d[0]][0] == 0}
    assert got.keys() == want.keys()
    import hashlib

    for i, d in got.items():
        n, removed, digest = found[i]
        assert hashlib.sha256(" ".join(words(d[1])).encode()).hexdigest() == digest
        assert d[2:4] == want[i][2:4]
        assert d == want[i] if not removed else d[4] == len(d[1])
    assert any(found[i][1] for i in got)


def test_mixing_stage(stages):
    docs = Counter(stages[3])
    copies = Counter(stages[4])
    assert set(copies) <= set(docs) and all(n <= 3 * docs[d] for d, n in copies.items())
    size, taken = defaultdict(int), defaultdict(int)
    for d in stages[3]:
        size[d[3]] += len(words(d[1]))
    for d in stages[4]:
        taken[d[3]] += len(words(d[1]))
    ordered = sorted((s for s in size if s), key=str) + ([None] if None in size else [])
    want = shares(size, {s: float(i % 3 + 1) for i, s in enumerate(ordered)}, sum(size.values()), 3)
    longest = max(len(words(d[1])) for d in stages[3])
    assert all(abs(taken[s] - want[s]) <= longest for s in size)


def test_packing_stage(stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    want, places = Counter(), defaultdict(list)
    for d in stages[4]:
        ids = np.array([*tokenizer.encode(d[1] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        n = -(-len(ids) // 1024)
        cut = [0] + [len(ids) - 1024 * (n - 1 - k) for k in range(n)]
        for k in range(n):
            part = ids[cut[k] : cut[k + 1]]
            want[d[0], k, cut[k], len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter(r[:5] for r in stages[5]) == want
    for r in stages[5]:
        places[r[5]].append((r[6], r[3]))
    for spots in places.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 1024


def test_empty_documents_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
