import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pulse.llm.packing import Packing, WordIds, pack_documents, plan
from pulse.llm.queries import tokenizer_path

ODD = [
    "", " ", "\n\n", "a", " lead", "trail ", "two  spaces   three", "tab\tand\nnew\r\nline", "nbsp  x", "it's they'll I'm", "<|endoftext|> in <|endoftext|>",
    "日本語 テキスト", "emoji 😀😀 x", "1234 56-78", "a  b", "x\x85y z", "\x1c \x1f q", "ends with space　", "  \n  mixed \t ws \n",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_ids_are_the_tokenizers(tokenizer, corpus):
    import pyarrow as pa

    from pulse.llm.text import blocks

    texts = ODD + [t or "" for _, t in corpus] + ODD
    encoder = WordIds(tokenizer_path())
    batch = pa.record_batch([pa.array(texts)], names=["text"])
    got = []
    for b in blocks(iter([batch]), "text", 500):
        ids, first = encoder.encode(b)
        got += [ids[x:y].tolist() for x, y in zip(first[:-1], first[1:])]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_and_places(spark, tokenizer, corpus):
    docs = [*corpus, *((20_000 + i, t) for i, t in enumerate(ODD)), corpus[0], (None, "no id"), (7777, "word " * 3000)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    p = Packing(tokenizer_path(), capacity=64)
    rows = pack_documents(df, p, with_ids=True).collect()
    want, total = defaultdict(list), 0
    for i, t in docs:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        total += len(ids)
        pieces = -(-len(ids) // 64)
        cut = [0] + [len(ids) - 64 * (pieces - 1) + 64 * k for k in range(pieces)]
        for k in range(pieces):
            part = ids[cut[k] : cut[k + 1]]
            want[i, k].append((cut[k], len(part), zlib.crc32(part.tobytes()), part.tolist()))
    got, places = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r["doc_id"], r["piece"]].append((r["start"], r["length"], r["ids_crc32"], r["ids"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for spots in places.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 64
    assert len(places) <= -(-total // 64) * 1.1 + 1


def _best_fit(lengths, capacity):
    """Number of sequences of best-fit decreasing, document by document."""
    import bisect

    rooms = []
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, n)
        room = rooms.pop(at) if at < len(rooms) else capacity
        bisect.insort(rooms, room - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_best_fit_over_documents(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.choice(np.arange(1, 1025), 120, replace=False) if seed else np.arange(1, 200)
    histogram = {int(k): int(rng.integers(1, 40)) for k in sizes}
    slots = plan(histogram, 1024)
    taken, spots = defaultdict(int), defaultdict(list)
    for length, first, count, sequence, offset in slots:
        assert first == taken[length]
        taken[length] += count
        for k in range(count):
            spots[sequence + k].append((offset, length))
    assert dict(taken) == histogram
    for s in spots.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(spots) == _best_fit([k for k, v in histogram.items() for _ in range(v)], 1024)


def test_plan_follows_lengths_not_documents():
    few = {n: 3 for n in range(1, 1025, 7)}
    many = {n: 3_000_000 for n in few}
    assert len(plan(many, 1024)) < 4 * len(plan(few, 1024))


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id bigint, text string"), Packing(tokenizer_path())).collect() == []


def test_words_tokenised_together_and_forgotten_by_halves(monkeypatch):
    import random

    from pulse.llm import packing
    from pulse.llm.text import blocks

    monkeypatch.setattr(packing, "REMEMBER", 300)
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdeé.,'\"1日") for _ in range(rng.randrange(1, 7)))
    encoder = WordIds(tokenizer_path())
    common = [word() for _ in range(40)]
    for _ in range(12):
        texts = ["".join(rng.choice([" ", "\n", "  ", "\n\n", "\t"]) + (rng.choice(common) if rng.random() < 0.6 else word()) for _ in range(60)) + rng.choice(["", " ", "\n\n "]) for _ in range(6)] + ["", " ", "x"]
        batch = pa.record_batch([pa.array(texts)], names=["text"])
        for block in blocks([batch], "text"):
            ids, first = encoder.encode(block)
            for i, text in enumerate(texts):
                want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
                assert ids[first[i] : first[i + 1]].tolist() == want
    assert len(encoder.keys) <= 600 and (encoder.keys[1:] > encoder.keys[:-1]).all()
