import numpy as np
import pyarrow as pa

from pulse.llm import text as tx

TEXTS = ["a b", None, "", " \t\n", "É x y", "word\x0bnext\x85more", "ABC abc", "x" * 50, "one"]


def _block(values, offset=0):
    batch = pa.record_batch([pa.array(values)], names=["text"]).slice(offset)
    return next(tx.blocks(iter([batch]), "text"))


def _words(values, **kw):
    b = _block(values)
    w = tx.find_words(b.buf, b.off, **kw)
    found = [b.buf[s:e].tobytes() for s, e in zip(w.start, w.end)]
    return [found[a:z] for a, z in zip(w.first[:-1], w.first[1:])], w


def test_words_are_those_of_the_pattern():
    got, _ = _words(TEXTS)
    assert got == [(t or "").encode().split() for t in TEXTS]


def test_words_do_not_depend_on_chunks(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [" ".join("w" * int(n) for n in rng.integers(1, 30, size=int(k))) for k in rng.integers(0, 40, size=60)]
    whole, w = _words(texts)
    monkeypatch.setattr(tx, "CHUNK_BYTES", 7)
    parts, v = _words(texts)
    assert parts == whole
    assert (w.hash == v.hash).all()


def test_equal_words_have_equal_hashes_and_others_do_not():
    got, w = _words(["alpha beta alpha", "beta", "Alpha"])
    flat = [x for g in got for x in g]
    by = {}
    for word, h in zip(flat, w.hash.tolist()):
        assert by.setdefault(word, h) == h
    assert len(set(by.values())) == len(by)
    assert tx.hash_bytes(b"beta") == by[b"beta"]
    assert _words(["Alpha"], lower=True)[1].hash[0] == by[b"alpha"]


def test_alnum_words():
    got, _ = _words(["GPL-2.0 (MIT) café_x 9"], sep=tx.NON_ALNUM, lower=True)
    assert got == [[b"GPL", b"2", b"0", b"MIT", "café".encode(), b"x", b"9"]]


def test_grams_by_content_and_inside_documents():
    _, w = _words(["a b c d", "b c d", "a b"])
    g, ok = tx.gram_hashes(w.hash, 3), tx.gram_starts(w.first, 3)
    assert ok.tolist() == [True, True, False, False, True, False, False]
    assert g[1] == g[4] and g[0] != g[1]
    assert tx.sequence_hash(w.hash[:2]) == tx.sequence_hash(w.hash[7:9])


def test_sliced_and_null_buffers():
    b = _block(["skip me", None, "kept here", None], offset=1)
    assert [b.text(i) for i in range(3)] == [b"", b"kept here", b""]


def test_blocks_hold_their_bound_or_one_document():
    batch = pa.record_batch([pa.array(["x" * 10, "y" * 100, "z", ""])], names=["text"])
    sizes = [(len(b), len(b.buf)) for b in tx.blocks(iter([batch]), "text", 20)]
    assert sizes == [(1, 10), (1, 100), (2, 1)]
