"""Vectorised word and n-gram hashing over Arrow string buffers.

Spark hands whole texts to a task as Arrow batches (``mapInArrow``). The
functions here read the UTF-8 buffer of a batch in place: they find words,
hash each word to 64 bits and hash runs of k words, without a Python object
per word. Hashes depend on the bytes only, never on the position, batch or
worker, so equal words have equal hashes everywhere.

Memory: a batch is worked on in blocks of at most ``BLOCK_BYTES`` (one longer
document is a block of its own), and the character-level arrays exist only
for one chunk of ``CHUNK_BYTES`` at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 3 << 20
CHUNK_BYTES = 1 << 20

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1  # byte polynomial
_GRAM = 0xD1342543DE82EF95  # word polynomial

#: Bytes that separate words: space and \x09-\x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that separate alphanumeric words of lower-cased text: all ASCII but 0-9 and a-z.
NON_ALNUM = np.ones(256, dtype=bool)
NON_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class _Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (self._row(b, size) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _row(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, dtype=U64)
        out[0] = 1
        return np.multiply.accumulate(out)


_BYTES, _WORDS = _Powers(_BASE), _Powers(_GRAM)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (every input bit reaches every output bit)."""
    h = h.astype(U64, copy=True)
    h ^= h >> U64(30)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def mix_int(x: int) -> int:
    return int(mix(np.array([x & (2**64 - 1)], dtype=U64))[0])


def string_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its n + 1 offsets; a null is an empty run."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    kind = np.int64 if large else np.int32
    off = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:  # a null may own bytes: close the gap by copying
        valid = np.asarray(column.is_valid())
        lengths = np.diff(off) * valid
        if lengths.sum() != off[-1] - off[0]:
            parts = [buf[a : a + k] for a, k in zip(off[:-1], lengths) if k]
            buf = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
            return buf, np.concatenate([[0], np.cumsum(lengths)])
    return buf[off[0] : off[-1]], off - off[0]


@dataclass
class Block:
    """Some consecutive rows of a batch with the bytes of their texts."""

    rows: pa.RecordBatch
    buf: np.ndarray
    off: np.ndarray

    def __len__(self) -> int:
        return len(self.off) - 1

    def text(self, i: int) -> bytes:
        return self.buf[self.off[i] : self.off[i + 1]].tobytes()


def blocks(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut batches into blocks of at most ``max_bytes`` of text, or one longer document."""
    for batch in batches:
        buf, off = string_buffer(batch.column(batch.schema.get_field_index(text)))
        i, n = 0, batch.num_rows
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, side="right")) - 1)
            yield Block(batch.slice(i, j - i), buf[off[i] : off[j]], off[i : j + 1] - off[i])
            i = j


@dataclass
class Words:
    """Words of a block: 64-bit hash, byte range, and for each document its first word's index."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # n_docs + 1

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """The document index of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.count())


def find_words(buf: np.ndarray, off: np.ndarray, sep: np.ndarray = SPACE, lower: bool = False) -> Words:
    """All maximal runs of bytes outside ``sep``; no word spans two documents."""
    starts, ends, hashes = [], [], []
    at, n = 0, len(buf)
    while at < n:
        stop = min(n, at + CHUNK_BYTES)
        while stop < n:  # end the chunk at a separator or at a document's end
            near = min(n, stop + 4096)
            gap = np.flatnonzero(sep[LOWER[buf[stop:near]] if lower else buf[stop:near]])
            edge = off[np.searchsorted(off, stop)]
            found = min(stop + int(gap[0]) if len(gap) else n, int(edge))
            if found <= near:
                stop = found
                break
            stop = near
        s, e, h = _chunk_words(buf[at:stop], off, at, stop, sep, lower)
        starts.append(s)
        ends.append(e)
        hashes.append(h)
        at = stop
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    start, end, hash_ = join(starts, np.int64), join(ends, np.int64), join(hashes, U64)
    return Words(hash_, start, end, np.searchsorted(start, off))


def _chunk_words(b, off, at, stop, sep, lower):
    if lower:
        b = LOWER[b]
    inside = ~sep[b]
    lo, hi = np.searchsorted(off, at), np.searchsorted(off, stop, side="right")
    cuts = off[lo:hi] - at  # document borders in the chunk
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    c = cuts[cuts < len(b)]
    begin[c] = inside[c]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:]
    c = cuts[cuts > 0] - 1
    finish[c] = inside[c]
    s, e = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    return s + at, e + at, _range_hash(b, s, e)


def _range_hash(b: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """The hash of each byte range [s, e) of a chunk."""
    up, down = _BYTES.upto(len(b) + 1)
    total = np.zeros(len(b) + 1, dtype=U64)
    np.cumsum((b.astype(U64) + U64(1)) * up[:-1], out=total[1:])
    return mix((total[e] - total[s]) * down[s] + (e - s).astype(U64) * U64(0xC2B2AE3D27D4EB4F))


def hash_bytes(word: bytes) -> int:
    """The hash that ``find_words`` gives to a word of these bytes."""
    b = np.frombuffer(word, dtype=np.uint8)
    return int(_range_hash(b, np.array([0]), np.array([len(b)]))[0])


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k words from each index on (len(words) - k + 1 of them)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    up, down = _WORDS.upto(len(words) + 1)
    total = np.zeros(len(words) + 1, dtype=U64)
    np.cumsum(words * up[:-1], out=total[1:])
    return mix((total[k:] - total[:-k]) * down[:n] + U64(k))


def gram_starts(first: np.ndarray, k: int) -> np.ndarray:
    """For every word index with k words of one document from it on: True (length: all windows of the block)."""
    n = max(0, int(first[-1]) - k + 1)
    ok = np.ones(n, dtype=bool)
    for cut in first[1:-1]:
        ok[max(0, int(cut) - k + 1) : int(cut)] = False
    return ok


def sequence_hash(words: np.ndarray) -> int:
    """The hash of a whole sequence of words."""
    return int(gram_hashes(words, len(words))[0])
