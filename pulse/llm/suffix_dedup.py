"""Suffix-array dedup: byte strings that also stand in an earlier document go.

A byte is removed if a string of ``window`` bytes over it also starts in a
document with a smaller doc_id; strings are judged on the input and never
cross documents. What is equal is decided by merged Burrows-Wheeler
transforms (``suffix_merge``): shards of strings are sorted on their own, and
their transforms interleaved until all places stand in the order of their
next ``window`` bytes. The intervals of that order are the repeated strings.

Transforms of the whole corpus cannot be merged in one place, so equal
strings are first brought together:

* Documents are written once, as packs of rows, bucketed by pack: later steps
  meet a pack's texts where they lie, and texts are not shuffled.
* Every window's smallest hash of the ``gram`` bytes in it is its fingerprint.
  Equal windows have one fingerprint, and neighbours mostly share it. Each
  pack sends its distinct fingerprints, with the number of its documents, to
  the blocks they hash to. A block sends back those of two or more documents,
  with their *home*: where the fingerprint stands first.
* Windows of shared fingerprints go, as stretches of text, to the block of
  their home. A passage of any length has mostly one home, so stretches are
  long. Above ``warm_docs`` documents the pack's own strings are merged first
  and only the earliest document of each string goes on: a passage or text
  that a third of all documents hold travels once a pack. Above ``hot_docs``
  there is no home, and windows go by a hash of their own bytes.
* In a block, stretches are the strings of the shards. Windows whose interval
  also holds a smaller doc_id are repeats, and go back to their pack as spans.

Fingerprints only choose what meets; they may bring together too much but
never too little. Memory follows packs and blocks, work the input.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pulse.llm.frames import BLOCK_DDL, n_parts, prepare, split_by, to_blocks
from pulse.llm.substring_dedup import ragged, sliding_min
from pulse.llm.suffix_merge import repeats
from pulse.llm.text import U64, gram_hashes, gram_starts, mix, string_buffer
from pulse.session import scratch_path

SUB = 16  # blocks per partition: a task holds one at a time
LAST = np.iinfo(np.int64).max  # where a null doc_id stands in the order
PACK_BITS = 12  # rows of a pack
CHUNK = 1 << 17  # windows hashed at a time


@dataclass(frozen=True)
class SuffixDedup:
    window: int = 50
    #: Bytes of a letter of the transforms; divides ``window``.
    letter: int = 10
    #: Bytes of the runs whose smallest hash is a window's fingerprint.
    gram: int = 20
    #: Documents of a fingerprint above which a pack's own repeats are found before its windows
    #: travel, and above which it has no home.
    warm_docs: int = 64
    hot_docs: int = 4096
    shard_bytes: int = 1 << 18
    #: Fingerprints that a task gathers before they are combined and shuffled.
    flush: int = 500_000


@dataclass
class Found:
    """Neighbouring windows of one fingerprint: row of the batch, first window's place in its
    text, number, fingerprint."""

    row: np.ndarray
    start: np.ndarray
    n: np.ndarray
    print: np.ndarray


def fingerprints(buf: np.ndarray, off: np.ndarray, p: SuffixDedup) -> Found:
    """The windows of some texts by fingerprint."""
    out = []
    count = len(buf) - p.window + 1
    valid = gram_starts(off, p.window)
    for a in range(0, max(0, count), CHUNK):
        b = min(a + CHUNK, count)
        grams = gram_hashes(buf[a : b + p.window - 1].astype(U64) + U64(1), p.gram)
        low = sliding_min(grams, p.window - p.gram + 1)
        ok = valid[a:b]
        new = ok.copy()
        new[1:] &= (low[1:] != low[:-1]) | ~ok[:-1]
        # a window at a text's beginning begins a run of its own
        first = off[np.searchsorted(off, a) : np.searchsorted(off, b)] - a
        first = first[first < b - a]
        new[first] = ok[first]
        at = np.flatnonzero(new)
        if not len(at):
            continue
        # a run ends at the next run or the first window that crosses a text's end
        stop = np.append(at[1:], b - a)
        gaps = np.flatnonzero(~ok & np.concatenate([[True], ok[:-1]]))
        if len(gaps):
            near = np.searchsorted(gaps, at)
            stop = np.minimum(stop, np.where(near < len(gaps), gaps[np.minimum(near, len(gaps) - 1)], b - a))
        of = np.searchsorted(off, at + a, side="right") - 1
        out.append((of, at + a - off[of], stop - at, low[at]))
    if not out:
        none = np.zeros(0, np.int64)
        return Found(none, none, none, np.zeros(0, U64))
    return Found(*(np.concatenate(x) for x in zip(*out)))


def _texts(column: pa.Array, most: int = 1 << 20):
    """(first row, bytes, offsets) of neighbouring texts of about ``most`` bytes, or one longer one."""
    buf, off = string_buffer(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1)
        yield i, buf[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


_SENT_DDL = "block int, pack bigint, data binary"
_SENT = pa.schema([("block", pa.int32()), ("pack", pa.int64()), ("data", pa.binary())])
_PRINT = np.dtype([("print", "<u8"), ("place", "<u2"), ("docs", "<u2")])


def _sent(packs: DataFrame, p: SuffixDedup, n_blocks: int) -> DataFrame:
    """Each pack's fingerprints: the place of the first and the number of documents."""

    def emit(held):
        row, place, h = (np.concatenate(x) for x in zip(*held))
        pack = row >> PACK_BITS
        o = np.lexsort((place, row, h, pack))
        row, place, h, pack = row[o], place[o], h[o], pack[o]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (pack[1:] != pack[:-1])])
        doc = new | np.concatenate([[True], row[1:] != row[:-1]])
        at = np.flatnonzero(new)
        data = np.zeros(len(at), _PRINT)
        data["print"], data["place"] = h[at], place[at]
        data["docs"] = np.add.reduceat(doc.astype(np.int64), at)
        pack, block = pack[at], (h[at] % U64(n_blocks)).astype(np.int64)
        order = np.lexsort((block, pack))
        pack, block, data = pack[order], block[order], data[order]
        cut = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (pack[1:] != pack[:-1])]))
        ends = np.append(cut[1:], len(block))
        for i in range(0, len(cut), 5000):
            c, e = cut[i : i + 5000], ends[i : i + 5000]
            values = [data[x:y].tobytes() for x, y in zip(c, e)]
            yield pa.record_batch([pa.array(block[c].astype(np.int32)), pa.array(pack[c]), pa.array(values, pa.binary())], schema=_SENT)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for i, buf, off in _texts(batch.column(1)):
                f = fingerprints(buf, off, p)
                if not len(f.row):
                    continue
                row = rows[i + f.row]
                # 16 neighbouring rows share a place; long texts have one for each 64 KB (modulo 16 MB)
                place = (((row >> 4) & 255) << 8 | (f.start >> 16) & 255).astype(np.uint16)
                held.append((row, place, f.print))
                size += len(row)
                if size >= p.flush:
                    yield from emit(held)
                    held, size = [], 0
        if held:
            yield from emit(held)

    return packs.select("row", "text").mapInArrow(run, _SENT_DDL)


_LIST_DDL = "pack bigint, data binary"
_LIST = pa.schema([("pack", pa.int64()), ("data", pa.binary())])
_WAY = np.dtype([("print", "<u8"), ("block", "<i4")])
HOT = -1  # the block of a fingerprint without a home; -2 - block: of one whose windows are first merged in the pack


def _shared(sent: DataFrame, p: SuffixDedup, n_blocks: int) -> DataFrame:
    """For each pack, which of its fingerprints other documents share, and the block of their home."""

    def block(parts):
        data = np.concatenate([d for _, d in parts])
        pack = np.repeat(np.array([k for k, _ in parts], np.int64), [len(d) for _, d in parts])
        o = np.lexsort((data["place"], pack, data["print"]))
        pack, data = pack[o], data[o]
        new = np.concatenate([[True], data["print"][1:] != data["print"][:-1]])
        at, of = np.flatnonzero(new), np.cumsum(new) - 1
        docs = np.add.reduceat(data["docs"].astype(np.int64), at)
        home = mix(mix(pack[at].astype(U64)) + data["place"][at].astype(U64)) % U64(n_blocks)
        home = home.astype(np.int64)
        way = np.where(docs > p.hot_docs, HOT, np.where(docs > p.warm_docs, -2 - home, home))
        keep = (docs > 1)[of]
        out = np.zeros(int(keep.sum()), _WAY)
        out["print"], out["block"] = data["print"][keep], way[of][keep]
        order, starts, ends = split_by(pack[keep])
        ids = pack[keep][order]
        for i in range(0, len(starts), 2000):
            s, e = starts[i : i + 2000], ends[i : i + 2000]
            yield pa.record_batch([pa.array(ids[s]), pa.array([out[order[x:y]].tobytes() for x, y in zip(s, e)], pa.binary())], schema=_LIST)

    def run(batches):
        now, held = None, []
        for batch in batches:
            for number, pack, data in zip(*(c.to_pylist() for c in batch.columns)):
                if number != now:
                    if held:
                        yield from block(held)
                    now, held = number, []
                held.append((pack, np.frombuffer(data, _PRINT)))
        if held:
            yield from block(held)

    return to_blocks(sent, SUB).mapInArrow(run, _LIST_DDL)


@dataclass
class Stretches:
    """Neighbouring windows of texts: row, document, first window, number of windows, and the
    bytes they cover one after the other."""

    row: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    n: np.ndarray
    data: bytes | memoryview

    def repeated(self, p: SuffixDedup) -> np.ndarray:
        """For each window, one stretch after the other: whether its string also starts in a
        smaller document, by the merged transforms."""
        length = self.n + p.window - 1
        padded = -(-length // p.letter) * p.letter
        strings = np.zeros(int(padded.sum()), np.uint8)
        begin = np.cumsum(padded) - padded
        strings[ragged(begin, length)] = np.frombuffer(self.data, np.uint8)
        found = repeats(strings, np.cumsum(padded), p.window, p.letter, p.shard_bytes)
        which = np.repeat(np.arange(len(begin)), padded)[found.place]
        window = found.place - begin[which]
        real = window < self.n[which]  # places near a stretch's end are no windows
        which, window, interval = which[real], window[real], found.interval[real]
        doc = self.doc[which]
        at = np.flatnonzero(np.concatenate([[True], interval[1:] != interval[:-1]]))
        least = np.repeat(np.minimum.reduceat(doc, at), np.diff(np.append(at, len(doc))))
        out = np.zeros(int(self.n.sum()), bool)
        out[(np.cumsum(self.n) - self.n)[which] + window] = doc > least
        return out

    def spans(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(stretch, first window, number) of maximal runs of windows marked in ``keep``."""
        first = np.cumsum(self.n) - self.n
        edge = np.zeros(len(keep), bool)
        edge[first] = True
        begin = np.flatnonzero(keep & (edge | ~np.concatenate([[False], keep[:-1]])))
        last = np.append(edge[1:], True) | ~np.append(keep[1:], False)
        end = np.flatnonzero(keep & last)
        which = np.searchsorted(first, begin, side="right") - 1
        return which, begin - first[which], end - begin + 1

    @staticmethod
    def join(parts: list[Stretches]) -> Stretches:
        return Stretches(*(np.concatenate([getattr(x, f) for x in parts]) for f in ("row", "doc", "start", "n")), b"".join(x.data for x in parts))


def _blocked(route: np.ndarray, s: Stretches, window: int, schema=pa.schema([("block", pa.int32()), ("data", pa.binary())])):
    """Rows (block, data) of stretches by route: their number, then row, doc, start, n and bytes."""
    order, starts, ends = split_by(route)
    length = s.n + window - 1
    at = np.cumsum(length) - length
    data = np.frombuffer(s.data, np.uint8)
    ids, values, size = [], [], 0
    for a, b in zip(starts, ends):
        o = order[a:b]
        own = data[ragged(at[o], length[o])].tobytes() if len(data) else b""
        values.append(b"".join([np.int64(len(o)).tobytes(), s.row[o].tobytes(), s.doc[o].tobytes(), s.start[o].tobytes(), s.n[o].tobytes(), own]))
        ids.append(int(route[o[0]]))
        size += len(values[-1])
        if size > 4 << 20:
            yield pa.record_batch([pa.array(ids, pa.int32()), pa.array(values, pa.binary())], schema=schema)
            ids, values, size = [], [], 0
    if ids:
        yield pa.record_batch([pa.array(ids, pa.int32()), pa.array(values, pa.binary())], schema=schema)


def _unblocked(data) -> Stretches:
    k = int(np.frombuffer(data, np.int64, 1)[0])
    row, doc, start, n = np.frombuffer(data, np.int64, 4 * k, 8).reshape(4, k)
    return Stretches(row, doc, start, n, memoryview(data)[8 + 32 * k :])


def _cut(run_at: np.ndarray, run_n: np.ndarray, way: np.ndarray, begin: np.ndarray):
    """(first window, number, way) of the longest runs of neighbouring windows of one way;
    ``begin``: True where a run begins a text."""
    new = np.concatenate([[True], (way[1:] != way[:-1]) | (run_at[1:] != run_at[:-1] + run_n[:-1])]) | begin
    at = np.flatnonzero(new)
    return run_at[at], np.add.reduceat(run_n, at), way[at]


def _dealt(packs: DataFrame, shared: DataFrame, p: SuffixDedup, n_blocks: int) -> DataFrame:
    """Windows of shared fingerprints as stretches: blocks 0..n_blocks-1; from n_blocks on:
    spans, without bytes, that the pack's own strings already show to be repeats."""
    window, schema = p.window, pa.schema([("block", pa.int32()), ("data", pa.binary())])

    def take(buf, at, n, row, doc, start):
        return Stretches(row, doc, start, n, buf[ragged(at, n + window - 1)].tobytes())

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list = []
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        known = np.concatenate([np.frombuffer(x, _WAY) for x in right.column("data").to_pylist()])
        known = known[np.argsort(known["print"], kind="stable")]
        left = left.sort_by("row").combine_chunks()
        rows, docs = left.column("row").to_numpy(), left.column("doc").to_numpy()
        warm, ways = [], []
        for i, buf, off in _texts(left.column("text")):
            f = fingerprints(buf, off, p)
            if not len(f.row):
                continue
            at = np.minimum(np.searchsorted(known["print"], f.print), len(known) - 1)
            there = known["print"][at] == f.print
            f = Found(*(x[there] for x in (f.row, f.start, f.n, f.print)))
            if not len(f.row):
                continue
            way = known["block"][at[there]].astype(np.int64)
            begin = np.concatenate([[True], f.row[1:] != f.row[:-1]])
            at, n, way = _cut(off[f.row] + f.start, f.n, way, begin)
            of = np.searchsorted(off, at, side="right") - 1
            s = (rows[i + of], docs[i + of], at - off[of])
            cold = way >= 0
            if cold.any():
                out += _blocked(way[cold], take(buf, at[cold], n[cold], *(x[cold] for x in s)), window)
            if not cold.all():
                warm.append(take(buf, at[~cold], n[~cold], *(x[~cold] for x in s)))
                ways.append(way[~cold])
        if warm:
            out += merged_first(Stretches.join(warm), np.concatenate(ways))
        return pa.Table.from_batches(out, schema=schema)

    def merged_first(s: Stretches, way: np.ndarray):
        again = s.repeated(p)
        which, at, n = s.spans(again)
        if len(which):
            found = Stretches(s.row[which], s.doc[which], s.start[which] + at, n, b"")
            yield from _blocked(n_blocks + (s.row[which] >> PACK_BITS) % n_blocks, found, window)
        which, at, n = s.spans(~again)
        length = s.n + window - 1
        begin = np.cumsum(length) - length
        data = np.frombuffer(s.data, np.uint8)

        def stretches(which, at, n):
            return take(data, begin[which] + at, n, s.row[which], s.doc[which], s.start[which] + at)

        hot = way[which] == HOT
        if not hot.all():
            w = which[~hot]
            yield from _blocked(-2 - way[w], stretches(w, at[~hot], n[~hot]), window)
        if hot.any():
            which, at, n = which[hot], at[hot], n[hot]
            covered = n + window - 1
            own = gram_hashes(data[ragged(begin[which] + at, covered)].astype(U64) + U64(1), window)
            own = (own[ragged(np.cumsum(covered) - covered, n)] % U64(n_blocks)).astype(np.int64)
            of = np.repeat(np.arange(len(n)), n)
            place = at[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (of[1:] != of[:-1])]))
            yield from _blocked(own[first], stretches(which[of[first]], place[first], np.diff(np.append(first, len(of)))), window)

    texts = packs.select("pack", "row", "doc", "text")
    return texts.groupBy("pack").cogroup(shared.groupBy("pack")).applyInArrow(run, BLOCK_DDL)


def _spans(dealt: DataFrame, p: SuffixDedup, n_blocks: int) -> DataFrame:
    """For each pack, spans (row, first window, number of windows) of repeats."""

    def packed(row, start, n):
        order, starts, ends = split_by(row >> PACK_BITS)
        fields = np.stack([row, start, n])[:, order]
        if len(starts):
            ids = (row >> PACK_BITS)[order[starts]]
            yield pa.record_batch([pa.array(ids), pa.array([fields[:, a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())], schema=_LIST)

    def block(parts):
        s = Stretches.join(parts)
        which, at, n = s.spans(s.repeated(p))
        yield from packed(s.row[which], s.start[which] + at, n)

    def run(batches):
        now, held = None, []
        for batch in batches:
            for number, data in zip(*(c.to_pylist() for c in batch.columns)):
                part = _unblocked(data)
                if number >= n_blocks:
                    yield from packed(part.row, part.start, part.n)
                    continue
                if number != now:
                    if held:
                        yield from block(held)
                    now, held = number, []
                held.append(part)
        if held:
            yield from block(held)

    return to_blocks(dealt, SUB).mapInArrow(run, _LIST_DDL)


def _stored_packs(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (pack, row, doc, text, rest) written once, bucketed by pack; ``rest`` holds the other columns."""
    spark = docs.sparkSession
    row = F.monotonically_increasing_id()
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text]
    df = docs.select(row.alias("row"), F.coalesce(F.col(doc_id).cast("bigint"), F.lit(LAST)).alias("doc"), F.col(text).alias("text"), F.struct(*rest).alias("rest"))
    df = df.withColumn("pack", F.shiftright("row", PACK_BITS))
    name = f"pulse_packs_{uuid.uuid4().hex[:12]}"
    df.write.format("parquet").option("path", scratch_path(spark, name)).option("compression", "zstd").bucketBy(n_parts(spark), "pack").sortBy("row").saveAsTable(name)
    return spark.table(name)


def remove_substrings(docs: DataFrame, p: SuffixDedup = SuffixDedup(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``kept`` (binary: the text's remaining bytes) in place of the text, and
    n_bytes, n_removed and n_spans (maximal removed runs).

    A null text has no bytes; a null doc_id stands after all others; rows with
    one doc_id are one document, so they remove nothing from each other. Other
    columns are passed on (the four new ones replace columns of their names).
    An empty table gives an empty table.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.drop("kept", "n_bytes", "n_removed", "n_spans")
    n_blocks = SUB * n_parts(spark)
    packs = _stored_packs(docs, doc_id, text)
    shared = _shared(_sent(packs, p, n_blocks), p, n_blocks)
    spans = _spans(_dealt(packs, shared, p, n_blocks), p, n_blocks)
    new = [T.StructField("kept", T.BinaryType()), *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans"))]
    out = T.StructType([packs.schema["rest"], *new])
    schema = to_arrow_schema(out)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("row").combine_chunks()
        n = left.num_rows
        rows = left.column("row").to_numpy()
        parts = [np.frombuffer(x, np.int64).reshape(3, -1) for x in right.column("data").to_pylist()]
        row, start, count = np.concatenate(parts, axis=1) if parts else np.zeros((3, 0), np.int64)
        text = left.column("text").combine_chunks() if left.num_rows else pa.array([], pa.string())
        buf, off = string_buffer(text)
        of = np.searchsorted(rows, row)
        a = off[of] + start
        b = a + count + p.window - 1
        # borders of the removed runs: spans of one text that touch or overlap are one run
        order = np.argsort(a, kind="stable")
        a, b, of = a[order], b[order], of[order]
        top = np.maximum.accumulate(b) if len(b) else b
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] > top[:-1]) | (of[1:] != of[:-1])
        first = np.flatnonzero(new)
        a, of = a[first], of[first]
        b = top[np.append(first[1:], len(top)) - 1] if len(first) else top
        spans = np.bincount(of, minlength=n)
        removed = np.bincount(of, weights=b - a, minlength=n).astype(np.int64)
        gone = np.zeros(len(buf) + 1, np.int8)
        gone[a] += 1
        gone[b] -= 1
        keep = np.cumsum(gone[:-1], dtype=np.int8) == 0
        kept = buf[keep]
        ends = np.concatenate([[0], np.cumsum(np.diff(off) - removed)])
        values = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(kept)]).cast(pa.binary())
        columns = [left.column("rest"), values, pa.array(np.diff(off)), pa.array(removed), pa.array(spans.astype(np.int64))]
        return pa.table([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, schema)], schema=schema)

    found = packs.select("pack", "row", "text", "rest").groupBy("pack").cogroup(spans.groupBy("pack")).applyInArrow(cut, out)
    return found.select("rest.*", "kept", "n_bytes", "n_removed", "n_spans")
