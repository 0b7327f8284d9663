"""Substring dedup: suffix automata over reference shards give matching statistics.

A window is ``window`` consecutive words of one document. A word is removed
if a window over it also starts earlier in the corpus (smaller doc_id, or the
same document and an earlier start); windows are judged on the input.

The reference is the corpus itself, so its automata have no size bound and
cannot be broadcast, nor can every document be streamed past every shard
without the work growing with the square of the input. Shards therefore come
to meet the documents: a window is routed by the smallest hash of the 8-word
runs inside it, so equal windows reach the same shard, together with their
neighbours in the document (a *run*). The letters of a shard's automaton are
whole windows, so a match of m letters is a match of m + window - 1 words and
every match is above the length threshold.

* Before the shuffle, a task compares the windows of its own part by (hash,
  doc_id, start): of equal windows only the earliest goes on, so a passage
  that stands in a third of all documents reaches its shard once per task.
* In a shard, runs are streamed in the order (doc_id, start) through the
  automaton of the passages seen so far; matched stretches are spans to
  remove, unmatched ones extend the automaton.
* A document's spans meet its text in a join on doc_id.

Work is linear in the input and a shard's memory is bounded by the number of
blocks, which follows ``spark.sql.shuffle.partitions``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.llm.frames import BLOCK_DDL, BLOCK_SCHEMA, free_names, n_parts, prepare, stored, to_blocks
from pulse.llm.text import U64, blocks, find_words, gram_hashes, gram_starts, mix

SUB = 8  # blocks per partition: a task holds one at a time
LAST = np.iinfo(np.int64).max  # where a null doc_id stands in the order


@dataclass(frozen=True)
class SubstringDedup:
    window: int = 20
    #: Words of the runs whose smallest hash routes a window; fewer than ``window``.
    route_words: int = 8
    #: Windows that a task compares among themselves before they are shuffled.
    flush: int = 700_000


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values."""
    have = 1
    while have * 2 <= width:
        a = np.minimum(a[:-have], a[have:])
        have *= 2
    step = width - have
    return np.minimum(a[:-step], a[step:]) if step else a


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices starts[i], starts[i] + 1, ... (lengths[i] of them) for every i."""
    at = np.cumsum(lengths) - lengths
    return np.repeat(starts - at, lengths) + np.arange(int(lengths.sum()))


def _runs(start: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first places, lengths) of maximal stretches of neighbouring windows with one value of
    each of ``same``."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = start[1:] != start[:-1] + 1
    for x in same:
        cut |= x[1:] != x[:-1]
    first = np.flatnonzero(np.concatenate([[True], cut]))
    return first, np.diff(np.append(first, len(start)))


def _pack(block, doc, mark, start, length, letters, at):
    """Rows (block, data) of runs: their number and their letters' number, doc, mark, start, length, letters."""
    order = np.argsort(block, kind="stable")
    block = block[order]
    cut = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.zeros(0, np.int64)
    ids, data, size = [], [], 0
    for a, b in zip(cut, np.append(cut[1:], len(block))):
        o = order[a:b]
        own = letters[ragged(at[o], length[o])] if letters is not None else np.zeros(0, U64)
        data.append(b"".join([np.array([len(o), len(own)], np.int64).tobytes(), doc[o].tobytes(), mark[o].tobytes(), start[o].tobytes(), length[o].tobytes(), own.tobytes()]))
        ids.append(int(block[a]))
        size += len(data[-1])
        if size > 8 << 20:
            yield pa.record_batch([pa.array(ids, pa.int32()), pa.array(data, pa.binary())], schema=BLOCK_SCHEMA)
            ids, data, size = [], [], 0
    if ids:
        yield pa.record_batch([pa.array(ids, pa.int32()), pa.array(data, pa.binary())], schema=BLOCK_SCHEMA)


def _unpack(data):
    n, k = np.frombuffer(data, np.int64, 2)
    at, out = 16, []
    for kind, count in ((np.int64, n), (np.int64, n), (np.int64, n), (np.int64, n), (U64, k)):
        out.append(np.frombuffer(data, kind, int(count), at))
        at += 8 * int(count)
    return out


def _routed(docs: DataFrame, p: SubstringDedup, n_blocks: int) -> DataFrame:
    """Blocks 0..n_blocks-1: runs of windows that are the earliest of their task's part;
    blocks from n_blocks on: runs of windows that are not, so already known repeats."""
    width, k, flush = p.window, p.route_words, p.flush

    def emit(held):
        doc, mark, start, h, route = (np.concatenate(x) for x in zip(*held))
        if (doc[1:] < doc[:-1]).any():
            o = np.argsort(doc, kind="stable")
            doc, mark, start, h, route = doc[o], mark[o], start[o], h[o], route[o]
        # by hash, then doc_id and start: rows that share a doc_id may stand in any order
        o = np.lexsort((start, doc, h)) if (np.diff(start)[doc[1:] == doc[:-1]] <= 0).any() else np.argsort(h, kind="stable")
        s = h[o]
        new = np.concatenate([[True], s[1:] != s[:-1]])
        least = o[np.flatnonzero(new)][np.cumsum(new) - 1]  # the earliest of each window's equals
        repeat = np.empty(len(h), dtype=bool)
        repeat[o] = (doc[o] != doc[least]) | (start[o] != start[least])
        del o, s, new, least
        d, m, st = doc[repeat], mark[repeat], start[repeat]
        at, n = _runs(st, d, m)
        yield from _pack(n_blocks + (at % n_blocks).astype(np.int32), d[at], m[at], st[at], n, None, at)
        d, m, st, x, r = doc[~repeat], mark[~repeat], start[~repeat], h[~repeat], route[~repeat]
        at, n = _runs(st, d, m, r)
        yield from _pack((mix(r[at]) % U64(n_blocks)).astype(np.int32), d[at], m[at], st[at], n, x, at)

    def run(batches):
        held, size = [], 0
        for block in blocks(batches, "text"):
            ids = np.asarray(block.rows.column(0).fill_null(LAST))
            marks = block.rows.column(1).to_numpy()
            w = find_words(block.buf, block.off)
            ok = gram_starts(w.first, width)
            if not ok.any():
                continue
            h = gram_hashes(w.hash, width)[ok]
            route = sliding_min(gram_hashes(w.hash, k), width - k + 1)[ok]
            of = w.doc()[: len(ok)][ok]
            start = np.flatnonzero(ok) - w.first[of]
            held.append((ids[of], marks[of], start, h, route))
            size += len(h)
            if size >= flush:
                yield from emit(held)
                held, size = [], 0
        if held:
            yield from emit(held)

    return docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text"), "text").mapInArrow(run, BLOCK_DDL)


class SuffixAutomaton:
    """The suffix automaton of a set of sequences, extended online.

    ``link`` and ``length`` are a state's suffix link and longest string;
    ``edges`` maps (state, letter) to a state. State 0 is the root.
    """

    def __init__(self) -> None:
        self.link, self.length, self.out, self.edges = [-1], [0], [[]], {}

    def _state(self, length: int, link: int, out: list) -> int:
        self.length.append(length)
        self.link.append(link)
        self.out.append(out)
        return len(self.length) - 1

    def extend(self, last: int, letter: int) -> int:
        """The state of (string of ``last``) + letter, which is added if it is not there."""
        edges, length, link = self.edges, self.length, self.link
        to = edges.get((last, letter))
        if to is not None:
            if length[to] == length[last] + 1:
                return to
            return self._split(last, letter, to)
        new = self._state(length[last] + 1, 0, [])
        at = last
        while at != -1 and (at, letter) not in edges:
            edges[at, letter] = new
            self.out[at].append(letter)
            at = link[at]
        if at != -1:
            to = edges[at, letter]
            link[new] = to if length[to] == length[at] + 1 else self._split(at, letter, to)
        return new

    def _split(self, at: int, letter: int, to: int) -> int:
        """A copy of state ``to`` for the strings no longer than that of ``at`` and the letter."""
        copy = self._state(self.length[at] + 1, self.link[to], list(self.out[to]))
        for c in self.out[to]:
            self.edges[copy, c] = self.edges[to, c]
        while at != -1 and self.edges.get((at, letter)) == to:
            self.edges[at, letter] = copy
            at = self.link[at]
        self.link[to] = copy
        return copy

    def step(self, state: int, matched: int, letter: int) -> tuple[int, int]:
        """Matching statistics: the longest suffix of (matched string) + letter that occurs."""
        edges = self.edges
        while state and (state, letter) not in edges:
            state = self.link[state]
            matched = self.length[state]
        to = edges.get((state, letter))
        return (to, matched + 1) if to is not None else (0, 0)


def repeated_letters(sequences: list[list[int]]) -> list[list[bool]]:
    """For each sequence, which letters lie in a match with an earlier sequence or place.

    Unmatched stretches become reference passages of the automaton.
    """
    automaton, out = SuffixAutomaton(), []
    for letters in sequences:
        state = matched = 0
        last = 0
        found = []
        for c in letters:
            state, matched = automaton.step(state, matched, c)
            found.append(matched > 0)
            last = 0 if matched else automaton.extend(last, c)
        out.append(found)
    return out


_SPAN_DDL = "doc_id bigint, mark bigint, start bigint, n bigint"
_SPAN = pa.schema([(x.split()[0], pa.int64()) for x in _SPAN_DDL.split(", ")])


def _spans(routed: DataFrame, n_blocks: int) -> DataFrame:
    """(doc_id, mark, start, n): n neighbouring windows from ``start`` on are repeats; ``mark``
    tells the texts of rows that share a doc_id apart."""

    def shard(parts):
        doc, mark, start, length, letters = (np.concatenate(x) for x in zip(*parts))
        values, code, count = np.unique(letters, return_inverse=True, return_counts=True)
        del values
        again = count[code] > 1
        if not again.any():
            return
        at = np.cumsum(length) - length
        o = np.lexsort((start, doc))
        place = ragged(at[o], length[o])
        place = place[again[place]]  # letters that occur twice, in the order of the corpus
        run = np.repeat(np.arange(len(doc)), length)[place]
        d, m, s = doc[run], mark[run], start[run] + place - at[run]
        first, n = _runs(s, d, m)
        code = code[place].tolist()
        found = repeated_letters([code[a : a + k] for a, k in zip(first.tolist(), n.tolist())])
        hit = np.fromiter((x for f in found for x in f), bool, len(code))
        # the same place of repeated rows is not earlier than itself
        earliest = np.full(len(count), -1, dtype=np.int64)
        c = np.asarray(code)
        earliest[c[::-1]] = np.arange(len(c))[::-1]
        hit &= (d != d[earliest[c]]) | (s != s[earliest[c]])
        d, m, s = d[hit], m[hit], s[hit]
        first, n = _runs(s, d, m)
        yield pa.record_batch([pa.array(d[first]), pa.array(m[first]), pa.array(s[first]), pa.array(n)], schema=_SPAN)

    def run(batches):
        now, held = None, []
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = _unpack(data.as_buffer())
                if number >= n_blocks:
                    yield pa.record_batch([pa.array(x) for x in part[:4]], schema=_SPAN)
                    continue
                if number != now:
                    if held:
                        yield from shard(held)
                    now, held = number, []
                held.append(part)
        if held:
            yield from shard(held)

    return to_blocks(routed, SUB).mapInArrow(run, _SPAN_DDL)


def repeated_spans(docs: DataFrame, p: SubstringDedup = SubstringDedup()) -> DataFrame:
    """(doc_id, mark, spans): for each document with repeats, its runs (start, n) of repeated
    windows; ``mark`` is ``xxhash64(text)``. A null doc_id stands after all others. In the order,
    rows that share a doc_id are one document, but each has its own text."""
    prepare(docs.sparkSession)
    n_blocks = SUB * max(1, n_parts(docs.sparkSession) // 2)
    spans = _spans(_routed(docs, p, n_blocks), n_blocks)
    doc_id = F.when(F.col("doc_id") != LAST, F.col("doc_id"))
    return spans.groupBy(doc_id.alias("doc_id"), "mark").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def remove_repeats(docs: DataFrame, p: SubstringDedup = SubstringDedup()) -> DataFrame:
    """``docs`` with repeated words cut out of ``text``, and n_words and n_removed (bigint).

    The text between kept words stays as it was. A null text stays null and
    has no words; an empty table gives an empty table; other columns are
    passed on (n_words and n_removed of the input are replaced).
    """
    width = p.window
    docs = docs.drop("n_words", "n_removed")
    columns = docs.columns
    own_id, own_mark, own_spans = free_names(docs, "span_doc_id", "span_mark", "repeat_spans")
    spans = stored(repeated_spans(docs, p), "repeated-spans").withColumnsRenamed({"doc_id": own_id, "mark": own_mark, "spans": own_spans})
    same = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.xxhash64("text") == F.col(own_mark))
    joined = docs.join(spans, same, "left").select(*columns, own_spans)
    text_at = columns.index("text")

    def cut(block):
        w = find_words(block.buf, block.off)
        spans = block.rows.column(len(columns))
        length = np.asarray(spans.value_lengths().fill_null(0)).astype(np.int64)
        flat = spans.flatten()
        cover = np.zeros(len(w.hash) + 1, dtype=np.int64)
        if len(flat):
            begin = np.repeat(w.first[:-1], length) + flat.field(0).to_numpy()
            np.add.at(cover, begin, 1)
            np.add.at(cover, begin + flat.field(1).to_numpy() + width - 1, -1)
        gone = np.cumsum(cover)[:-1] > 0
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[w.first])
        texts = block.rows.column(text_at)
        if removed.any():
            values = texts.to_pylist()
            for i in np.flatnonzero(removed).tolist():
                values[i] = _without(block, w, gone, i).decode("utf-8", "replace")
            texts = pa.array(values, texts.type)
        out = [texts if j == text_at else block.rows.column(j) for j in range(len(columns))]
        return [*out, pa.array(w.count()), pa.array(removed)]

    def run(batches):
        for block in blocks(batches, "text"):
            out = cut(block)
            yield pa.RecordBatch.from_arrays(out, names=[*columns, "n_words", "n_removed"])

    extra = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    return joined.mapInArrow(run, T.StructType([*docs.schema.fields, *extra]))


def _without(block, w, gone, i) -> bytes:
    """The text of document i from each kept word's start to the next word's start."""
    a, b = w.first[i], w.first[i + 1]
    keep = np.flatnonzero(~gone[a:b]) + a
    if not len(keep):
        return b""
    until = np.append(w.start[a + 1 : b], block.off[i + 1])
    first = np.flatnonzero(np.concatenate([[True], keep[1:] != keep[:-1] + 1]))
    parts = []
    for x, y in zip(keep[first], keep[np.append(first[1:], len(keep)) - 1]):
        parts.append(block.buf[w.start[x] : until[y - a]].tobytes())
    return b"".join(parts)


def joined_words(text: Column) -> Column:
    """The words of a text joined by one space (null as empty)."""
    one = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.trim(one)
