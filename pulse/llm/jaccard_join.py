"""N-gram Jaccard join: exact links between documents by a blocked sparse product.

The incidence matrix A has a row per distinct shingle set and a column per
5-word shingle. Two documents link when the overlap count (A A')[x, y] is at
least the bound that their sizes give (100 * overlap >= 75 * union). The
product is never formed whole:

1. ``_classes``: documents with the same set are one row of A (a *node*).
   Shingles that stand in many rows of a task's part are counted and summed;
   the most frequent of them (a bounded list) come last in the column order.
2. ``_column_blocks``: in any common column order, a row of n shingles that
   links with another shares at least l of its first n - ceil(0.75 n) + l
   columns with it (size-derived bound; l is ``slack`` of n). Only these
   entries are kept, blocked by column; entries of a column without another
   row of compatible size vanish (``_shared``), rows with fewer than l entries
   left are discarded (``_strong``), and the rest of a column gives chains of
   rows of compatible size (``_chains``). Frequent columns are salted by row.
3. The chains' connected components hold all links. Components become row
   blocks of bounded size, each with its rows' whole sets, and one task
   multiplies a row block with itself, accumulating overlap counts of rows
   not yet connected. Components beyond the bound are mostly rows that share
   columns with many others by chance; their rows are judged again by whole
   sets, columns in the order of their counts among them (``_refined``), and
   fall into smaller ones. One that is still beyond it is cut into several row
   blocks with common pivot rows; rows that then stand outside its largest
   class are multiplied with all its blocks, so no pair that could still
   connect two classes is left out.

Nothing is sampled or capped: the list of frequent shingles, the row filter
and the row-block size affect cost only.

Sets are compared by 64-bit hashes of shingles, nodes by a 64-bit hash of the
set (about 3e-8 expected false merges among 1e6 distinct sets).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.components import components
from pulse.llm.frames import BLOCK_DDL, BLOCK_SCHEMA, free_names, grouped_blocks, n_parts, pack_blocks, prepare, stored, to_blocks
from pulse.llm.text import U64, Block, blocks, find_words, gram_hashes, mix, sequence_hash

SUB = 4  # blocks per partition: a task holds one at a time
FLUSH = 800_000  # shingles gathered in a task before they are combined


@dataclass(frozen=True)
class JaccardJoin:
    words: int = 5
    percent: int = 75
    #: Shingles counted this often in a task's part are candidates for the list of frequent ones.
    frequent_local: int = 4
    #: Length of the list of frequent shingles that every task gets (16 bytes each).
    frequent_most: int = 1 << 17
    #: Share of a row's columns kept beyond those that a single common column needs.
    slack: float = 0.1
    #: Rows and shingles of a row block.
    block_rows: int = 4096
    block_shingles: int = 4_000_000
    #: Bits of the row filter at most (16 MB).
    filter_bits: int = 1 << 27


def shingle_sets(block: Block, k: int) -> list[np.ndarray]:
    """For each document the sorted distinct hashes of its k-word shingles (its whole
    word sequence when that has fewer than k words; empty without words)."""
    w = find_words(block.buf, block.off, lower=True)
    grams = gram_hashes(w.hash, k)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= k:
            s = np.sort(grams[a : b - k + 1])
            out.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
        elif b > a:
            out.append(np.array([sequence_hash(w.hash[a:b])], dtype=U64))
        else:
            out.append(np.zeros(0, dtype=U64))
    return out


def node_of(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


# -- 1. rows of the matrix ---------------------------------------------------

_CLASS_DDL = "doc_id bigint, mark bigint, node bigint, n_shingles bigint, frequent bigint, seen bigint"
_CLASS = pa.schema([(x.split()[0], pa.int64()) for x in _CLASS_DDL.split(", ")])


def _classes(docs: DataFrame, p: JaccardJoin) -> DataFrame:
    """Rows (doc_id, mark, node, n_shingles) for documents and (frequent, seen) for shingles."""
    k, least = p.words, p.frequent_local

    def frequent(sets):
        s = np.sort(np.concatenate(sets))
        start = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        seen = np.diff(np.append(start, len(s)))
        hit = seen >= least
        n = int(hit.sum())
        none = pa.nulls(n, pa.int64())
        return pa.record_batch([none, none, none, none, pa.array(s[start[hit]].view(np.int64)), pa.array(seen[hit])], schema=_CLASS)

    def run(batches):
        held, known, size = [], set(), 0
        for block in blocks(batches, "text"):
            sets = shingle_sets(block, k)
            nodes = [node_of(s) if len(s) else None for s in sets]
            none = pa.nulls(len(sets), pa.int64())
            yield pa.record_batch([block.rows.column(0), block.rows.column(1), pa.array(nodes, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), none, none], schema=_CLASS)
            for node, s in zip(nodes, sets):
                if node is not None and node not in known:
                    known.add(node)
                    held.append(s)
                    size += len(s)
            if size >= FLUSH:
                yield frequent(held)
                held, known, size = [], set(), 0
        if held:
            yield frequent(held)

    return docs.mapInArrow(run, _CLASS_DDL)


# -- 2. column blocks --------------------------------------------------------

_ENTRY = [np.uint64, np.int64, np.int32]  # column, row, row's size


def _bounds(n, p: JaccardJoin):
    """(entries kept, entries that a linked row shares at least) of rows of n shingles.

    A link needs an overlap of at least ``percent`` of the larger set; at most
    n - kept of it lie beyond the kept entries of the row with the lower last
    column. One is taken off for rounding between rows of different sizes.
    """
    need = -(-p.percent * n // 100)
    kept = np.minimum(n, n - need + (n * p.slack).astype(np.int64) + 1)
    return kept, np.maximum(1, kept - n + need - 1)


def _prefix(s: np.ndarray, rank: np.ndarray, keep: int) -> np.ndarray:
    """Places in ``s`` of its first ``keep`` entries in the column order: rare columns first."""
    if not rank.any():
        return np.arange(keep)
    rare = np.flatnonzero(rank == 0)
    if len(rare) >= keep:
        return rare[:keep]
    often = np.flatnonzero(rank)
    return np.concatenate([rare, often[np.argsort(rank[often], kind="stable")][: keep - len(rare)]])


def _column_blocks(docs: DataFrame, p: JaccardJoin, frequent, n_blocks: int) -> DataFrame:
    """Kept entries by column block; frequent columns in ``n_blocks`` more blocks, by row."""
    k = p.words

    def emit(columns, rows, sizes, often):
        c, r, n, o = (np.concatenate(x) for x in (columns, rows, sizes, often))
        block = (mix(c) % U64(n_blocks)).astype(np.int32)
        block[o] = n_blocks + (mix(r[o].view(U64)) % U64(n_blocks)).astype(np.int32)
        yield from pack_blocks(block, [c, r, n], BLOCK_SCHEMA)

    def run(batches):
        keys, ranks = frequent.value
        parts, known, size = ([], [], [], []), set(), 0
        for block in blocks(batches, "text"):
            sets = [s for s in shingle_sets(block, k) if len(s)]
            if not sets:
                continue
            all_ = np.concatenate(sets)
            kept = _bounds(np.array([len(s) for s in sets]), p)[0]
            rank = np.zeros(len(all_), dtype=np.int32)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, all_), len(keys) - 1)
                rank = np.where(keys[at] == all_, ranks[at], 0).astype(np.int32)
            at = 0
            for s, most in zip(sets, kept.tolist()):
                own = rank[at : at + len(s)]
                at += len(s)
                if (node := node_of(s)) in known:
                    continue
                known.add(node)
                keep = _prefix(s, own, most)
                for part, x in zip(parts, (s[keep], np.full(len(keep), node, np.int64), np.full(len(keep), len(s), np.int32), own[keep] > 0)):
                    part.append(x)
                size += len(keep)
            if size >= FLUSH:
                yield from emit(*parts)
                parts, known, size = ([], [], [], []), set(), 0
        if size:
            yield from emit(*parts)

    return docs.select("text").mapInArrow(run, BLOCK_DDL)


def _in_order(c, r, n):
    order = np.lexsort((r, n, c))
    return c[order], r[order], n[order].astype(np.int64)


def _near(c, r, n, percent):
    """True where an entry and the next are of one column, two rows and compatible sizes."""
    return (c[1:] == c[:-1]) & (r[1:] != r[:-1]) & (100 * n[:-1] >= percent * n[1:])


class _Gather:
    """Entries on their way to new blocks: packed when many are there, so that a task
    sends few rows however many blocks it has read."""

    def __init__(self) -> None:
        self.held, self.size = [], 0

    def add(self, block, *fields):
        self.held.append((block, *fields))
        self.size += len(block)
        if self.size >= FLUSH:
            yield from self.done()

    def done(self):
        if self.size:
            block, *fields = (np.concatenate(x) for x in zip(*self.held))
            yield from pack_blocks(block, fields, BLOCK_SCHEMA)
        self.held, self.size = [], 0


def _shared(packed: DataFrame, p: JaccardJoin, n_blocks: int) -> DataFrame:
    """Entries whose column has another row of compatible size, blocked by row. Entries of
    frequent columns, whose rows are spread over blocks, are all kept; a negative size marks
    them from here on."""

    def run(batches):
        out = _Gather()
        for number, (c, r, n) in grouped_blocks(batches, _ENTRY):
            if number < n_blocks:
                c, r, n = _in_order(c, r, n)
                near = _near(c, r, n, p.percent)
                keep = np.append(near, False) | np.insert(near, 0, False)
                c, r, n = c[keep], r[keep], n[keep].astype(np.int32)
            else:
                n = -n
            yield from out.add((mix(r.view(U64)) % U64(n_blocks)).astype(np.int32), c, r, n)
        yield from out.done()

    return to_blocks(packed, SUB).mapInArrow(run, BLOCK_DDL)


def _strong(packed: DataFrame, p: JaccardJoin, n_blocks: int) -> DataFrame:
    """Entries of rows that share as many columns as a link needs, blocked by column again."""

    def run(batches):
        out = _Gather()
        for _, (c, r, n) in grouped_blocks(batches, _ENTRY):
            order = np.lexsort((c, r))
            c, r, n = c[order], r[order], n[order]
            once = np.ones(len(c), dtype=bool)  # a row may come from several tasks
            once[1:] = (c[1:] != c[:-1]) | (r[1:] != r[:-1])
            c, r, n = c[once], r[once], n[once]
            new = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
            count = np.diff(np.append(new, len(r)))
            enough = count >= _bounds(np.abs(n[new]).astype(np.int64), p)[1]
            keep = np.repeat(enough, count)
            c, r, n = c[keep], r[keep], n[keep]
            often = n < 0
            block = (mix(c) % U64(n_blocks)).astype(np.int32)
            block[often] = n_blocks + (mix(r[often].view(U64)) % U64(n_blocks)).astype(np.int32)
            yield from out.add(block, c, r, np.abs(n))
        yield from out.done()

    return to_blocks(packed, SUB).mapInArrow(run, BLOCK_DDL)


_CHAIN_DDL = "src bigint, dst bigint, col bigint, bucket int"
_CHAIN = pa.schema([("src", pa.int64()), ("dst", pa.int64()), ("col", pa.int64()), ("bucket", pa.int32())])


def _chains(packed: DataFrame, p: JaccardJoin, n_blocks: int) -> DataFrame:
    """Edges (src, dst) between rows that share a column and have compatible sizes: each
    column's rows by size, neighbours linked. For frequent columns, which are spread over
    blocks, also the least row of each (column, size bucket), to be linked across blocks."""
    ratio = 100 / p.percent

    def run(batches):
        for number, (c, r, n) in grouped_blocks(batches, _ENTRY):
            c, r, n = _in_order(c, r, n)
            near = _near(c, r, n, p.percent)
            edges = np.unique(np.stack([r[1:][near], r[:-1][near]], axis=1), axis=0) if near.any() else np.zeros((0, 2), np.int64)
            none = pa.nulls(len(edges), pa.int64())
            yield pa.record_batch([pa.array(edges[:, 0]), pa.array(edges[:, 1]), none, none.cast(pa.int32())], schema=_CHAIN)
            if number >= n_blocks:
                bucket = np.floor(np.log(n) / np.log(ratio)).astype(np.int32)
                new = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (bucket[1:] != bucket[:-1])]))
                low = np.minimum.reduceat(r, new)
                # the block's rows of a bucket are tied to its least row, whatever their exact sizes
                tie = np.repeat(low, np.diff(np.append(new, len(r))))
                other = tie != r
                pairs = np.unique(np.stack([r[other], tie[other]], axis=1), axis=0)
                none = pa.nulls(len(pairs), pa.int64())
                yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), none, none.cast(pa.int32())], schema=_CHAIN)
                none = pa.nulls(len(new), pa.int64())
                yield pa.record_batch([pa.array(low), none, pa.array(c[new].view(np.int64)), pa.array(bucket[new])], schema=_CHAIN)

    return to_blocks(packed, SUB).mapInArrow(run, _CHAIN_DDL)


def _candidate_edges(chains: DataFrame) -> DataFrame:
    direct = chains.where("dst IS NOT NULL").select("src", "dst")
    ends = chains.where("dst IS NULL").select("src", "col", "bucket").distinct()
    least = ends.groupBy("col", "bucket").agg(F.min("src").alias("dst"))
    across = ends.join(least, ["col", "bucket"]).select("src", "dst")
    # rows of neighbouring buckets may still be of compatible size
    up = least.select("col", (F.col("bucket") + 1).alias("bucket"), F.col("dst").alias("src"))
    beside = up.join(least, ["col", "bucket"]).select("src", "dst")
    return direct.unionByName(across).unionByName(beside).where("src <> dst")


# -- 3. row blocks -----------------------------------------------------------

def _row_filter(rows: DataFrame, most: int) -> np.ndarray:
    """A bitmap of the rows' text marks, of 16 bits per row up to ``most`` bits."""
    n = rows.count()
    bits = 1 << 16
    while bits < min(16 * n, most):
        bits *= 2
    place = F.col("mark").bitwiseAND(F.lit(bits - 1)) + 1
    parts = rows.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("m"))
    out = np.zeros(bits // 8, dtype=np.uint8)
    for b, m in parts.collect():  # at most ``most`` / 8 bytes
        out[(b - 1) * 4096 : b * 4096] = np.frombuffer(m, dtype=np.uint8)[: len(out) - (b - 1) * 4096]
    return out


def _texts_of(docs: DataFrame, rows: DataFrame, p: JaccardJoin) -> DataFrame:
    """Rows (doc_id, mark, ...) with the texts of their documents. The filter keeps most other
    texts out of the shuffle; the join decides."""
    bitmap = docs.sparkSession.sparkContext.broadcast(_row_filter(rows, p.filter_bits))

    def run(batches):
        bits = bitmap.value
        for batch in batches:
            at = batch.column(1).to_numpy() & (len(bits) * 8 - 1)
            yield batch.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))

    some = docs.mapInArrow(run, docs.schema)
    r = rows.withColumnsRenamed({"doc_id": "row_doc_id", "mark": "row_mark"})
    return some.join(r, (F.col("mark") == F.col("row_mark")) & F.col("doc_id").eqNullSafe(F.col("row_doc_id")))


def link_rows(nodes: np.ndarray, label: np.ndarray, check: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect classes: (src, dst) nodes.

    ``check`` marks the rows whose overlaps with all rows are counted; pairs
    already in one class (``label``) are left out. The product runs over
    blocks of rows: for each, its rows' columns are expanded to the rows that
    stand in them and counted per pair.
    """
    m = len(nodes)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    order = np.argsort(sizes, kind="stable")
    nodes, label, check, sizes = nodes[order], label[order].copy(), check[order], sizes[order]
    sets = [sets[i] for i in order]
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(m), sizes)
    by = np.argsort(flat, kind="stable")
    f = flat[by]
    new = np.concatenate([[True], f[1:] != f[:-1]])
    col_start = np.flatnonzero(new)
    col_len = np.diff(np.append(col_start, len(f)))
    col = np.empty(len(f), dtype=np.int64)
    col[by] = np.cumsum(new) - 1
    rows_of = row[by]  # rows of each column, columns one after the other
    first = np.concatenate([[0], np.cumsum(sizes)])
    low = np.searchsorted(100 * sizes, percent * sizes)  # rows of compatible size: low[x] .. high[x] - 1
    high = np.searchsorted(percent * sizes, 100 * sizes, side="right")
    src, dst = [], []
    for x in np.flatnonzero(check).tolist():
        a, b = int(low[x]), int(high[x])
        if (label[a:b] == label[x]).all():
            continue
        cols = col[first[x] : first[x + 1]]
        cols = cols[col_len[cols] > 1]
        if not len(cols):
            continue
        length = col_len[cols]
        begin = np.cumsum(length) - length
        at = np.repeat(col_start[cols] - begin, length) + np.arange(int(length.sum()))
        overlap = np.bincount(rows_of[at], minlength=m)[a:b]
        linked = (100 * overlap >= percent * (sizes[x] + sizes[a:b] - overlap)) & (label[a:b] != label[x])
        if linked.any():
            merged, where = np.unique(label[a:b][linked], return_index=True)
            src += [nodes[x]] * len(merged)
            dst += nodes[a:b][linked][where].tolist()
            label[np.isin(label, merged)] = label[x]
    return np.array(src, dtype=np.int64), np.array(dst, dtype=np.int64)


_LINK = pa.schema([("src", pa.int64()), ("dst", pa.int64())])


def _links(docs: DataFrame, rows: DataFrame, p: JaccardJoin) -> DataFrame:
    """Links among rows (key, node, label, checked, doc_id, mark), each key's rows being a row block."""
    k, percent = p.words, p.percent
    cols = ["key", "node", "label", "checked", "text"]
    blocked = _texts_of(docs, rows, p).select(*cols).repartition(n_parts(docs.sparkSession), "key").sortWithinPartitions("key")

    def solve(held):
        nodes = np.array(list(held), dtype=np.int64)
        label, check, sets = zip(*held.values())
        out = link_rows(nodes, np.array(label, dtype=np.int64), np.array(check), list(sets), percent)
        return pa.record_batch([pa.array(x) for x in out], schema=_LINK)

    def run(batches):
        now, held = None, {}
        for block in blocks(batches, "text"):
            keys, nodes, labels, checks = (block.rows.column(i).to_pylist() for i in range(4))
            for key, node, label, check, s in zip(keys, nodes, labels, checks, shingle_sets(block, k)):
                if key != now:
                    if len(held) > 1:
                        yield solve(held)
                    now, held = key, {}
                held[node] = (label, check or (node in held and held[node][1]), s)
        if len(held) > 1:
            yield solve(held)

    return stored(blocked.mapInArrow(run, "src bigint, dst bigint"), "jaccard-links")


_WIDE = [np.uint64, np.int64, np.int32, np.int32]  # column, row, row's size, the column's place in the order
_FREQUENT = 1 << 30  # places from here on are of frequent columns


def _whole_rows(docs: DataFrame, rows: DataFrame, p: JaccardJoin, frequent, n_blocks: int) -> DataFrame:
    """All entries of the rows' sets by column block; frequent columns in ``n_blocks`` more blocks, by row."""
    k = p.words

    def emit(held):
        c, r, n = (np.concatenate(x) for x in zip(*held))
        keys, ranks = frequent.value
        place = np.zeros(len(c), dtype=np.int32)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, c), len(keys) - 1)
            place = np.where(keys[at] == c, _FREQUENT + ranks[at], 0).astype(np.int32)
        often = place > 0
        block = (mix(c) % U64(n_blocks)).astype(np.int32)
        block[often] = n_blocks + (mix(r[often].view(U64)) % U64(n_blocks)).astype(np.int32)
        yield from pack_blocks(block, [c, r, n, place], BLOCK_SCHEMA)

    def run(batches):
        held, size = [], 0
        for block in blocks(batches, "text"):
            for node, s in zip(block.rows.column(0).to_pylist(), shingle_sets(block, k)):
                held.append((s, np.full(len(s), node, np.int64), np.full(len(s), len(s), np.int32)))
                size += len(s)
            if size >= FLUSH:
                yield from emit(held)
                held, size = [], 0
        if size:
            yield from emit(held)

    return _texts_of(docs, rows, p).select("node", "text").mapInArrow(run, BLOCK_DDL)


def _counted(packed: DataFrame, p: JaccardJoin, n_blocks: int) -> DataFrame:
    """Entries of columns in which two rows of compatible size stand, blocked by row, with the
    column's place: its number of rows. A negative size marks entries with another row of
    compatible size; those of frequent columns, whose rows are spread over blocks, all have one."""

    def run(batches):
        out = _Gather()
        for number, (c, r, n, place) in grouped_blocks(batches, _WIDE):
            if number < n_blocks:
                c, r, n = _in_order(c, r, n)
                once = np.ones(len(c), dtype=bool)  # a row may come from several documents
                once[1:] = (c[1:] != c[:-1]) | (r[1:] != r[:-1])
                c, r, n = c[once], r[once], n[once]
                near = _near(c, r, n, p.percent)
                both = np.append(near, False) | np.insert(near, 0, False)
                new = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
                count = np.diff(np.append(new, len(c)))
                live = np.repeat(np.logical_or.reduceat(both, new), count)
                place = np.repeat(np.minimum(count, _FREQUENT - 1), count).astype(np.int32)
                n = np.where(both, -n, n).astype(np.int32)
                c, r, n, place = c[live], r[live], n[live], place[live]
            else:
                n = -n
            yield from out.add((mix(r.view(U64)) % U64(n_blocks)).astype(np.int32), c, r, n, place)
        yield from out.done()

    return to_blocks(packed, SUB).mapInArrow(run, BLOCK_DDL)


def _rarest(packed: DataFrame, p: JaccardJoin, n_blocks: int) -> DataFrame:
    """Of rows that share as many columns as a link needs, the first entries, one of which a
    linked row shares, blocked by column. Columns that ``_counted`` left out come before all
    others in the order, then rare ones."""

    def run(batches):
        out = _Gather()
        for _, (c, r, n, place) in grouped_blocks(batches, _WIDE):
            order = np.lexsort((c, place, r))
            c, r, n, place = c[order], r[order], n[order], place[order]
            once = np.ones(len(c), dtype=bool)
            once[1:] = (c[1:] != c[:-1]) | (r[1:] != r[:-1])
            c, r, n, place = c[once], r[once], n[once], place[once]
            new = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
            count = np.diff(np.append(new, len(r)))
            size = np.abs(n[new]).astype(np.int64)
            need = -(-p.percent * size // 100)
            first = size - need + 1 - (size - count)
            first[np.add.reduceat((n < 0).astype(np.int64), new) < need] = 0
            keep = np.arange(len(r)) - np.repeat(new, count) < np.repeat(first, count)
            c, r, n, often = c[keep], r[keep], np.abs(n[keep]), place[keep] >= _FREQUENT
            block = (mix(c) % U64(n_blocks)).astype(np.int32)
            block[often] = n_blocks + (mix(r[often].view(U64)) % U64(n_blocks)).astype(np.int32)
            yield from out.add(block, c, r, n)
        yield from out.done()

    return to_blocks(packed, SUB).mapInArrow(run, BLOCK_DDL)


def _refined(docs: DataFrame, rows: DataFrame, p: JaccardJoin, frequent, n_blocks: int) -> DataFrame:
    """(node, component) of rows (node, doc_id, mark) by a smaller graph that still holds all
    their links; rows that link with none may be missing."""
    whole = _whole_rows(docs, rows, p, frequent, n_blocks)
    first = _rarest(_counted(whole, p, n_blocks), p, n_blocks)
    return components(_candidate_edges(stored(_chains(first, p, n_blocks), "jaccard-chains")))


def _sized(rows: DataFrame, p: JaccardJoin) -> DataFrame:
    """Rows of components of several rows, with the row blocks that each asks for (``parts``)."""
    size = rows.groupBy("component").agg(F.count("*").alias("rows"), F.sum("n_shingles").alias("total")).where("rows > 1")
    parts = F.greatest(F.ceil(F.col("rows") / p.block_rows), F.ceil(F.col("total") / p.block_shingles)).cast("int")
    return stored(rows.join(size.withColumn("parts", parts), "component"), "jaccard-rows")


def _row_links(docs: DataFrame, rows: DataFrame, p: JaccardJoin, frequent, n_blocks: int) -> DataFrame:
    """All links that matter among rows (component, node, n_shingles, doc_id, mark)."""
    rows = _sized(rows, p)
    large = rows.where("parts > 1").select("node", "n_shingles", "doc_id", "mark")
    if not large.isEmpty():
        again = _refined(docs, large.select("node", "doc_id", "mark"), p, frequent, n_blocks)
        rows = rows.where("parts = 1").unionByName(_sized(large.join(again, "node"), p))
    own = [F.col("node").alias("label"), F.lit(True).alias("checked"), "doc_id", "mark"]
    small = rows.where("parts = 1").select(F.xxhash64("component").alias("key"), "node", *own)
    large = rows.where("parts > 1").withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    # About 16 pivot rows of a large component stand in all its blocks.
    pivot = F.pmod(F.xxhash64("node", F.lit(7)), F.greatest(F.lit(1), (F.col("rows") / 16).cast("bigint"))) == 0
    everywhere = F.sequence(F.lit(0), F.col("parts") - 1)
    spread = large.withColumn("part", F.explode(F.when(pivot, everywhere).otherwise(F.array("part"))))
    links = _links(docs, small.unionByName(spread.select(F.xxhash64("component", "part").alias("key"), "node", *own)), p)
    if large.isEmpty():
        return links
    large = large.join(components(links).withColumnRenamed("component", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    most = large.groupBy("component", "label").count().groupBy("component").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
    large = stored(large.join(most, "component"), "jaccard-rows")
    outside = large.where("label <> main")
    out_parts = F.ceil(F.greatest(F.count("*") / p.block_rows, F.sum("n_shingles") / p.block_shingles)).cast("int")
    out_parts = outside.groupBy("component").agg(out_parts.alias("out_parts"))
    outer = outside.join(out_parts, "component").withColumn("out_part", F.pmod(F.xxhash64("node", F.lit(11)), "out_parts").cast("int")).withColumn("part", F.explode(everywhere))
    inner = large.join(out_parts, "component").withColumn("out_part", F.explode(F.sequence(F.lit(0), F.col("out_parts") - 1)))
    keep = [F.xxhash64("component", "part", "out_part").alias("key"), "node", "label"]
    both = outer.select(*keep, F.lit(True).alias("checked"), "doc_id", "mark").unionByName(inner.select(*keep, F.lit(False).alias("checked"), "doc_id", "mark"))
    # Stored, as Spark would take it for as small as ``large`` and broadcast it.
    return links.unionByName(_links(docs, stored(both, "jaccard-pairs"), p))


# -- the operator ------------------------------------------------------------


def jaccard_components(docs: DataFrame, p: JaccardJoin = JaccardJoin()) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id integer, text).

    component_id is the smallest doc_id reachable over links. Rows with a null
    or wordless text have an empty set, link with nothing and keep their own
    doc_id; rows with a null doc_id take part and get the smallest doc_id of
    their component (null if it has none). Repeated rows each get a row; other
    columns are ignored; an empty table gives no rows.
    """
    return _members(docs, p).select("doc_id", "n_shingles", "component_id")


def _members(docs: DataFrame, p: JaccardJoin) -> DataFrame:
    """(doc_id, mark, n_shingles, component_id, root) for every row: ``mark`` is ``xxhash64(text)``;
    ``root`` names the component, null for a row with an empty set."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    found = stored(_classes(docs, p), "jaccard-classes")
    members = found.where("frequent IS NULL").select("doc_id", "mark", "node", "n_shingles")
    often = (
        found.where("frequent IS NOT NULL").groupBy("frequent").agg(F.sum("seen").alias("seen"))
        .orderBy(F.desc("seen"), "frequent").limit(p.frequent_most).collect()
    )
    keys = np.array([r[0] for r in often], dtype=np.int64).view(U64)
    by = np.argsort(keys)
    ranks = np.arange(len(keys), 0, -1, dtype=np.int32)  # the most frequent comes last
    frequent = spark.sparkContext.broadcast((keys[by], ranks[by]))
    n_blocks = SUB * max(1, n_parts(spark) // 2)
    entries = _shared(_column_blocks(docs, p, frequent, n_blocks), p, n_blocks)
    chains = stored(_chains(_strong(entries, p, n_blocks), p, n_blocks), "jaccard-chains")
    candidate = components(_candidate_edges(chains))
    rep = members.where("node IS NOT NULL").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")).alias("r"), F.max("n_shingles").alias("n_shingles"))
    rep = rep.select("node", "r.doc_id", "r.mark", "n_shingles")
    linked = components(_row_links(docs, rep.join(candidate, "node"), p, frequent, n_blocks))
    least = linked.join(rep, "node").groupBy("component").agg(F.min("doc_id").alias("low"))
    lowest = linked.join(least, "component").select("node", "low", "component")
    lowest = rep.select("node", F.col("doc_id").alias("own")).join(lowest, "node", "left").select("node", F.coalesce("low", "own").alias("component_id"), F.coalesce("component", "node").alias("root"))
    joined = members.join(stored(lowest, "jaccard-lowest"), "node", "left")
    return joined.select("doc_id", "mark", "n_shingles", "root", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, p: JaccardJoin = JaccardJoin()) -> DataFrame:
    """One row of each component of ``docs``; rows with an empty set all stay.

    The row with the smallest doc_id stays (a null one stands last), then the
    one with the smallest hash of its text; of rows that agree in both, the
    least by its columns in order. So rows that share a doc_id are judged by
    their own texts. All columns of ``docs`` are returned as they are.
    """
    members = stored(_members(docs, p).select("doc_id", "mark", "root"), "jaccard-members")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "mark")).alias("w")
    won = members.where("root IS NOT NULL").groupBy("root").agg(first).select("root", F.col("w.doc_id").alias("w_id"), F.col("w.mark").alias("w_mark"))
    judged = members.join(won, "root", "left")
    stays = F.col("root").isNull() | (F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("mark") == F.col("w_mark")))
    several = F.col("root").isNotNull() & (F.count("*") > 1)
    rows = judged.where(stays).groupBy("doc_id", "mark", "root").agg(several.alias("several"))
    cols = docs.columns
    row_id, row_mark, kept_id, kept_mark, many = free_names(docs, "row_id", "row_mark", "kept_id", "kept_mark", "several")
    rows = stored(rows.select(F.col("doc_id").alias(kept_id), F.col("mark").alias(kept_mark), F.col("several").alias(many)), "jaccard-kept")
    marked = docs.select(*cols, F.col("doc_id").cast("bigint").alias(row_id), F.xxhash64("text").alias(row_mark))
    found = marked.join(rows, F.col(row_id).eqNullSafe(F.col(kept_id)) & (F.col(row_mark) == F.col(kept_mark)))
    once = found.where(~F.col(many)).select(cols)
    least = found.where(many).groupBy(row_id, row_mark).agg(F.min(F.struct(*cols)).alias("r")).select("r.*")
    return once.unionByName(least)
