"""Best-fit packing: plan over the length histogram, then documents take planned slots.

1. ``pieces``: every document is tokenised in its task; documents longer than
   a sequence are cut into pieces of full length (the first may be shorter).
2. ``plan``: the histogram of piece lengths has at most ``capacity`` counts,
   so it is all that best-fit has to see: lengths from long to short go to
   the open sequences with the least room that still fits, many at a time.
   The result is a list of slot ranges per length.
3. ``pack``: pieces are ranked within their length, and the piece of rank r
   takes the r-th slot planned for its length. Ranks come from counts per
   (length, bucket), so no length, however common, is sorted in one task.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pulse.llm.frames import n_parts, prepare, stored
from pulse.llm.text import SPACE, U64, Block, _range_hash, blocks

#: Distinct words that a worker remembers with their ids before it drops those it met least (about 60 bytes each).
REMEMBER = 800_000
#: Bytes of text that a task works on at a time.
BLOCK_BYTES = 1 << 20
#: Words that are tokenised as one text.
TOGETHER = 200
#: White space that separates words.
WHITE = " \t\n\x0b\x0c\r"

#: Strings that end the search for white space outside ASCII: texts with one of
#: these (as UTF-8 bytes) are tokenised whole.
OTHER_SPACE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


@dataclass(frozen=True)
class Packing:
    tokenizer: str
    capacity: int = 1024
    end_id: int = 2


class WordIds:
    """Ids of texts from the ids of their words.

    The tokenizer splits a text where a word is followed by white space, so a
    text's ids are those of its parts (white space and the word after it) one
    after the other. Each distinct part is tokenised once, many as one text,
    and remembered by its 64-bit hash. Texts with an added token, or with
    white space outside ASCII, are tokenised whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = [*added, *OTHER_SPACE, *(bytes([c]) for c in range(0x1C, 0x20))]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        #: Bytes that each id stands for: a byte-level token has one character for each.
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)
        self.keys, self.place = np.zeros(0, U64), np.zeros(0, np.int32)  # sorted hashes, and where their ids are listed
        self.ids = np.zeros(1 << 16, dtype=np.uint32)
        self.start = np.zeros(1 << 14, dtype=np.int64)
        self.count = np.zeros(1 << 14, dtype=np.int32)
        self.met = np.zeros(1 << 14, dtype=np.int32)  # blocks that had the word
        self.used = 0

    def forget(self) -> None:
        """Drop the half of the words that the fewest blocks had; the others' counts are halved,
        so words that have not come for long go later on."""
        met = self.met[self.place]
        stay = np.sort(np.argsort(-met, kind="stable")[: len(met) // 2])  # by hash, as the keys are
        old = self.place[stay]
        count = self.count[old]
        at = np.cumsum(count, dtype=np.int64) - count
        self.ids = self.ids[np.repeat(self.start[old] - at, count) + np.arange(int(count.sum()))]
        self.used = len(self.ids)
        self.keys, self.place = self.keys[stay], np.arange(len(stay), dtype=np.int32)
        self.start, self.count, self.met = at, count, met[stay] // 2

    def _tokenised(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all parts one after the other, number of ids of each).

        Parts that begin with white space and end with a word may follow each
        other in one text: a word is followed by white space there, as it is
        in documents. The bytes of the ids say where each part ends.
        """
        joins = [i for i, x in enumerate(parts) if x[0] in WHITE and x[-1] not in WHITE]
        alone = sorted(set(range(len(parts))).difference(joins))
        groups = [joins[i : i + TOGETHER] for i in range(0, len(joins), TOGETHER)] + [[i] for i in alone]
        out: list = [None] * len(parts)
        for group in groups:  # one by one: an encoding takes far more memory than its ids
            encoded = self.tokenizer.encode_batch_fast(["".join([parts[i] for i in group])], add_special_tokens=False)[0]
            ids = np.array(encoded.ids, dtype=np.uint32)
            if len(group) == 1:
                out[group[0]] = ids
                continue
            ends = np.cumsum([len(parts[i].encode()) for i in group])
            token_ends = np.cumsum(self.bytes_of[ids])
            cut = np.searchsorted(token_ends, ends)
            if not len(ids) or token_ends[-1] != ends[-1] or (token_ends[np.minimum(cut, len(ids) - 1)] != ends).any():
                # not a byte-level tokenizer, or one that joins words: part by part
                for i in group:
                    out[i] = np.array(self.tokenizer.encode(parts[i], add_special_tokens=False).ids, dtype=np.uint32)
                continue
            begin = 0
            for i, end in zip(group, (cut + 1).tolist()):
                out[i] = ids[begin:end]
                begin = end
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))

    def _learn(self, hashes: np.ndarray, parts: list[str]) -> None:
        """Tokenise parts that are not known (``hashes`` sorted)."""
        flat, lengths = self._tokenised(parts)
        n = len(self.keys)
        while len(self.ids) < self.used + len(flat):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), 1 << 16), np.uint32)])
        while len(self.start) < n + len(parts):
            self.start, self.count, self.met = (np.concatenate([x, np.zeros(max(len(x), 1 << 14), x.dtype)]) for x in (self.start, self.count, self.met))
        self.ids[self.used : self.used + len(flat)] = flat
        self.start[n : n + len(parts)] = self.used + np.cumsum(lengths) - lengths
        self.count[n : n + len(parts)] = lengths
        self.used += len(flat)
        at = np.searchsorted(self.keys, hashes)
        self.keys = np.insert(self.keys, at, hashes)
        self.place = np.insert(self.place, at, np.arange(n, n + len(parts), dtype=np.int32))

    def _places(self, values: np.ndarray, part_of) -> np.ndarray:
        """Where the ids of each of the (sorted) hashes are listed; unknown ones are learnt."""
        at, new = self._unknown(values)
        if len(self.keys) and len(self.keys) + int(new.sum()) > REMEMBER:
            self.forget()
            at, new = self._unknown(values)
        if new.any():
            self._learn(values[new], part_of(np.flatnonzero(new)))
            at = np.searchsorted(self.keys, values)
        place = self.place[at]
        self.met[place] += 1
        return place

    def _unknown(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of the hashes among the keys, True where a hash is not there)."""
        at = np.searchsorted(self.keys, values)
        if not len(self.keys):
            return at, np.ones(len(values), dtype=bool)
        return at, self.keys[np.minimum(at, len(self.keys) - 1)] != values

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, each document's first place in them; n + 1) of a block."""
        buf, off = block.buf, block.off
        n = len(block)
        data = buf.tobytes()
        rare = self._documents_with(data, off)
        if not len(buf):
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        space = SPACE[buf]
        begin = np.zeros(len(buf), dtype=bool)
        begin[1:] = space[1:] & ~space[:-1]
        begin[off[:-1][off[:-1] < len(buf)]] = True
        s = np.flatnonzero(begin)
        e = np.append(s[1:], len(buf))
        doc = np.searchsorted(off, s, side="right") - 1
        if rare:
            keep = ~np.isin(doc, rare)
            s, e, doc = s[keep], e[keep], doc[keep]
        h = self._hashes(buf, s, e)
        values, first, code = np.unique(h, return_index=True, return_inverse=True)

        def part_of(which):
            at = first[which]
            return [data[a:b].decode("utf-8", "replace") for a, b in zip(s[at].tolist(), e[at].tolist())]

        place = self._places(values, part_of)[code]
        count = self.count[place].astype(np.int64)
        begin_at = np.cumsum(count) - count
        ids = self.ids[np.repeat(self.start[place] - begin_at, count) + np.arange(int(count.sum()))]
        per_doc = np.bincount(doc, weights=count, minlength=n).astype(np.int64)
        if not rare:
            return ids, np.concatenate([[0], np.cumsum(per_doc)])
        bounds = np.concatenate([[0], np.cumsum(per_doc)])
        pieces = [ids[bounds[i] : bounds[i + 1]] for i in range(n)]
        for i in rare:
            text = data[off[i] : off[i + 1]].decode("utf-8", "replace")
            pieces[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.concatenate(pieces), np.concatenate([[0], np.cumsum([len(x) for x in pieces])])

    def _documents_with(self, data: bytes, off: np.ndarray) -> list[int]:
        found = set()
        for token in self.whole:
            at = data.find(token)
            while at >= 0:
                i = int(np.searchsorted(off, at, side="right")) - 1
                found.add(i)
                at = data.find(token, int(off[i + 1]))
        return sorted(found)

    @staticmethod
    def _hashes(buf, s, e, chunk: int = 1 << 21):
        """Hashes of byte ranges, for a bounded stretch of bytes at a time."""
        out, i = np.zeros(len(s), dtype=U64), 0
        while i < len(s):
            j = max(i + 1, int(np.searchsorted(e, s[i] + chunk, side="right")))
            a = int(s[i])
            out[i:j] = _range_hash(buf[a : int(e[j - 1])], s[i:j] - a, e[i:j] - a)
            i = j
        return out


_ENCODERS: dict[str, WordIds] = {}

_PIECE = pa.schema([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def pieces(docs: DataFrame, p: Packing, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) for each piece of each document.

    A null text is an empty one (its only token is the end id). Rows with one
    doc_id are separate documents; other columns are ignored.
    """
    prepare(docs.sparkSession)
    path, room, end = p.tokenizer, p.capacity, p.end_id
    id_type = docs.schema["doc_id"].dataType

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _ENCODERS.get(path)
        if encoder is None:
            encoder = _ENCODERS[path] = WordIds(path)
        for block in blocks(batches, "text", BLOCK_BYTES):
            ids, first = encoder.encode(block)
            n = len(block)
            all_ids = np.full(len(ids) + n, end, dtype="<u4")
            ends = first[1:] + np.arange(n)
            keep = np.ones(len(all_ids), dtype=bool)
            keep[ends] = False
            all_ids[keep] = ids
            begin = np.concatenate([[0], ends[:-1] + 1])
            size = ends + 1 - begin
            count = -(-size // room)
            doc = np.repeat(np.arange(n), count)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            head = size - (count - 1) * room  # the first piece's length
            start = np.where(piece == 0, 0, head[doc] + (piece - 1) * room)
            length = np.where(piece == 0, head[doc], room)
            at = begin[doc] + start
            view = memoryview(all_ids).cast("B")
            crc = [zlib.crc32(view[4 * a : 4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist())]
            columns = [block.rows.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
            names = ["doc_id", *_PIECE.names]
            if with_ids:
                columns.append(pa.array([all_ids[a : a + k] for a, k in zip(at.tolist(), length.tolist())], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("piece", T.IntegerType()), *(T.StructField(x, T.LongType()) for x in ("start", "length", "ids_crc32"))])
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.LongType()))
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Slot ranges (length, first rank, count, first sequence, offset) by best-fit over counts.

    Sequences are numbered from 0; those of a group have equal contents. A
    group has its first sequence, its number and its filled length; a length
    takes the fullest groups that still have room, opening new ones at last.
    """
    by_room: dict[int, list[tuple[int, int]]] = {}  # free room -> groups (first sequence, number)
    slots, next_sequence = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = min((r for r, groups in by_room.items() if r >= length and groups), default=None)
            if room is None:  # as many as fit next to each other in one new sequence
                per = capacity // length
                whole, rest = divmod(left, per)
                for number, fill in ((whole, per), (1 if rest else 0, rest)):
                    if number:
                        for k in range(fill):
                            slots.append((length, rank, number, next_sequence, k * length))
                            rank += number
                        by_room.setdefault(capacity - fill * length, []).append((next_sequence, number))
                        next_sequence += number
                left = 0
                break
            first, number = by_room[room].pop()
            used = min(number, left)
            slots.append((length, rank, used, first, capacity - room))
            by_room.setdefault(room - length, []).append((first, used))
            if used < number:
                by_room[room].append((first + used, number - used))
            rank += used
            left -= used
    return slots


def pack(found: DataFrame, p: Packing) -> DataFrame:
    """``found`` (rows with ``length``) with sequence_id and offset, gapless from 0 in each sequence."""
    spark = found.sparkSession
    # the histogram has at most ``capacity`` rows
    histogram = {r[0]: r[1] for r in found.groupBy("length").count().collect()}
    slots = plan(histogram, p.capacity)
    buckets = max(1, sum(histogram.values()) // 20_000)
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))
    keyed = found.withColumn("_bucket", bucket)
    counts = keyed.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    # one row per (length, bucket); a length has at most ``buckets`` of them
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("length", "_bucket", F.coalesce(before, F.lit(0)).alias("_before"))
    order = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = keyed.withColumn("_at", F.row_number().over(order) - 1).join(counts, ["length", "_bucket"]).withColumn("_rank", F.col("_before") + F.col("_at"))
    # The plan's ranges are few (they follow the distinct lengths, not the documents).
    by_length: dict[int, list] = {}
    for s in slots:
        by_length.setdefault(s[0], []).append(s[1:])
    ranges = spark.sparkContext.broadcast({k: np.array(v, dtype=np.int64) for k, v in by_length.items()})
    columns = found.columns

    def take(batches):
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(x)).to_numpy() for x in ("length", "_rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            cut = np.flatnonzero(np.concatenate([[True], length[order][1:] != length[order][:-1]])) if len(rank) else []
            for a, b in zip(cut, [*cut[1:], len(rank)]):
                o = order[a:b]
                r = ranges.value[int(length[o[0]])]
                i = np.searchsorted(r[:, 0], rank[o], side="right") - 1
                sequence[o] = r[i, 2] + rank[o] - r[i, 0]
                offset[o] = r[i, 3]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"])

    schema = T.StructType([*found.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.select(*columns, "_rank").mapInArrow(take, schema)


def pack_documents(docs: DataFrame, p: Packing, with_ids: bool = False) -> DataFrame:
    """Each piece with its place: (doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset)."""
    return pack(stored(pieces(docs, p, with_ids), "packing-pieces"), p)
