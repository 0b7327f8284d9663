"""Conversation structure repair: the cheapest edits that make roles alternate.

A conversation is well formed if its roles' initials spell ``(s?(ua)+)?``.
Its turns are kept (0), given the role that fits (1) or deleted (2; blank and
repeated turns must go), empty turns are inserted (5), and a truncated turn
that stays adds 5. Among the cheapest ways the one whose edit initials
(D, I, K, R) are least in ASCII order wins.

Both orders are one integer. A weight's high digits are the cost; below them
each edit has a digit of fixed width at its place, the digits of the letters
in ASCII order from 1, and places not yet reached are zero, so a shorter
audit stands before its continuations. Adding an edge's weight to a node's
and taking the integer minimum is all that the dynamic program does.

It runs over a DAG of (turn, last role) nodes. Two ways to one node of one
cost cannot be prefixes of each other (the longer one would hold two more
insertions, which cost 10), so the order of ways never changes when both are
continued alike, and the minimum at each node is enough. For the same reason
stretches of a conversation can be solved apart, for each role before and
after, and joined later.

Turns are dealt by range of (conversation, turn), so a conversation of any
size is spread over tasks and tasks are even. A conversation that lies inside
one task, in one piece, is finished there. The others, at most two a task
besides very long ones, go on as pieces of bounded size: pieces are solved
apart and joined in a balanced way; only their digests need the whole
conversation in one task, which then reads it piece by piece.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from pulse.llm.frames import n_parts, prepare, stored


@dataclass(frozen=True)
class Repair:
    """Costs of the edits and the size of the pieces that are solved at once."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5
    piece_turns: int = 2000
    piece_bytes: int = 4 << 20


SPACE = " \t\n\x0b\x0c\r"
BLANK, CUT = 1, 2  # flags of a turn
START, SYSTEM, USER, ASSISTANT = range(4)  # what stands before the next turn
STATES = (START, SYSTEM, USER, ASSISTANT)
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Where an inserted turn, or one with a new role, leads.
FITTING = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LEGAL = {"su", "ua", "au"}
LETTERS = "DIKR"  # ASCII order; the digit of a letter is its place from 1
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
WIDTH = 3


class Weights:
    """The weights of edits at places 0..places-1 of an audit, and nodes {state: (weight, place)}."""

    def __init__(self, p: Repair, places: int) -> None:
        self.p, self.top = p, WIDTH * places

    def edge(self, cost: int, digit: int, place: int) -> int:
        return (cost << self.top) + (digit << (self.top - WIDTH * (place + 1)))

    @staticmethod
    def put(nodes: dict, state: int, weight: int, place: int) -> None:
        if state not in nodes or weight < nodes[state][0]:
            nodes[state] = (weight, place)

    def insertions(self, nodes: dict) -> dict:
        """The nodes after any insertions: two lead everywhere, more come back at a higher cost."""
        for _ in range(2):
            for state, (weight, place) in list(nodes.items()):
                self.put(nodes, FITTING[state], weight + self.edge(self.p.insert, INSERT, place), place + 1)
        return nodes

    def turn(self, nodes: dict, initial: str, must_go: bool, cut: bool) -> dict:
        """The nodes after one more turn."""
        out: dict = {}
        more = self.p.truncated if cut else 0
        for state, (weight, place) in nodes.items():
            self.put(out, state, weight + self.edge(self.p.delete, DELETE, place), place + 1)
            if must_go:
                continue
            kept = KEPT.get((state, initial))
            if kept is not None:
                self.put(out, kept, weight + self.edge(more, KEEP, place), place + 1)
            self.put(out, FITTING[state], weight + self.edge(self.p.rerole + more, REROLE, place), place + 1)
        return out

    def split(self, weight: int, place: int) -> tuple[int, int, int]:
        """(cost, letters, their digits) of a weight."""
        low = weight & ((1 << self.top) - 1)
        return weight >> self.top, place, low >> (self.top - WIDTH * place)


def solve(turns: list[tuple[str, bool, bool]], before: int, p: Repair) -> dict[int, tuple[int, int, int]]:
    """The cheapest way over the turns (initial, must go, truncated) from the state ``before`` to
    each state, with insertions before each turn: state -> (cost, letters, digits)."""
    # a state costs at most 2 a turn and 2 insertions, which bounds the insertions of its best way
    n = len(turns)
    bound = n + (p.delete * n + 2 * p.insert + p.truncated) // p.insert + 6
    w = Weights(p, bound)
    nodes = {before: (0, 0)}
    for t in turns:
        nodes = w.turn(w.insertions(nodes), *t)
    return {s: w.split(*x) for s, x in nodes.items()}


def chain(a: dict, b: dict) -> dict:
    """Ways over two neighbouring stretches: {before: {after: (cost, letters, digits)}}."""
    most = max(x[1] for to in a.values() for x in to.values()) + max(x[1] for to in b.values() for x in to.values())
    out: dict = {}
    for before, to in a.items():
        best: dict = {}
        for middle, (c, k, digits) in to.items():
            for after, (c2, k2, digits2) in b[middle].items():
                way = (c + c2, k + k2, digits << (WIDTH * k2) | digits2)
                weight = way[0] << (WIDTH * most) | way[2] << (WIDTH * (most - way[1]))
                if after not in best or weight < best[after][0]:
                    best[after] = (weight, way)
        out[before] = {after: way for after, (_, way) in best.items()}
    return out


def closed(ways: dict, p: Repair) -> tuple[int, str]:
    """(cost, audit) of the cheapest way to a well-formed end over a whole conversation."""
    w = Weights(p, 2 + 2)
    ends = {s: {t: w.split(*x) for t, x in w.insertions({s: (0, 0)}).items()} for s in STATES}
    found = chain({START: ways[START]}, ends)[START]
    most = max(k for _, k, _ in found.values())
    cost, k, digits = min((found[s] for s in (START, ASSISTANT) if s in found), key=lambda x: x[0] << (WIDTH * most) | x[2] << (WIDTH * (most - x[1])))
    text = format(digits, "o").zfill(k) if k else ""  # WIDTH is 3: a digit is an octal one
    return cost, text.translate({48 + i + 1: c for i, c in enumerate(LETTERS)})


class Joined:
    """Ways over stretches that come one after the other, joined in a balanced way: each
    stretch's digits are copied as often as the logarithm of their number."""

    def __init__(self) -> None:
        self.held: list[tuple[int, dict]] = []

    def add(self, ways: dict) -> None:
        size = 1
        while self.held and self.held[-1][0] == size:
            _, before = self.held.pop()
            ways, size = chain(before, ways), 2 * size
        self.held.append((size, ways))

    def whole(self) -> dict:
        ways = None
        for _, before in reversed(self.held):
            ways = before if ways is None else chain(before, ways)
        return ways


class Replay:
    """An audit's edits done to the turns as they come, and the digest of what they leave."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.last, self.sha, self.first = audit, 0, "", hashlib.sha256(), True

    def _put(self, out: list, role: str | None, text: str) -> None:
        if role is None:
            role = "assistant" if self.last == "u" else "user"
        self.last = role[:1]
        out.append({"role": role, "text": text})
        self.sha.update((("" if self.first else "\n") + role + ":" + text).encode())
        self.first = False

    def inserted(self, out: list) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._put(out, None, "")
            self.at += 1

    def turn(self, out: list, role: str, text: str) -> None:
        self.inserted(out)
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            self._put(out, role if letter == "K" else None, text)


@dataclass
class Counts:
    """What a report counts, over one stretch or several neighbouring ones."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0  # distinct, nulls apart
    low: int | None = None
    high: int | None = None
    first: str | None = None  # initial of the first and the last turn
    last: str | None = None

    def turn(self, turn: int | None, initial: str, n: int, blank: bool, seen: bool, cut: bool) -> None:
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.last = initial
        self.illegal += (n - 1) * (initial + initial not in LEGAL)
        self.blank += n * blank
        self.duplicate += (n - 1 + seen) * (not blank)
        self.truncated += cut and not blank and not seen
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def add(self, o: Counts) -> None:
        if o.first is None:
            return
        self.illegal += o.illegal + (self.last is not None and self.last + o.first not in LEGAL)
        self.blank += o.blank
        self.duplicate += o.duplicate
        self.truncated += o.truncated
        self.turns += o.turns - (o.low is not None and o.low == self.high)
        self.low = o.low if self.low is None else self.low
        self.high = self.high if o.high is None else o.high
        self.first, self.last = o.first if self.first is None else self.first, o.last

    def report(self, cost: int, audit: str, sha: str) -> dict:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal, "cost": cost, "audit": audit, "repaired_sha256": sha}


@dataclass
class Piece:
    """Neighbouring turns of one conversation."""

    turn: list = field(default_factory=list)
    role: list = field(default_factory=list)
    text: list = field(default_factory=list)
    flags: list = field(default_factory=list)
    copies: list = field(default_factory=list)
    mark: list = field(default_factory=list)

    def read(self, seen: set) -> tuple[Counts, list[tuple[str, bool, bool]]]:
        """The counts and the turns to solve; ``seen`` holds the marks of earlier turns."""
        counts, turns = Counts(), []
        for turn, role, flags, n, mark in zip(self.turn, self.role, self.flags, self.copies, self.mark):
            if not n:
                continue
            initial, blank, cut, known = role[:1], bool(flags & BLANK), bool(flags & CUT), mark in seen
            seen.add(mark)
            counts.turn(turn, initial, n, blank, known, cut)
            turns.append((initial, blank or known, cut))
            turns += [(initial, True, cut)] * (n - 1)
        return counts, turns

    def replay(self, edits: Replay) -> list[dict]:
        out: list = []
        for role, text, n in zip(self.role, self.text, self.copies):
            for _ in range(n):
                edits.turn(out, role, text)
        return out


REPORT = "struct<gaps:bigint,blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint,cost:bigint,audit:string,repaired_sha256:string>"
REPAIRED = "array<struct<role:string,text:string>>"
PIECE = "turn array<bigint>, role array<string>, text array<string>, flags array<int>, copies array<bigint>, mark array<binary>"
FIELDS = [x.split()[0] for x in PIECE.split(", ")]


def _schema(df: DataFrame, ddl: str) -> T.StructType:
    """conv_id as in ``df``, then the columns of ``ddl``."""
    return T.StructType([T.StructField("conv_id", df.schema["conv_id"].dataType), *T.StructType.fromDDL(ddl).fields])


def _batch(rows: list[dict], schema: T.StructType) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(schema))


def _turns(rows: DataFrame, copies: str | None) -> DataFrame:
    """Equal turns counted, with the turn's flags and mark, dealt and sorted by range."""
    n = F.lit(1) if copies is None else F.coalesce(F.col(copies), F.lit(0))
    t = rows.select("conv_id", F.col("turn").cast("bigint"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), n.cast("bigint").alias("copies"))
    t = t.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    end = F.rtrim("text", F.lit(SPACE))
    flags = F.when(end == "", BLANK).when(~F.right(end, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(0)
    mark = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    t = t.select("conv_id", "turn", "role", "text", flags.cast("int").alias("flags"), "copies", mark.alias("mark"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("mark")]
    return t.repartitionByRange(n_parts(rows.sparkSession), *order).sortWithinPartitions(*order)


def _cut(turns: DataFrame, p: Repair) -> DataFrame:
    """Finished conversations (report, repaired), and pieces of those that may go on elsewhere."""
    out = _schema(turns, f"chunk int, repaired {REPAIRED}, report {REPORT}, {PIECE}")

    def finished(conv, piece):
        counts, todo = piece.read(set())
        cost, audit = closed({START: solve(todo, START, p)}, p)
        edits = Replay(audit)
        repaired = piece.replay(edits)
        edits.inserted(repaired)
        return {"conv_id": conv, "chunk": 0, "repaired": repaired, "report": counts.report(cost, audit, edits.sha.hexdigest())}

    def opened(conv, at, piece):
        return {"conv_id": conv, "chunk": at, **{f: getattr(piece, f) for f in FIELDS}}

    def run(batches):
        now, piece, whole, size, edge, at = None, None, True, 0, True, 0
        ready, weight = [], 0
        for batch in batches:
            for conv, *row in zip(*(c.to_pylist() for c in batch.columns)):
                new = piece is None or conv != now
                if new or size >= p.piece_bytes or len(piece.turn) >= p.piece_turns:
                    if piece is not None:
                        ready.append(finished(now, piece) if new and whole and not edge else opened(now, at, piece))
                        weight += size
                        edge = edge and not new
                        at += 1
                    whole, piece, size, now = new, Piece(), 0, conv
                if weight >= p.piece_bytes or len(ready) >= 1000:
                    yield _batch(ready, out)
                    ready, weight = [], 0
                for f, x in zip(("turn", "role", "text", "flags", "copies", "mark"), row):
                    getattr(piece, f).append(x)
                size += len(row[1]) + len(row[2]) + 64
        if piece is not None:
            ready.append(opened(now, at, piece))
            yield _batch(ready, out)

    return turns.mapInArrow(run, out)


def _known(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``known``: the marks that an earlier piece of the conversation holds. A
    mark stands once a piece here, so a text that fills a conversation is one row a piece."""
    here = F.filter(F.arrays_zip("mark", "copies"), lambda x: x["copies"] > 0)
    marks = pieces.select("conv_id", "part", "chunk", F.explode(F.array_distinct(F.transform(here, lambda x: x["mark"]))).alias("mark"))
    place = F.row_number().over(Window.partitionBy("conv_id", "mark").orderBy("part", "chunk"))
    late = marks.withColumn("place", place).where("place > 1").groupBy("part", "chunk").agg(F.collect_list("mark").alias("known"))
    return pieces.join(late, ["part", "chunk"], "left")


def _solved(pieces: DataFrame, p: Repair) -> DataFrame:
    """Each piece's counts and its ways from every state, as text."""
    pieces = pieces.select("conv_id", "part", "chunk", "known", *FIELDS)
    out = _schema(pieces, "part int, chunk int, ways string")

    def run(batches):
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                counts, todo = Piece(*(row[f] for f in FIELDS)).read(set(row["known"] or ()))
                ways = {s: {t: (c, k, hex(d)) for t, (c, k, d) in solve(todo, s, p).items()} for s in STATES}
                done.append({"conv_id": row["conv_id"], "part": row["part"], "chunk": row["chunk"], "ways": json.dumps([counts.__dict__, ways])})
            yield _batch(done, out)

    return pieces.mapInArrow(run, out)


def _joined(pieces: DataFrame, solved: DataFrame, p: Repair) -> DataFrame:
    """Conversations in pieces: all ways first, then the turns, piece by piece."""
    turns = ["role", "text", "copies"]
    first = solved.select("conv_id", F.lit(0).alias("kind"), "part", "chunk", "ways", *(F.lit(None).cast(pieces.schema[c].dataType).alias(c) for c in turns))
    both = first.unionByName(pieces.select("conv_id", F.lit(1).alias("kind"), "part", "chunk", F.lit(None).cast("string").alias("ways"), *turns))
    both = both.repartition(n_parts(pieces.sparkSession), "conv_id").sortWithinPartitions("conv_id", "kind", "part", "chunk")
    out = _schema(pieces, f"chunk int, repaired {REPAIRED}, report {REPORT}")

    def run(batches):
        now, joined, counts, edits, chunk = None, None, None, None, 0

        def last():
            rest: list = []
            edits.inserted(rest)
            report = counts.report(cost, audit, edits.sha.hexdigest())
            return _batch([{"conv_id": now[0], "chunk": chunk, "repaired": rest, "report": report}], out)

        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["conv_id"] != now[0]:
                    if now is not None:
                        yield last()
                    now, joined, counts, edits, chunk = (row["conv_id"],), Joined(), Counts(), None, 0
                if row["kind"] == 0:
                    c, ways = json.loads(row["ways"])
                    counts.add(Counts(**c))
                    joined.add({int(s): {int(t): (x, k, int(d, 16)) for t, (x, k, d) in to.items()} for s, to in ways.items()})
                    continue
                if edits is None:
                    cost, audit = closed(joined.whole(), p)
                    edits = Replay(audit)
                piece = Piece(role=row["role"], text=row["text"], copies=row["copies"])
                yield _batch([{"conv_id": now[0], "chunk": chunk, "repaired": piece.replay(edits), "report": None}], out)
                chunk += 1
        if now is not None:
            yield last()

    return both.mapInArrow(run, out)


def repair(rows: DataFrame, p: Repair = Repair(), copies: str | None = None) -> DataFrame:
    """(conv_id, chunk, repaired, report) for the turns (conv_id, turn, role, text).

    ``repaired`` holds a chunk's turns (role, text) after the edits, chunks in
    order from 0; nearly every conversation has one. ``report`` is null but in
    a conversation's last chunk: gaps, blank, duplicate, truncated and illegal
    counted before the edits, cost, audit and the SHA-256 of the repaired
    ``role:text`` lines. ``copies`` names a column that says how often a row
    stands; a conversation whose rows all have 0 is reported without turns.

    Null roles and texts are one space; a null conv_id is a conversation of
    its own; turns are taken by number, nulls first, and equal numbers by the
    digest of role and text (repeated rows are copies). Other columns are not
    read. An empty table gives an empty table.
    """
    prepare(rows.sparkSession)
    found = stored(_cut(_turns(rows, copies), p).withColumn("part", F.spark_partition_id()), "repair-pieces")
    done = found.where("report IS NOT NULL").select("conv_id", "chunk", "repaired", "report")
    pieces = found.where("report IS NULL").drop("repaired", "report")
    solved = stored(_solved(_known(pieces), p), "repair-ways")
    return done.unionByName(_joined(pieces, solved, p))


def reports(repaired: DataFrame) -> DataFrame:
    """One row a conversation: conv_id and the report."""
    return repaired.where("report IS NOT NULL").select("conv_id", "report.*")


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the faults that op11's contract deals by
    crc32 of ``conv_id:turn`` (a null is one space), modulo 20."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    lot = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(lot == 1, "").when(lot == 2, F.translate(blank("text"), ".!?", "")).when(lot == 0, "").otherwise(blank("text"))
    role = F.when(lot == 4, "user").otherwise(blank("role"))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(lot == 0, 0).when(lot == 3, 2).otherwise(1).alias("copies"))
