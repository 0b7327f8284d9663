"""Language ID: interpolated Kneser-Ney character models in sorted hash arrays.

Texts are reduced to lower-case letters, with one space for every stretch of
other characters. For each language the n-grams of order ``order`` are counted
over all training documents; every one of them is in the model. Lower orders
use continuation counts, as Kneser-Ney prescribes. The model is two tables
that Spark groups from the counts (``Tables``): the counts of each n-gram, and
the total and the number of kinds after each context, by language.

The costs of distinct n-grams come by joins with these tables, order by order.
Those of the commonest (``most_grams``, ``shared_bytes``) are worked out once
and go to every task as sorted hash arrays; a text's other n-grams are joined
to their costs one by one. The bound says which way an n-gram takes, not
whether it counts.

A text gets the language with the lowest cross-entropy per character. The
score is the winner's share after a softmax whose temperature is fitted on
a part of the training documents under a model of the others; the same
documents give the cross-entropy above which the operator can reject
(``rejected``). Then their counts join the others' in the final model.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.llm.frames import batches_of, prepare, stored
from pulse.llm.text import U64, Block, blocks, gram_hashes, string_buffer

SPACE = 0x20
UNKNOWN = "und"
BLOCK_BYTES = 1 << 20  # of text that a task works on at a time


@dataclass(frozen=True)
class LanguageId:
    order: int = 4
    #: n-grams whose costs every task holds, and the bytes of these costs; the others' are joined.
    most_grams: int = 400_000
    shared_bytes: int = 64 << 20
    #: One training document in so many calibrates; its n-grams are counted after that.
    calibrate_every: int = 20
    #: Share of calibrating documents that rejection may lose.
    reject_share: float = 0.001
    #: Characters that a task gathers before it counts.
    flush: int = 1_000_000
    temperatures: tuple = (0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 1.0)


_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    """For each code point its lower case if it is a letter, else a space."""
    global _LETTERS
    if _LETTERS is None:
        out = np.full(0x110000, SPACE, dtype=np.uint32)
        for c in range(0x110000):
            if not 0xD800 <= c < 0xE000 and (x := chr(c)).isalpha():
                low = x.lower()
                out[c] = ord(low) if len(low) == 1 else c
        _LETTERS = out
    return _LETTERS


def characters(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(letters and single spaces of the block, first place of each document; n + 1).

    Every document starts with a space and has none doubled.
    """
    points = np.frombuffer(block.buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    lead = np.concatenate([[0], np.cumsum((block.buf & 0xC0) != 0x80)])
    first = lead[block.off]
    if len(points) != lead[-1]:  # broken UTF-8: decode document by document
        texts = [block.text(i).decode("utf-8", "replace") for i in range(len(block))]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    c = np.insert(_letters()[points], first[:-1], SPACE)
    first = first + np.arange(len(first))
    is_first = np.zeros(len(c) + 1, dtype=bool)
    is_first[first[:-1]] = True
    keep = np.ones(len(c), dtype=bool)
    keep[1:] = (c[1:] != SPACE) | (c[:-1] != SPACE) | is_first[1:-1]
    return c[keep], np.concatenate([[0], np.cumsum(keep)])[first]


def _inside(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """True where an n-gram starts that stays in one document."""
    ok = np.ones(max(0, total - n + 1), dtype=bool)
    for back in range(1, n):
        at = first[1:-1] - back
        ok[at[(at >= 0) & (at < len(ok))]] = False
    return ok


# -- counting ----------------------------------------------------------------

_COUNT = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])


def gram_counts(docs: DataFrame, p: LanguageId) -> DataFrame:
    """(lang, gram, n) of all documents of ``docs`` (lang, text)."""
    order, flush = p.order, p.flush

    def count(held):
        for lang, parts in held.items():
            c = np.concatenate([x for x, _ in parts])
            at = np.cumsum([0] + [len(x) for x, _ in parts])
            ok = np.concatenate([np.append(o, np.zeros(len(x) - len(o), bool)) for x, o in parts])[: max(0, at[-1] - order + 1)]
            h = gram_hashes(c.astype(U64), order)[ok]
            _, first, n = np.unique(h, return_index=True, return_counts=True)
            first = np.flatnonzero(ok)[first]
            flat = c[first[:, None] + np.arange(order)].astype("<u4")
            grams = [x.tobytes().decode("utf-32-le") for x in flat]
            yield from batches_of(_COUNT, [[lang] * len(grams), grams, n.tolist()])

    def run(batches):
        held, size = {}, 0
        for block in blocks(batches, "text", BLOCK_BYTES):
            c, first = characters(block)
            ok = _inside(first, order, len(c))
            langs = block.rows.column(0).to_pylist()
            for lang in dict.fromkeys(langs):
                mine = np.repeat([x == lang for x in langs], np.diff(first))
                if mine.all():
                    held.setdefault(lang, []).append((c, ok))
                else:  # documents of one language one after the other; a gram over a border is out
                    held.setdefault(lang, []).append((c[mine], np.append(ok, np.zeros(len(c) - len(ok), bool))[mine]))
            size += len(c)
            if size >= flush:
                yield from count(held)
                held, size = {}, 0
        if held:
            yield from count(held)

    rows = docs.select("lang", "text").mapInArrow(run, "lang string, gram string, n bigint")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# -- the model ---------------------------------------------------------------


class Model:
    """Kneser-Ney models of several languages in one process, built from counts of the highest order.

    What ``Tables`` gives at any size, for counts that fit in memory.

    ``tables[lang][n]`` = (sorted hashes, discounted probabilities, sorted
    context hashes, weights of the next lower order) for n = 1 .. order.
    """

    def __init__(self, counts: dict[str, dict[str, int]], order: int) -> None:
        self.order, self.langs = order, sorted(counts)
        letters = {c for grams in counts.values() for g in grams for c in g}
        self.floor = 1.0 / (len(letters) + 1)  # probability of any character below order 1
        self.tables = {lang: self._tables(grams) for lang, grams in counts.items()}

    def _tables(self, grams: dict[str, int]) -> list:
        out = [None]
        levels = [grams]
        for _ in range(self.order - 1):  # continuation counts: in how many contexts a shorter gram ends
            lower: dict[str, int] = {}
            for g in levels[-1]:
                lower[g[1:]] = lower.get(g[1:], 0) + 1
            levels.append(lower)
        for level in reversed(levels):
            ones = sum(1 for v in level.values() if v == 1)
            twos = sum(1 for v in level.values() if v == 2)
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            total: dict[str, int] = {}
            kinds: dict[str, int] = {}
            for g, v in level.items():
                total[g[:-1]] = total.get(g[:-1], 0) + v
                kinds[g[:-1]] = kinds.get(g[:-1], 0) + 1
            keys = list(level)
            probs = np.array([max(level[g] - discount, 0) / total[g[:-1]] for g in keys])
            contexts = list(total)
            weights = np.array([discount * kinds[c] / total[c] for c in contexts])
            out.append((*_sorted(keys, probs), *_sorted(contexts, weights)))
        return out

    def score(self, grams: np.ndarray) -> np.ndarray:
        """Negative log2 probability of each gram's last character (rows: grams of code points) in each language."""
        by_order = [None] + [gram_hashes_of(grams[:, self.order - n :]) for n in range(1, self.order + 1)]
        contexts = [None] + [gram_hashes_of(grams[:, self.order - n : -1]) for n in range(1, self.order + 1)]
        out = np.empty((len(grams), len(self.langs)))
        for j, lang in enumerate(self.langs):
            p = np.full(len(grams), self.floor)
            for n in range(1, self.order + 1):
                keys, probs, context_keys, weights = self.tables[lang][n]
                p = _look_up(keys, probs, by_order[n], 0.0) + _look_up(context_keys, weights, contexts[n], 1.0) * p
            out[:, j] = -np.log2(np.maximum(p, 1e-12))
        return out


def gram_hashes_of(rows: np.ndarray) -> np.ndarray:
    """The hash of each row of code points (an empty row has hash 0)."""
    n, k = rows.shape
    if k == 0:
        return np.zeros(n, dtype=U64)
    return gram_hashes(np.ascontiguousarray(rows).reshape(-1).astype(U64), k)[::k] if n else np.zeros(0, U64)


def _sorted(grams: list[str], values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k = len(grams[0]) if grams else 0
    points = np.frombuffer("".join(grams).encode("utf-32-le"), dtype=np.uint32).reshape(len(grams), k)
    h = gram_hashes_of(points)
    order = np.argsort(h)
    return h[order], values[order].astype(np.float32)


def _look_up(keys: np.ndarray, values: np.ndarray, h: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(h), missing)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return np.where(keys[at] == h, values[at], missing)


class Scorer:
    """Cross-entropies of documents; what a worker has scored it keeps (up to ``most`` grams)."""

    def __init__(self, model: Model, most: int = 500_000) -> None:
        self.model, self.most = model, most
        self._forget()

    def _forget(self) -> None:
        self.keys, self.costs = np.zeros(0, U64), np.zeros((0, len(self.model.langs)), np.float32)

    def _costs(self, h: np.ndarray, first: np.ndarray, c: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, h)
        known = np.zeros(len(h), dtype=bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == h
        out = np.empty((len(h), self.costs.shape[1]), dtype=np.float32)
        out[known] = self.costs[at[known]]
        if not known.all():
            new = self.model.score(c[first[~known][:, None] + np.arange(self.model.order)])
            out[~known] = new
            if len(self.keys) + len(new) > self.most:
                self._forget()
            keys = np.concatenate([self.keys, h[~known]])
            order = np.argsort(keys)
            self.keys, self.costs = keys[order], np.concatenate([self.costs, new.astype(np.float32)])[order]
        return out

    def entropies(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(documents x languages mean cost per character, characters scored) of a block."""
        order = self.model.order
        c, first = characters(block)
        ok = _inside(first, order, len(c))
        n, langs = len(block), len(self.model.langs)
        h = gram_hashes(c.astype(U64), order)[ok]
        if not len(h):
            return np.zeros((n, langs)), np.zeros(n, np.int64)
        values, at, code = np.unique(h, return_index=True, return_inverse=True)
        cost = self._costs(values, np.flatnonzero(ok)[at], c)
        upto = np.concatenate([[0], np.cumsum(ok)])[np.minimum(first, len(ok))]
        count = np.diff(upto)
        total = np.stack([np.diff(np.concatenate([[0], np.cumsum(cost[:, j].astype(float)[code])])[upto]) for j in range(langs)], axis=1)
        return total / np.maximum(count, 1)[:, None], count


# -- the model as tables -----------------------------------------------------


@dataclass
class Tables:
    """The models of all languages: ``entries`` (gram, ids, vs) has the counts of each n-gram
    (continuation counts below the highest order), ``contexts`` (context, ids, totals, kinds)
    what follows each context; ids are places in ``langs``, an n-gram's order is its length."""

    order: int
    langs: list[str]
    floor: float  # probability of any character below order 1
    discounts: np.ndarray  # order + 1 x languages
    entries: DataFrame
    contexts: DataFrame

    def costs(self, grams: DataFrame) -> DataFrame:
        """(gram, cost) of the distinct n-grams ``grams`` (gram): float32 of each language,
        negative log2 probability of the last character."""
        ends = [F.expr(f"substring(gram, {i + 1})") for i in range(self.order)]
        wanted = grams.select(F.explode(F.array(*ends)).alias("gram")).distinct().withColumn("context", F.expr("substring(gram, 1, length(gram) - 1)"))
        own = wanted.join(self.entries, "gram", "left").join(self.contexts.withColumnRenamed("ids", "context_ids"), "context", "left")
        own = stored(own.mapInArrow(self._own(), "gram string, prob binary, weight binary"), "language-own")
        lower = None
        for n in range(1, self.order + 1):
            level = own.where(F.length("gram") == n)
            if lower is not None:
                level = level.join(lower.select(F.col("gram").alias("shorter"), F.col("p").alias("low")), F.expr("substring(gram, 2)") == F.col("shorter")).drop("shorter")
            lower = level.mapInArrow(self._interpolate(n), "gram string, p binary")
        return lower.withColumnRenamed("p", "cost")

    def _own(self):
        """Each n-gram's discounted probability and the weight of the next lower order, by language."""
        langs, discounts = len(self.langs), self.discounts

        def run(batches):
            for b in batches:
                m = b.num_rows
                if not m:
                    continue
                discount = discounts[[len(g) for g in b.column("gram").to_pylist()]]
                at, ids = _flat(b.column("context_ids"))
                total, weight = np.ones((m, langs)), np.ones((m, langs))
                total[at, ids] = _flat(b.column("totals"))[1]
                weight[at, ids] = discount[at, ids] * _flat(b.column("kinds"))[1] / total[at, ids]
                at, ids = _flat(b.column("ids"))
                prob = np.zeros((m, langs))
                prob[at, ids] = np.maximum(_flat(b.column("vs"))[1] - discount[at, ids], 0) / total[at, ids]
                yield pa.record_batch([b.column("gram"), _binary(prob), _binary(weight)], names=["gram", "prob", "weight"])

        return run

    def _interpolate(self, n: int):
        langs, floor, last = len(self.langs), self.floor, n == self.order

        def run(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                low = vectors(b.column("low"), np.float64, langs) if n > 1 else floor
                p = vectors(b.column("prob"), np.float64, langs) + vectors(b.column("weight"), np.float64, langs) * low
                if last:
                    p = -np.log2(np.maximum(p, 1e-12)).astype(np.float32)
                yield pa.record_batch([b.column("gram"), _binary(p)], names=["gram", "p"])

        return run


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row of each value, the values) of a column of lists; a null is an empty list."""
    size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), size), lists.flatten().to_numpy(zero_copy_only=False)


def vectors(column: pa.Array, kind, width: int) -> np.ndarray:
    """The rows of a column that ``_binary`` made."""
    return np.frombuffer(string_buffer(column)[0], dtype=kind).reshape(-1, width)


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes as one binary value."""
    data = np.ascontiguousarray(rows).tobytes()
    off = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.itemsize * rows.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(data)])


def tables(counts: DataFrame, order: int) -> Tables | None:
    """The models of ``counts`` (lang, gram, n); None if it is empty."""
    spark = counts.sparkSession
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())  # one row for each language
    if not langs:
        return None
    ids = F.broadcast(spark.createDataFrame(list(enumerate(langs)), "id int, lang string"))
    every = level = counts.join(ids, "lang").select("id", "gram", F.col("n").alias("v"))
    for n in range(order - 1, 0, -1):  # continuation counts: in how many contexts a shorter gram ends
        lower = level.groupBy("id", F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("v"))
        level = stored(lower, f"language-level-{n}")
        every = every.unionByName(level)
    entries = every.groupBy("gram").agg(F.collect_list(F.struct("id", "v")).alias("x"))
    entries = entries.select("gram", F.col("x.id").alias("ids"), F.col("x.v").alias("vs"))
    contexts = every.groupBy(F.expr("substring(gram, 1, length(gram) - 1)").alias("context"), "id").agg(F.sum("v").alias("total"), F.count("*").alias("kind"))
    contexts = contexts.groupBy("context").agg(F.collect_list(F.struct("id", "total", "kind")).alias("x"))
    contexts = contexts.select("context", F.col("x.id").alias("ids"), F.col("x.total").alias("totals"), F.col("x.kind").alias("kinds"))
    seen = every.groupBy(F.length("gram").alias("n"), "id").agg(F.count_if(F.col("v") == 1).alias("ones"), F.count_if(F.col("v") == 2).alias("twos"))
    discounts = np.full((order + 1, len(langs)), 0.5)
    for r in seen.collect():  # one row for each language and order
        if r["ones"] and r["twos"]:
            discounts[r["n"], r["id"]] = r["ones"] / (r["ones"] + 2 * r["twos"])
    entries = stored(entries, "language-entries")
    letters = entries.where(F.length("gram") == order).select(F.explode(F.array(*(F.expr(f"substring(gram, {i + 1}, 1)") for i in range(order))))).distinct().count()
    return Tables(order, langs, 1.0 / (letters + 1), discounts, entries, stored(contexts, "language-contexts"))


@dataclass
class Common:
    """Costs that every task holds: sorted hashes of n-grams, a row of costs for each."""

    order: int
    keys: np.ndarray
    costs: np.ndarray

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(costs, 0 where unknown; True where known)."""
        out = np.zeros((len(h), self.costs.shape[1]))
        if not len(self.keys):
            return out, np.zeros(len(h), dtype=bool)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        known = self.keys[at] == h
        out[known] = self.costs[at[known]]
        return out, known


def common(model: Tables, p: LanguageId) -> Common:
    """The costs of the commonest n-grams of the counts, as many as the bounds let through.

    Counts go in steps of a quarter power of 2; a step is in as a whole or not.
    """
    most = min(p.most_grams, p.shared_bytes // (4 * len(model.langs)))
    top = model.entries.where(F.length("gram") == model.order)
    top = top.select("gram", F.floor(4 * F.log2(F.aggregate("vs", F.lit(0).cast("bigint"), lambda a, x: a + x))).alias("step"))
    least, total = None, 0
    for step, n in sorted(map(tuple, top.groupBy("step").count().collect()), reverse=True):
        total += n
        if total > most:
            break
        least = step
    if least is None:
        return Common(model.order, np.zeros(0, U64), np.zeros((0, len(model.langs)), np.float32))
    found = model.costs(top.where(F.col("step") >= least)).toArrow().combine_chunks()  # at most ``most`` rows
    keys = _hashes(found.column("gram").to_pylist())
    costs = np.concatenate([vectors(c, np.float32, len(model.langs)) for c in found.column("cost").chunks])
    order = np.argsort(keys)
    return Common(model.order, keys[order], costs[order])


def _hashes(grams: list[str]) -> np.ndarray:
    points = np.frombuffer("".join(grams).encode("utf-32-le"), dtype=np.uint32)
    return gram_hashes_of(points.reshape(len(grams), -1))


# -- scoring -----------------------------------------------------------------

_SUMS = [("n_grams_", "bigint"), ("sums_", "binary"), ("rare_", "array<string>"), ("rare_n_", "array<bigint>")]


def _sums(block: Block, common: Common, padded: np.ndarray) -> list[pa.Array]:
    """For each text of a block: its n-grams, the sums of the costs that ``common`` has, and its
    other n-grams with their numbers. Where ``padded``, a text too short for one takes spaces before it."""
    order, n, langs = common.order, len(block), common.costs.shape[1]
    c, first = characters(block)
    ok = _inside(first, order, len(c))
    h = gram_hashes(c.astype(U64), order)[ok]
    count, total = np.zeros(n, np.int64), np.zeros((n, langs))
    rare: dict[int, tuple[list, list]] = {}
    if len(h):
        values, at, code = np.unique(h, return_index=True, return_inverse=True)
        cost, known = common.look_up(values)
        upto = np.concatenate([[0], np.cumsum(ok)])[np.minimum(first, len(ok))]
        count = np.diff(upto)
        full = np.flatnonzero(count)
        for j in range(langs):
            total[full, j] = np.add.reduceat(cost[:, j].astype(np.float32)[code], upto[full], dtype=np.float64)
        unknown = np.flatnonzero(~known[code])
        if len(unknown):
            doc = np.searchsorted(upto, unknown, side="right") - 1
            pair, times = np.unique(doc * len(values) + code[unknown], return_counts=True)
            starts = np.flatnonzero(ok)[at]
            for x, k in zip(pair.tolist(), times.tolist()):
                held = rare.setdefault(x // len(values), ([], []))
                start = starts[x % len(values)]
                held[0].append(c[start : start + order].astype("<u4").tobytes().decode("utf-32-le"))
                held[1].append(k)
    for i in np.flatnonzero((count == 0) & padded).tolist():
        grams = _short(block.text(i), order)
        if grams:
            cost, known = common.look_up(_hashes(grams))
            count[i], total[i] = len(grams), cost.sum(axis=0)
            rest = [g for g, k in zip(grams, known) if not k]
            if rest:
                rare[i] = (rest, [1] * len(rest))
    none = ([], [])
    held = [rare.get(i, none) for i in range(n)]
    return [pa.array(count, pa.int64()), _binary(total), pa.array([x for x, _ in held], pa.list_(pa.string())), pa.array([x for _, x in held], pa.list_(pa.int64()))]


def _short(text: bytes, order: int) -> list[str]:
    """The n-grams of a text with fewer characters than one has, after spaces (none: no letter)."""
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    c = _letters()[points]
    if not (c != SPACE).any():
        return []
    padded = " " * (order - 1) + c.astype("<u4").tobytes().decode("utf-32-le")
    return [padded[i : i + order] for i in range(len(c))]


def _scored(docs: DataFrame, model: Tables, shared, columns: list[str], pad: bool, name: str) -> DataFrame:
    """``columns`` of ``docs`` (has_letter_, text and any columns) with n_grams_ and sums_ over all n-grams of a text.

    The rows are stored without the other columns; only n-grams that ``shared``
    lacks are joined to their costs, once for each text that has them.
    """
    langs = len(model.langs)
    docs = docs.select(*dict.fromkeys([*columns, "has_letter_", "text"]))
    kinds = T.StructType([*(docs.schema[c] for c in columns), docs.schema["has_letter_"], *(T.StructField(a, T._parse_datatype_string(b)) for a, b in _SUMS)])

    def run(batches):
        for block in blocks(batches, "text", BLOCK_BYTES):
            out = _sums(block, shared.value, np.array(block.rows.column("has_letter_")) & pad)
            keep = [*columns, "has_letter_"]
            yield pa.RecordBatch.from_arrays([*(block.rows.column(c) for c in keep), *out], names=[*keep, *(a for a, _ in _SUMS)])

    rows = stored(docs.mapInArrow(run, kinds).withColumn("row_", F.monotonically_increasing_id()), name)
    done = rows.where(F.size("rare_") == 0).drop("rare_", "rare_n_", "row_")
    open_ = rows.where(F.size("rare_") > 0)
    if open_.isEmpty():
        return done
    pairs = open_.select("row_", F.explode(F.arrays_zip("rare_", "rare_n_")).alias("x")).select("row_", F.col("x.rare_").alias("gram"), F.col("x.rare_n_").alias("k"))
    costs = model.costs(stored(pairs.select("gram").distinct(), f"{name}-rare"))
    parts = pairs.join(costs, "gram").select("row_", "k", "cost").repartition("row_").sortWithinPartitions("row_")

    def add(batches):
        now, held = None, np.zeros(langs)
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column("row_").to_numpy()
            part = vectors(b.column("cost"), np.float32, langs) * b.column("k").to_numpy()[:, None].astype(float)
            starts = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1])
            sums, keys = np.add.reduceat(part, starts, axis=0), ids[starts]
            if now == keys[0]:
                sums[0] += held
            elif now is not None:
                yield pa.record_batch([pa.array([now], pa.int64()), _binary(held[None])], names=["row_", "more_"])
            if len(keys) > 1:
                yield pa.record_batch([pa.array(keys[:-1], pa.int64()), _binary(sums[:-1])], names=["row_", "more_"])
            now, held = int(keys[-1]), sums[-1]
        if now is not None:
            yield pa.record_batch([pa.array([now], pa.int64()), _binary(held[None])], names=["row_", "more_"])

    more = parts.mapInArrow(add, "row_ bigint, more_ binary")

    def join(batches):
        for b in batches:
            if b.num_rows:
                total = vectors(b.column("sums_"), np.float64, langs) + vectors(b.column("more_"), np.float64, langs)
                names = [c for c in b.schema.names if c not in ("sums_", "more_")]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), _binary(total)], names=[*names, "sums_"])

    rest = open_.drop("rare_", "rare_n_").join(more, "row_").drop("row_")
    names = [c for c in done.columns if c != "sums_"]
    rest = rest.select(*names, "sums_", "more_").mapInArrow(join, T.StructType([*(done.schema[c] for c in names), done.schema["sums_"]]))
    return done.unionByName(rest)


def _entropies(batch: pa.RecordBatch, langs: int) -> np.ndarray:
    """Mean cost per character of each row in each language."""
    n = batch.column("n_grams_").to_numpy()
    return vectors(batch.column("sums_"), np.float64, langs) / np.maximum(n, 1)[:, None]


# -- fitting -----------------------------------------------------------------


@dataclass
class Fitted:
    model: Tables
    common: Common
    temperature: float
    limit: float  # cross-entropy above which a document is rejected


def fit(train: DataFrame, p: LanguageId = LanguageId()) -> Fitted | None:
    """Models from ``train`` (lang, text), all documents with a non-null lang; None without any.

    Which documents calibrate follows from their texts' hash. Temperature and
    limit are fitted on them under a model of the other documents; the final
    model counts both.
    """
    spark = train.sparkSession
    prepare(spark)
    train = train.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    held = F.pmod(F.xxhash64("text", F.lit(5)), F.lit(p.calibrate_every)) == 0
    counts = stored(gram_counts(train.where(~held), p), "language-grams")
    late = stored(gram_counts(train.where(held), p), "language-held-grams")
    model = tables(counts, p.order)
    if late.isEmpty():  # nothing to calibrate on
        return None if model is None else Fitted(model, common(model, p), *UNCALIBRATED)
    fitted = UNCALIBRATED if model is None else _calibrate(train.where(held), model, p)
    whole = stored(counts.unionByName(late).groupBy("lang", "gram").agg(F.sum("n").alias("n")), "language-all-grams")
    final = tables(whole, p.order)
    return Fitted(final, common(final, p), *fitted)


#: Temperature and limit without a text to fit them on.
UNCALIBRATED = (0.1, float("inf"))


def _calibrate(held: DataFrame, model: Tables, p: LanguageId) -> tuple[float, float]:
    """(temperature, limit) from documents that ``model`` has not counted; those of a language it lacks tell nothing."""
    shared = held.sparkSession.sparkContext.broadcast(common(model, p))
    temperatures, langs = np.array(p.temperatures), model.langs

    def run(batches):
        place = {x: i for i, x in enumerate(langs)}
        for b in batches:
            truth = np.array([place.get(x, -1) for x in b.column("lang").to_pylist()], dtype=np.int64)
            use = (b.column("n_grams_").to_numpy() > 0) & (truth >= 0)
            if use.any():
                cost, truth = _entropies(b, len(langs))[use], truth[use]
                loss = np.stack([-np.log(np.maximum(softmax(cost, t)[np.arange(len(truth)), truth], 1e-9)) for t in temperatures], axis=1)
                yield pa.record_batch([pa.array(cost.min(axis=1)), pa.array(list(loss), pa.list_(pa.float64()))], names=["cost", "loss"])

    told = _scored(held.withColumn("has_letter_", F.lit(True)), model, shared, ["lang"], False, "language-held")
    told = told.mapInArrow(run, "cost double, loss array<double>")
    r = told.agg(F.percentile_approx("cost", 1 - p.reject_share, 10_000).alias("limit"), *(F.avg(F.col("loss")[i]).alias(f"t{i}") for i in range(len(temperatures)))).first()
    losses = [r[f"t{i}"] for i in range(len(temperatures))]
    if losses[0] is None:  # too few documents to calibrate
        return UNCALIBRATED
    return float(temperatures[int(np.argmin(losses))]), float(r["limit"])


def softmax(cost: np.ndarray, temperature: float) -> np.ndarray:
    x = -(cost - cost.min(axis=1, keepdims=True)) / temperature
    e = np.exp(x)
    return e / e.sum(axis=1, keepdims=True)


def identify(docs: DataFrame, fitted: Fitted | None, without: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` (text and any columns, but those of ``without``) with lang_pred, score (0 to 1), cross_entropy and rejected.

    A null text or one without a letter is ``und`` with score 0; so is every
    text if no language was learned. A text too short for an n-gram is scored
    by its characters padded with spaces. Columns of these names in the input
    are replaced; repeated rows get equal answers.
    """
    spark = docs.sparkSession
    prepare(spark)
    made = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("cross_entropy", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    docs = docs.drop(*(f.name for f in made))
    columns = [c for c in docs.columns if c not in without]
    if fitted is None:
        blank = [F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"), F.lit(False).alias("rejected")]
        return docs.select(*columns, *blank)
    shared = spark.sparkContext.broadcast(fitted.common)
    names, temperature, limit = fitted.model.langs, fitted.temperature, fitted.limit

    def run(batches):
        langs = np.array(names, dtype=object)
        for b in batches:
            if not b.num_rows:
                continue
            cost = _entropies(b, len(langs))
            none = ~np.array(b.column("has_letter_"))
            best = cost.argmin(axis=1)
            share = softmax(cost, temperature)[np.arange(len(best)), best]
            low = cost[np.arange(len(best)), best]
            out = [
                pa.array(np.where(none, UNKNOWN, langs[best]).tolist(), pa.string()),
                pa.array(np.where(none, 0.0, share)),
                pa.array(low, mask=none),
                pa.array(~none & (low > limit)),
            ]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), *out], names=[*columns, *(x.name for x in made)])

    marked = docs.withColumn("has_letter_", has_letter(F.col("text")))
    scored = _scored(marked, fitted.model, shared, columns, True, "language-scored")
    return scored.mapInArrow(run, T.StructType([*(docs.schema[c] for c in columns), *made]))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
