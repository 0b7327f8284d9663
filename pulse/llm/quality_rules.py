"""Quality rules: distribution divergence from language references, with guards.

Two histograms of a document are compared with those of its language by
Jensen-Shannon distance: character classes, and common words (the language's
``common_words`` most frequent words and one class for all others). The
references are counted over all documents. A document fails when a distance
is above its limit; documents of fewer than ``min_words`` words are not
judged by divergence, as their histograms say little. Documents of an unknown
or null language are held against the reference they are nearest to.

Base rules (too few words, too many words in repeated 8-word windows) come
before the divergence.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pulse.llm.frames import free_names, n_parts, prepare, stored
from pulse.llm.text import SPACE, U64, Block, blocks, find_words, gram_hashes, gram_starts, mix

#: Character classes by first byte of a code point (a continuation byte belongs to none).
CLASSES = ("lower", "upper", "digit", "space", "stop", "quote", "symbol", "control", "other")
NO_CLASS = len(CLASSES)


def _class_table() -> np.ndarray:
    out = np.full(256, CLASSES.index("symbol"), dtype=np.uint8)
    out[0x61:0x7B] = CLASSES.index("lower")
    out[0x41:0x5B] = CLASSES.index("upper")
    out[0x30:0x3A] = CLASSES.index("digit")
    out[:0x20] = CLASSES.index("control")
    out[SPACE] = CLASSES.index("space")
    for c in b".,;:":
        out[c] = CLASSES.index("stop")
    for c in b"'\"()-":
        out[c] = CLASSES.index("quote")
    out[0x80:0xC0] = NO_CLASS
    out[0xC0:] = CLASSES.index("other")
    return out


CLASS = _class_table()
SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True
LINE_END = np.zeros(256, dtype=bool)
LINE_END[0x0A] = True


@dataclass(frozen=True)
class QualityRules:
    min_base_words: int = 20
    repeat_percent: int = 30
    repeat_window: int = 8
    #: Divergence is judged from this many words on.
    min_words: int = 40
    common_words: int = 100
    #: Jensen-Shannon distances (0 to 1) above which a document fails.
    class_limit: float = 0.3
    word_limit: float = 0.5
    #: References that every task holds, those of the languages with the most words. Documents
    #: of other languages are joined to theirs; those without a language are held against the
    #: nearest of the shared ones.
    shared_languages: int = 500
    #: Languages with a reference of their own, those with the most words first (None: all);
    #: documents of others are held against the nearest shared reference.
    most_languages: int | None = None
    flush: int = 2_000_000


@dataclass
class Counts:
    """Per document of a block."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    classes: np.ndarray  # documents x classes


def _per_doc(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[off])


def _seen_before(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(flag: the document has this key twice or more, flag: and earlier than here)."""
    k = key ^ mix(doc.astype(U64) + U64(1))
    order = np.argsort(k, kind="stable")
    s = k[order]
    same = np.concatenate([[False], s[1:] == s[:-1]]) if len(s) else np.zeros(0, bool)
    twice, later = np.zeros(len(k), bool), np.zeros(len(k), bool)
    later[order] = same
    twice[order] = same | np.append(same[1:], False)[: len(s)]
    return twice, later


def count_block(block: Block, repeat_window: int) -> Counts:
    buf, off = block.buf, block.off
    n = len(block)
    w = find_words(buf, off)
    n_words = w.count()
    classes = np.zeros((n, NO_CLASS + 1), dtype=np.int64)
    word_chars, n_symbols = np.zeros(n, np.int64), np.zeros(n, np.int64)
    step = 1 << 21  # bytes at a time
    for a in range(0, len(buf), step):
        b = buf[a : a + step]
        cut = np.clip(off - a, 0, len(b))
        cls = CLASS[b]
        doc = np.repeat(np.arange(n), np.diff(cut))
        classes += np.bincount(doc * (NO_CLASS + 1) + cls, minlength=n * (NO_CLASS + 1)).reshape(n, -1)
        word_chars += _per_doc((cls != NO_CLASS) & ~SPACE[b], cut)
        n_symbols += _per_doc(SYMBOL[b], cut)
    lines = find_words(buf, off, LINE_END)
    has_word = np.searchsorted(w.start, lines.end) > np.searchsorted(w.start, lines.start)
    line_doc = lines.doc()
    _, later = _seen_before(lines.hash[has_word], line_doc[has_word])
    n_dup_lines = np.bincount(line_doc[has_word][later], minlength=n)
    ok = gram_starts(w.first, repeat_window)
    at = np.flatnonzero(ok)
    word_doc = w.doc()
    twice, _ = _seen_before(gram_hashes(w.hash, repeat_window)[ok], word_doc[at])
    cover = np.zeros(len(w.hash) + 1, dtype=np.int64)
    cover[at[twice]] += 1
    cover[at[twice] + repeat_window] -= 1
    repeated = np.cumsum(cover)[:-1] > 0
    return Counts(n_words, word_chars, n_symbols, n_dup_lines, _per_doc(repeated, w.first), classes[:, :NO_CLASS])


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2, 0 to 1) between rows of counts and rows of probabilities."""
    total = p.sum(axis=-1, keepdims=True)
    p = np.divide(p, total, out=np.zeros(p.shape), where=total > 0)
    m = (p + q) / 2

    def kl(a):
        return np.where(a > 0, a * np.log2(np.where(a > 0, a, 1) / np.where(m > 0, m, 1)), 0).sum(axis=-1)

    return np.sqrt(np.clip((kl(p) + kl(q)) / 2, 0, 1))


# -- references --------------------------------------------------------------

_PART_DDL = "lang string, block int, data binary"
_PART = pa.schema([("lang", pa.string()), ("block", pa.int32()), ("data", pa.binary())])
_COUNT = [np.uint64, np.int64]


Reference = tuple[np.ndarray, np.ndarray, np.ndarray]


def _reference(row) -> Reference:
    """Character-class shares, hashes of the common words (sorted), and their shares followed by
    the share of all other words, from a row (words, classes, top)."""
    classes = np.zeros(NO_CLASS)
    for c in row["classes"] or ():
        classes[c["word"]] = c["n"]
    keys = np.array([t["word"] for t in row["top"] or ()], dtype=np.int64).view(U64)
    order = np.argsort(keys)
    counts = np.array([t["n"] for t in row["top"] or ()], dtype=float)[order]
    words = row["words"]
    return classes / max(classes.sum(), 1), keys[order], np.append(counts, max(words - counts.sum(), 0)) / max(words, 1)


def references(docs: DataFrame, p: QualityRules) -> dict[str, Reference]:
    """The references that every task holds: of the languages with the most words."""
    return _shared(_reference_table(docs, p), p)


def _shared(refs: DataFrame, p: QualityRules) -> dict[str, Reference]:
    rows = refs.orderBy(F.desc("words"), "lang").limit(p.shared_languages).collect()
    return {r["lang"]: _reference(r) for r in rows}


def _reference_table(docs: DataFrame, p: QualityRules) -> DataFrame:
    """(lang, words, classes, top) of each language, counted over all its documents."""
    spark = docs.sparkSession
    n_blocks, keep, flush = n_parts(spark), p.common_words, p.flush
    CLASS_BLOCK = -1

    def emit(classes, words):
        for lang, held in words.items():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            block = (values % U64(n_blocks)).astype(np.int32)
            order = np.argsort(block, kind="stable")
            cut = np.searchsorted(block[order], np.arange(n_blocks + 1))
            data = [values[order[a:b]].tobytes() + counts[order[a:b]].astype(np.int64).tobytes() for a, b in zip(cut[:-1], cut[1:])]
            total = classes[lang]
            data.append(np.arange(len(total), dtype=np.uint64).tobytes() + total.astype(np.int64).tobytes())
            ids = [*range(n_blocks), CLASS_BLOCK]
            rows = [i for i, d in enumerate(data) if d]
            yield pa.record_batch([pa.array([lang] * len(rows)), pa.array([ids[i] for i in rows], pa.int32()), pa.array([data[i] for i in rows], pa.binary())], schema=_PART)

    def run(batches):
        classes, words, size = {}, {}, 0
        for block in blocks(batches, "text"):
            langs = np.asarray(block.rows.column(0).to_pylist(), dtype=object)
            c = np.zeros((len(block), NO_CLASS + 1), dtype=np.int64)
            doc = np.repeat(np.arange(len(block)), np.diff(block.off))
            c += np.bincount(doc * (NO_CLASS + 1) + CLASS[block.buf], minlength=c.size).reshape(c.shape)
            w = find_words(block.buf, block.off, lower=True)
            code, name = {}, []
            of = np.array([code.setdefault(x, len(code)) for x in langs])
            name = list(code)
            word_lang = of[w.doc()]
            for i, lang in enumerate(name):
                classes[lang] = classes.get(lang, 0) + c[of == i, :NO_CLASS].sum(axis=0)
                words.setdefault(lang, []).append(w.hash[word_lang == i])
            size += len(w.hash)
            if size >= flush:
                yield from emit(classes, words)
                classes, words, size = {}, {}, 0
        if words:
            yield from emit(classes, words)

    def total(batches):
        now, held = None, []

        def done():
            data = [np.frombuffer(x, np.uint8) for x in held]
            keys = np.concatenate([x[: len(x) // 2].view(np.uint64) for x in data])
            counts = np.concatenate([x[len(x) // 2 :].view(np.int64) for x in data])
            values, at = np.unique(keys, return_inverse=True)
            sums = np.bincount(at, weights=counts).astype(np.int64)
            top = np.lexsort((values.view(np.int64), -sums))[: max(keep, NO_CLASS)]
            n = len(top)
            first = np.zeros(n, np.int64)
            first[0] = sums.sum()  # the block's total goes with its first row
            return pa.record_batch([pa.array([now[0]] * n), pa.array([now[1]] * n, pa.int32()), pa.array(values[top].view(np.int64)), pa.array(sums[top]), pa.array(first)], names=["lang", "block", "word", "n", "total"])

        for batch in batches:
            for lang, block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if (lang, block) != now:
                    if held:
                        yield done()
                    now, held = (lang, block), []
                held.append(data.as_buffer())
        if held:
            yield done()

    parts = docs.where("lang IS NOT NULL AND length(text) > 0").select("lang", "text").mapInArrow(run, _PART_DDL)
    parts = parts.repartition(n_blocks, "lang", "block").sortWithinPartitions("lang", "block")
    found = stored(parts.mapInArrow(total, "lang string, block int, word bigint, n bigint, total bigint"), "language-words")
    counted = found.where(F.col("block") != CLASS_BLOCK)
    pair = F.collect_list(F.struct("word", "n"))
    totals = counted.groupBy("lang").agg(F.sum("total").alias("words"))
    # at most common_words rows of each block and language meet here
    top = counted.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).where(F.col("r") <= keep)
    classes = found.where(F.col("block") == CLASS_BLOCK).groupBy("lang").agg(pair.alias("classes"))
    refs = totals.join(classes, "lang", "left").join(top.groupBy("lang").agg(pair.alias("top")), "lang", "left")
    if p.most_languages is not None:
        refs = refs.orderBy(F.desc("words"), "lang").limit(p.most_languages)
    return stored(refs, "language-references")


# -- the operator ------------------------------------------------------------


def judge(docs: DataFrame, p: QualityRules = QualityRules()) -> DataFrame:
    """``docs`` (lang, text and any columns) with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, class_distance, word_distance, base_failed and kept.

    A null text has no words and fails the base rules. Distances are null for
    documents that divergence does not judge. Columns of these names in the
    input are replaced; repeated rows are judged alike; an empty table stays
    empty.
    """
    spark = docs.sparkSession
    prepare(spark)
    made = [("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()), ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType()), ("class_distance", T.DoubleType()), ("word_distance", T.DoubleType()), ("base_failed", T.BooleanType()), ("kept", T.BooleanType())]
    docs = docs.drop(*(n for n, _ in made))
    columns = docs.columns
    lang_at = columns.index("lang")
    refs = _reference_table(docs, p)
    held = _shared(refs, p)
    others = None if refs.count() <= len(held) else refs.where(~F.col("lang").isin(list(held)))
    shared = spark.sparkContext.broadcast(held)

    def run(batches):
        for block in blocks(batches, "text"):
            langs = block.rows.column(lang_at).to_pylist()
            if block.rows.num_columns > len(columns):  # each document comes with its language's reference
                own = block.rows.column(len(columns))
                first = {x: i for i, x in reversed(list(enumerate(langs)))}
                refs = {x: _reference(own[i].as_py()) for x, i in first.items() if own[i].is_valid}
            else:
                refs = shared.value
            c = count_block(block, p.repeat_window)
            n = len(block)
            base = (c.n_words < p.min_base_words) | (100 * c.n_repeat_words > p.repeat_percent * c.n_words)
            judged = (c.n_words >= p.min_words) & bool(refs)
            d_class, d_word = np.full(n, np.nan), np.full(n, np.nan)
            if judged.any():
                w = find_words(block.buf, block.off, lower=True)
                word_doc = w.doc()
                lost = any(x not in refs for x in langs)
                for lang in refs if lost else dict.fromkeys(langs):
                    rows = judged & np.array([x == lang or x not in refs for x in langs])
                    if not rows.any():
                        continue
                    shares, keys, words = refs[lang]
                    a = distance(c.classes, shares)
                    mine = rows[word_doc]
                    h, doc = w.hash[mine], word_doc[mine]
                    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    at = np.where(keys[at] == h, at, len(keys))
                    hist = np.bincount(doc * (len(keys) + 1) + at, minlength=n * (len(keys) + 1)).reshape(n, -1)
                    b = distance(hist.astype(float), words)
                    better = rows & ~(a + b >= d_class + d_word)  # also true where there is none yet
                    d_class[better], d_word[better] = a[better], b[better]
            fails = (np.nan_to_num(d_class) > p.class_limit) | (np.nan_to_num(d_word) > p.word_limit)
            nulls = np.isnan(d_class)
            out = [c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words]
            out = [pa.array(x.astype(np.int64)) for x in out] + [pa.array(d_class, mask=nulls), pa.array(d_word, mask=nulls), pa.array(base), pa.array(~base & ~fails)]
            yield pa.RecordBatch.from_arrays([*block.rows.columns[: len(columns)], *out], names=[*columns, *(n for n, _ in made)])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(a, b) for a, b in made)])
    if others is None:
        return docs.mapInArrow(run, schema)
    far = F.col("lang").isNotNull() & ~F.col("lang").isin(list(held))
    key, ref = free_names(docs, "ref_lang", "ref")
    others = others.select(F.col("lang").alias(key), F.struct("words", "classes", "top").alias(ref))
    joined = docs.where(far).join(others, F.col("lang") == F.col(key), "left").select(*(docs[c] for c in columns), ref)
    near = docs.where(~far).unionByName(joined.where(F.col(ref).isNull()).select(columns))
    return near.mapInArrow(run, schema).unionByName(joined.where(F.col(ref).isNotNull()).mapInArrow(run, schema))
