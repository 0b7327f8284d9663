"""License scans by diagonal voting.

Every rolling word k-gram of a document is hashed; the hashes join the
templates' (template, position) rows. A shared k-gram votes for the diagonal
``document position - template position``. Votes are summed per diagonal,
neighbouring diagonals of a template (words inserted or left out) are merged,
and a merged span stands if it covers enough of the template's positions.

Two kinds of templates go through the same votes:

* phrases, which must stand word for word: one diagonal, all positions;
* notices, texts of which ``coverage`` must be found, with ``drift``
  diagonals between neighbouring parts.

Tasks send only k-grams that occur in some template to the join; the template
table is checked against ``most_grams`` before its hashes are broadcast for
that, and without the broadcast all k-grams join.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pulse.llm.frames import prepare, stored
from pulse.llm.text import NON_ALNUM, U64, blocks, find_words, gram_hashes, gram_starts

#: Fixed values: (phrase, label) of places that name a license.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

#: Fixed values: (notice, label), the customary texts by which works are put under a license.
NOTICES = [
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files to deal in the software without restriction including without limitation the rights to use "
        "copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom "
        "the software is furnished to do so subject to the following conditions",
        "mit",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
        "isc",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met redistributions of source code must retain the above copyright notice this list of "
        "conditions and the following disclaimer",
        "bsd",
    ),
    (
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www "
        "apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed "
        "under the license is distributed on an as is basis without warranties or conditions of any kind",
        "apache",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version",
        "gpl",
    ),
    (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not "
        "distributed with this file you can obtain one at",
        "mpl",
    ),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("this work is licensed under a creative commons attribution", "cc-by"),
]


@dataclass(frozen=True)
class LicenseScan:
    gram: int = 4  # words of a k-gram; shorter phrases use all their words
    drift: int = 3
    coverage: float = 0.6
    #: Template k-grams that may be broadcast as a filter (8 bytes each).
    most_grams: int = 1 << 20


@dataclass(frozen=True)
class Template:
    number: int
    label: str
    exact: bool
    words: int
    gram: int
    hashes: np.ndarray


def templates(phrases, notices, gram: int) -> list[Template]:
    out = []
    for exact, rows in ((True, phrases), (False, notices)):
        for text, label in rows:
            buf = np.frombuffer(text.encode(), np.uint8)
            w = find_words(buf, np.array([0, len(buf)]), NON_ALNUM, lower=True)
            k = min(gram, len(w.hash))
            out.append(Template(len(out), label, exact, len(w.hash), k, gram_hashes(w.hash, k)))
    return out


_DOC = [T.StructField("n_words", T.LongType()), T.StructField("grams", T.ArrayType(T.StructType([T.StructField("h", T.LongType()), T.StructField("at", T.LongType())])))]


def _grams(docs: DataFrame, found: list[Template], p: LicenseScan) -> DataFrame:
    """(doc_id, n_words, grams): each document's k-grams (hash, word position) that may be a template's."""
    sizes = sorted({t.gram for t in found})
    known = np.unique(np.concatenate([t.hashes for t in found])) if found else np.zeros(0, U64)
    shared = docs.sparkSession.sparkContext.broadcast(known if len(known) <= p.most_grams else None)
    kind = pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int64())]))

    def run(batches):
        keys = shared.value
        for block in blocks(batches, "text"):
            w = find_words(block.buf, block.off, NON_ALNUM, lower=True)
            hashes, places = [], []
            for k in sizes:
                ok = gram_starts(w.first, k)
                h = gram_hashes(w.hash, k)
                if keys is not None and len(keys):
                    ok &= keys[np.minimum(np.searchsorted(keys, h), len(keys) - 1)] == h
                at = np.flatnonzero(ok)
                hashes.append(h[at])
                places.append(at)
            h, at = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (hashes, places))
            order = np.argsort(at, kind="stable")
            h, at = h[order], at[order]
            bounds = np.searchsorted(at, w.first)
            doc = np.searchsorted(w.first, at, side="right") - 1
            rows = pa.StructArray.from_arrays([pa.array(h.view(np.int64) if len(h) else np.zeros(0, np.int64)), pa.array((at - w.first[doc]).astype(np.int64))], names=["h", "at"])
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), rows)
            yield pa.RecordBatch.from_arrays([block.rows.column(0), pa.array(w.count()), lists.cast(kind)], names=["doc_id", "n_words", "grams"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *_DOC])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def places(spark: SparkSession, rows: DataFrame, found: list[Template], p: LicenseScan) -> DataFrame:
    """(row_id, template, first, last, share): spans of templates in documents.

    ``rows``: row_id and grams. ``share`` is the part of the template's
    positions that the span covers.
    """
    at = [(t.number, i, int(h)) for t in found for i, h in enumerate(t.hashes.view(np.int64))]
    grams = spark.createDataFrame(at, "template int, tpl_at bigint, h bigint")
    about = spark.createDataFrame([(t.number, t.exact, len(t.hashes), t.gram) for t in found], "template int, exact boolean, positions int, gram int")
    hits = rows.select("row_id", F.explode("grams").alias("g")).select("row_id", "g.h", "g.at").join(grams, "h")
    votes = hits.groupBy("row_id", "template", (F.col("at") - F.col("tpl_at")).alias("diagonal")).agg(F.min("at").alias("first"), F.max("at").alias("last"), F.collect_set("tpl_at").alias("found"))
    votes = votes.join(about, "template")
    order = Window.partitionBy("row_id", "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(order)
    apart = F.when(F.col("exact"), F.lit(True)).otherwise(F.coalesce(gap > p.drift, F.lit(True)))
    merged = votes.withColumn("span", F.sum(apart.cast("int")).over(order))
    merged = merged.groupBy("row_id", "template", "span", "exact", "positions", "gram").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.array_distinct(F.flatten(F.collect_list("found"))).alias("found"))
    share = F.size("found") / F.col("positions")
    keep = F.when(F.col("exact"), share == 1).otherwise(share >= p.coverage)
    return merged.where(keep).select("row_id", "template", "first", (F.col("last") + F.col("gram") - 1).alias("last"), share.alias("share"))


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES, p: LicenseScan = LicenseScan()) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels and score.

    n_base counts the places of phrases, first_word and last_word are their
    smallest and largest start (null without one); labels are distinct, sorted
    and comma-joined (empty without one); score is the largest covered share.
    A null text is an empty one; repeated rows get a row each.
    """
    spark = docs.sparkSession
    prepare(spark)
    found = templates(phrases, notices, p.gram)
    rows = stored(_grams(docs, found, p).withColumn("row_id", F.monotonically_increasing_id()), "license-grams")
    labels = spark.createDataFrame([(t.number, t.label, t.exact) for t in found], "template int, label string, exact boolean")
    hit = places(spark, rows.where(F.size("grams") > 0), found, p).join(labels, "template")
    base = F.col("exact")

    def joined(column):
        return F.array_join(F.array_sort(F.collect_set(column)), ",")

    told = hit.groupBy("row_id").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"),
        F.max("share").alias("score"),
    )
    out = rows.select("row_id", "doc_id", "n_words").join(told, "row_id", "left")
    blank = [F.coalesce(c, F.lit("")).alias(c) for c in ("base_labels", "labels")]
    return out.select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word", *blank, F.coalesce("score", F.lit(0.0)).alias("score"))
