"""Landed records as VARIANT: what a JSON record says, declared or not.

A schema-based read cannot tell a field that is ``null`` from one that is not
there, and never sees a field nobody declared. Here a line stays text until
the keep-last dedupe has chosen it; then ``parse_json`` makes it a VARIANT and
typed extraction gives

* the declared columns, each by its own cast;
* the names of the fields that are there and ``null`` (a default is for
  missing fields only), and of those whose value does not fit their type;
* a typed column for every undeclared field. Types of new fields are found by
  one aggregate over the records (``schema_of_variant_agg``); a field that a
  table already has keeps its stored type.

Only ids, arrival numbers and file places are read before the dedupe, so a
record that is replaced by a later one is never taken apart.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse import schemas

#: The text of a record, of a line that is none, and the time and name of their file.
RECORD, MALFORMED, FILE_TIME, FILE_NAME = "_record", "_malformed", "_file_time", "_file_name"
#: Names of a record's fields that are null, and that do not fit their type.
NULL_FIELDS, UNFIT_FIELDS = "_null_fields", "_unfit_fields"

#: Fields of a raw record that have a default where they are missing.
DEFAULTED = ["adult", "video", *schemas.ARRAY_COLUMNS]


def with_keys(lines: DataFrame) -> DataFrame:
    """(id, arrival_seq, record, malformed, file time and name) for text lines (``value`` and the
    file's metadata), one record a line. Works on streams. Blank lines are no records."""
    text = F.col("value")
    record = F.try_parse_json(text)
    good = record.isNotNull() & F.ltrim(text).startswith("{")
    lines = lines.select("value", F.col("_metadata.file_modification_time").alias(FILE_TIME), F.col("_metadata.file_name").alias(FILE_NAME))
    return lines.where(F.trim(text) != "").select(
        F.when(good, F.try_variant_get(record, "$.id", "bigint")).alias("id"),
        F.when(good, F.try_variant_get(record, "$.arrival_seq", "bigint")).alias("arrival_seq"),
        F.when(good, text).alias(RECORD),
        F.when(~good, text).alias(MALFORMED),
        FILE_TIME,
        FILE_NAME,
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The landed lines of a folder with their keys."""
    return with_keys(spark.read.text(path))


def _path(name: str) -> str:
    quote = "'" if '"' in name else '"'
    return f"$[{quote}{name}{quote}]"


def _plain(kind: T.DataType) -> T.DataType | None:
    """A type that stays the same from run to run: decimals become doubles, fields that are
    always null have none, those of several types are JSON text."""
    if isinstance(kind, T.NullType):
        return None
    if isinstance(kind, T.VariantType):
        return T.StringType()
    if isinstance(kind, T.DecimalType):
        return T.DoubleType() if kind.scale else T.LongType()
    if isinstance(kind, T.ArrayType):
        element = _plain(kind.elementType)
        return T.ArrayType(element or T.StringType())
    if isinstance(kind, T.StructType):
        fields = [(f.name, _plain(f.dataType)) for f in kind.fields]
        return T.StructType([T.StructField(n, t) for n, t in fields if t is not None])
    return kind


def _parsed(schema: str) -> T.DataType:
    """The type that a variant schema names (an object is a struct); quoted names stay as they are."""
    parts = re.split(r"(`[^`]*`)", schema)
    return T.DataType.fromDDL("".join(x if i % 2 else x.replace("OBJECT<", "STRUCT<") for i, x in enumerate(parts)))


def added_fields(records: DataFrame, stored: T.StructType) -> dict[str, T.StructField]:
    """Undeclared fields of the records: name in the record -> column.

    One aggregate, one row to the driver. ``stored`` has the columns that the
    tables already have: an added column keeps its type. Characters that are
    no letters, digits or underscores become underscores; a field that then
    differs from another column by letter case alone, or bears the name of a
    table's own column, gets the suffix ``_2`` (``_3``, ...). A name that no
    variant path can spell (with both kinds of quotes) is left in the text.
    """
    found = records.select(F.schema_of_variant_agg(F.try_parse_json(RECORD))).first()[0]
    kind = _parsed(found) if found and found.startswith("OBJECT<") else T.StructType([])
    declared = set(schemas.column_names(schemas.RAW_DETAILS))
    own = {n.lower() for s in (schemas.MOVIES, schemas.SNAPSHOTS, schemas.RAW_DETAILS) for n in schemas.column_names(s)}
    own |= {"month", "bucket"}  # what tables are partitioned by
    known = {f.name: f.dataType for f in stored.fields}
    out: dict[str, T.StructField] = {}
    for f in sorted(kind.fields, key=lambda f: f.name):
        if f.name in declared or ("'" in f.name and '"' in f.name):
            continue
        taken = own | {c.name.lower() for c in out.values()}
        plain_name = re.sub(r"\W", "_", f.name).lstrip("_") or "field"
        name, n = plain_name, 2
        while name.lower() in taken:
            name, n = f"{plain_name}_{n}", n + 1
        plain = known.get(name) or _plain(f.dataType)
        if plain is not None and not (isinstance(plain, T.StructType) and not plain.fields):
            out[f.name] = T.StructField(name, plain)
    return out


def typed(records: DataFrame, added: dict[str, T.StructField]) -> DataFrame:
    """The declared columns of the records, then the added ones, then ``_null_fields``,
    ``_unfit_fields`` and the text."""
    value = F.col("_value")
    kept = records.select(RECORD, F.try_parse_json(RECORD).alias("_value"))

    def get(name: str, kind: T.DataType) -> Column:
        return F.try_variant_get(value, _path(name), kind.simpleString())

    def there(name: str) -> Column:
        return F.variant_get(value, _path(name), "variant")

    columns = {f.name: (f.name, f.dataType) for f in schemas.RAW_DETAILS.fields}
    columns |= {f.name: (source, f.dataType) for source, f in added.items()}
    null = [F.when(F.is_variant_null(there(c)), c) for c in DEFAULTED]
    unfit = [F.when(there(source).isNotNull() & ~F.is_variant_null(there(source)) & get(source, kind).isNull(), name) for name, (source, kind) in columns.items()]
    return kept.select(
        *(get(source, kind).alias(name) for name, (source, kind) in columns.items()),
        F.array_compact(F.array(*null)).alias(NULL_FIELDS),
        F.array_compact(F.array(*unfit)).alias(UNFIT_FIELDS),
        RECORD,
    )


def added_columns(details: DataFrame) -> list[str]:
    """Columns of typed records that were not declared."""
    if NULL_FIELDS not in details.columns:
        return []
    declared = {*schemas.column_names(schemas.RAW_DETAILS), NULL_FIELDS, UNFIT_FIELDS, RECORD}
    return [c for c in details.columns if c not in declared]
