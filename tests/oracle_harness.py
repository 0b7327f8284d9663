"""Spark-vs-DuckDB comparison used by the tests and by ``python -m tests.oracle_harness``.

Rows are compared as an order-insensitive multiset over columns sorted by
name, with floats rounded to 6 places.
"""

from __future__ import annotations

import datetime as _dt
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, _dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat(sep=" ")
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())


SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def type_mismatches(sdf, con, sql):
    """Columns whose Spark type does not map to the DuckDB type of the oracle."""
    rel = con.sql(sql)
    duck = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    out = []
    for f in sdf.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        if duck.get(f.name) != want:
            out.append((f.name, f.dataType.simpleString(), duck.get(f.name)))
    return out


def compare(spark, name, fn, sql, sf_dir, con=None):
    con = con or duck_connection(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    types = type_mismatches(sdf, con, sql)
    scols, srows = spark_rows(sdf)
    t1 = time.time()
    dcols, drows = duck_rows(con, sql)
    ok_cols = scols == dcols and not types
    n_s, n_d = sum(srows.values()), sum(drows.values())
    ok = ok_cols and srows == drows
    detail = ""
    if types:
        detail = f"types (column, spark, duck): {types}"
    elif not ok_cols:
        detail = f"columns spark={scols} duck={dcols}"
    elif srows != drows:
        only_s = list((srows - drows).elements())[:3]
        only_d = list((drows - srows).elements())[:3]
        detail = f"rows spark={n_s} duck={n_d}\n  spark-only {only_s}\n  duck-only  {only_d}"
    return ok, n_s, t1 - t0, detail


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from pulse.session import build_session

    sf_dir = "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("--")]
    for a in argv:
        if a.startswith("--sf="):
            sf_dir = a.split("=", 1)[1]
    spark = build_session("local[8]", 8)
    qs, oracle = e.queries(), e.oracle_sql()
    con = duck_connection(sf_dir)
    bad = 0
    for name in names or list(qs):
        if name not in oracle:
            df = qs[name](spark, sf_dir)
            print(f"--   {name}: rows={df.count()} (no oracle)")
            continue
        try:
            ok, n, secs, detail = compare(spark, name, qs[name], oracle[name], sf_dir, con)
        except Exception as exc:  # noqa: BLE001
            ok, n, secs, detail = False, -1, 0.0, f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {name}: rows={n} {secs:.1f}s {detail}")
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
