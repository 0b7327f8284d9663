"""Command-line entry points for the batch jobs and the validation.

    python -m pulse bootstrap <warehouse> <landed-json> <YYYY-MM-DD> [--top-n N]
    python -m pulse daily     <warehouse> <landed-json> <changes-parquet> <YYYY-MM-DD>
    python -m pulse weekly    <warehouse> <landed-json> <YYYY-MM-DD>
    python -m pulse stream    <warehouse> <landing-folder> [--date YYYY-MM-DD]
    python -m pulse validate  <warehouse>
    python -m pulse report    <warehouse> <view or report> [--as-of YYYY-MM-DD] [--limit N]

``validate`` prints the check report and exits 0 when every check passed,
1 otherwise. The session comes from the environment (``spark-submit``
configuration); only the time zone is pinned to UTC.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys

from pulse import schemas
from pulse.operators import ingest, quality
from pulse.plans import jobs, views
from pulse.plans.tables import warehouse_tables
from pulse.plans.warehouse import Warehouse
from pulse.session import build_session
from pulse.streaming.ingest import stream_ingest


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="pulse")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("bootstrap")
    b.add_argument("warehouse")
    b.add_argument("raw")
    b.add_argument("date")
    b.add_argument("--top-n", type=int, default=1000)
    d = sub.add_parser("daily")
    d.add_argument("warehouse")
    d.add_argument("raw")
    d.add_argument("changes")
    d.add_argument("date")
    w = sub.add_parser("weekly")
    w.add_argument("warehouse")
    w.add_argument("raw")
    w.add_argument("date")
    s = sub.add_parser("stream")
    s.add_argument("warehouse")
    s.add_argument("landing")
    s.add_argument("--date")
    v = sub.add_parser("validate")
    v.add_argument("warehouse")
    r = sub.add_parser("report")
    r.add_argument("warehouse")
    r.add_argument("name", choices=[*views.VIEWS, *views.REPORTS])
    r.add_argument("--as-of", default=_dt.date.today().isoformat())
    r.add_argument("--limit", type=int, default=100)
    a = ap.parse_args(argv)

    spark = build_session(app=f"pulse-{a.cmd}")
    wh = Warehouse(spark, a.warehouse)
    if a.cmd == "validate":
        report = quality.validate_all(
            wh.read(jobs.MOVIES, schemas.MOVIES), wh.read(jobs.SNAPSHOTS, schemas.SNAPSHOTS)
        )
        for row in report.collect():  # a handful of check rows
            print(json.dumps(row.asDict()))
        return quality.exit_code(report)
    if a.cmd == "report":
        tables = warehouse_tables(wh, _dt.date.fromisoformat(a.as_of))
        for line in views.report(tables, a.name).limit(a.limit).toJSON().collect():
            print(line)
        return 0
    if a.cmd == "stream":
        day = _dt.date.fromisoformat(a.date) if a.date else None
        print(json.dumps({"epochs": stream_ingest(spark, a.landing, wh, snapshot_date=day)}))
        return 0
    raw = ingest.read_landed(spark, a.raw)
    day = _dt.date.fromisoformat(a.date)
    if a.cmd == "bootstrap":
        rep = jobs.run_bootstrap(wh, raw, day, a.top_n)
    elif a.cmd == "daily":
        changes = spark.read.schema(schemas.CHANGES).parquet(a.changes)
        rep = jobs.run_daily(wh, raw, changes, day)
    else:
        rep = jobs.run_weekly(wh, raw, day)
    print(json.dumps(rep.counts))
    return 0


if __name__ == "__main__":
    sys.exit(main())
