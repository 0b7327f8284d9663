import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

from pulse import schemas  # noqa: E402
from pulse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", 8)
    # Tests set their own checkpoint folder (a cluster names a shared one).
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pulse-test-ckpt-"))
    yield s


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def TS(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def base_snapshots(spark, rows):
    """rows: (movie_id, date str, popularity, vote_count[, vote_average[, ingestion ts str]])."""
    out = []
    for r in rows:
        mid, d, p, v = r[:4]
        va = r[4] if len(r) > 4 else 7.0
        ts = TS(r[5]) if len(r) > 5 else TS(d + " 12:00:00")
        out.append((mid, D(d), p, v, va, ts))
    schema = T.StructType(
        list(schemas.SNAPSHOT_BASE.fields) + [T.StructField("ingestion_timestamp", T.TimestampType())]
    )
    return spark.createDataFrame(out, schema)


def movies(spark, rows):
    """rows: (movie_id, title, release_date str|None[, genres list[(id, name)]])."""
    out = []
    for r in rows:
        mid, title, rd = r[:3]
        genres = [{"id": g[0], "name": g[1]} for g in (r[3] if len(r) > 3 else [])]
        rec = {f.name: None for f in schemas.MOVIES.fields}
        rec.update(
            movie_id=mid,
            title=title,
            release_date=D(rd) if rd else None,
            adult=False,
            video=False,
            genres=genres,
            production_companies=[],
            production_countries=[],
            spoken_languages=[],
            last_updated=TS("2024-01-01 00:00:00"),
        )
        out.append(rec)
    return spark.createDataFrame(out, schemas.MOVIES)


def daily_series(movie_id, start, pops, votes):
    d0 = D(start)
    return [
        (movie_id, (d0 + dt.timedelta(days=i)).isoformat(), float(p), int(v))
        for i, (p, v) in enumerate(zip(pops, votes))
    ]
