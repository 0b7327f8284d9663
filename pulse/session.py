"""Session construction and the shared scratch location.

Intermediate tables (landed raw files, table versions written by upserts,
stream checkpoints) go under the folder the cluster names in
``spark.checkpoint.dir``. Only a local session without that setting gets a
private temporary folder -- never a cluster, where executors do not share
the driver's disk.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

BUCKET_JOINS = "spark.sql.requireAllClusterKeysForCoPartition"

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Tables bucketed by movie_id co-partition joins on (movie_id, date) too.
    BUCKET_JOINS: "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app: str = "pulse",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # The published SQL works on UTC instants; keep every session on UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session; only a local-mode session without the setting
    gets a private temporary folder (as in tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster run needs a shared folder for "
            "checkpoints and intermediate tables"
        )
    local = tempfile.mkdtemp(prefix="pulse-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return f"{base}/pulse/{name}-{uuid.uuid4().hex[:12]}"


def checkpointed(df):
    """Materialize ``df`` in the shared checkpoint folder and cut its lineage.

    Used where a plan reads the same intermediate result several times; the
    reliable checkpoint survives executor loss (a local checkpoint would not).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
