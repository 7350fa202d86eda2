"""Session defaults and the shared scratch location.

Everything in the library runs on the caller's ``SparkSession``; this module only
offers a builder with sane defaults for tests/bench and a helper that finds the
cluster-wide checkpoint folder for lineage cuts and round-trip writes.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults that matter at scale: adaptive execution re-plans joins from runtime
# sizes, coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "hourglass",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Builder with the library defaults; existing sessions are reused."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    merged.update(conf or {})
    for key, value in merged.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local-mode session without one (tests, a laptop) gets a private folder;
    on a cluster a machine-local folder would be lost with its executor, so a
    missing setting is an error there. Sessions without a ``SparkContext`` (Spark
    Connect) read the setting from the session configuration.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a folder shared by the cluster")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a folder shared by the "
                               "cluster (HDFS, object store) before running stages that cut lineage")
        configured = tempfile.mkdtemp(prefix="hourglass-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for written stages."""
    root = checkpoint_root(spark)
    return os.path.join(root, "stages", f"{name}-{uuid.uuid4().hex[:12]}")


# Spark deletes the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df`` by writing it once as parquet under the shared
    checkpoint root and reading it back.

    Unlike an eager ``DataFrame.checkpoint()`` (one job to compute, a second that
    recomputes the plan to write it), the plan runs once. A lost executor then
    re-reads the written files instead of recomputing upstream joins. What the write
    shuffled is not needed once it is written, so its files go at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.parquet(path)
