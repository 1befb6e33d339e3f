"""Spark session settings shared by the library, tests and the bench.

Everything here is plain Spark configuration: UTC session time (the
timestamps are wall-clock readings, stored as ``timestamp_ntz``), ANSI
mode (strict casts raise, as the reference's strict casts do), adaptive
query execution with skew-join splitting, and a conservative broadcast
threshold so only sides whose runtime size AQE has measured get broadcast.
"""

from __future__ import annotations

import os

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Static planning broadcasts only tiny relations; AQE re-plans with
    # measured shuffle sizes (a proven bound) for anything larger.
    "spark.sql.autoBroadcastJoinThreshold": str(8 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # checkpoints of finished steps go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "devicelife", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    A configured master (spark-submit, ``spark.master`` in the defaults, or a
    running session) is kept; only without one does ``master=None`` mean
    ``local[$BENCH_CPUS or 8]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and not configured_master():
        master = f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configured_master() -> str | None:
    """The master that a running context or spark-submit has set, if any."""
    running = SparkContext._active_spark_context
    if running is not None:
        return running.master
    if os.environ.get("SPARK_MASTER") or os.environ.get("MASTER"):
        return os.environ.get("SPARK_MASTER") or os.environ.get("MASTER")
    # inside spark-submit the gateway's JVM holds the submitted properties
    if os.environ.get("PYSPARK_GATEWAY_PORT"):
        return SparkConf().get("spark.master", None)
    return None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str = "/tmp/devicelife-checkpoints") -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names shared storage and is used as is; without
    it a cluster run fails, as a local folder would lose what executors write.
    Only on a local master (tests) do we set our own folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = fallback
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder.

    Used before a driver loop re-reads the same data many times (grid
    search); survives executor loss, unlike a local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
