"""A session with the settings that the operators expect."""

from __future__ import annotations

import gc
import tempfile
import time

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset, one of our own, on a local master only.

    It is the session's checkpoint folder too.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="strandloom-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(path)
    return path or sc._jsc.sc().getCheckpointDir().get()


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files that lie behind cuts and that nobody refers to any more.

    Spark does so when the driver's collector finds out, which on a large heap may take longer than the job. What one
    collection finds may be what held the next thing, and it goes in the background: hence three, with a pause.
    """
    for _ in range(3):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.7)


def session(master: str | None = None, partitions: int | None = None, **more: str) -> SparkSession:
    """UTC, adaptive execution with skew joins; partitions sets spark.sql.shuffle.partitions."""
    b = SparkSession.builder.appName("strandloom").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.sql.execution.arrow.pyspark.enabled", "true")
    if master:
        b = b.master(master)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    for k, v in more.items():
        b = b.config(k, v)
    return b.getOrCreate()
