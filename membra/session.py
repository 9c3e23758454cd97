"""Session and shared-folder helpers.

Everything in the library runs on whatever ``SparkSession`` the caller
passes in; :func:`get_spark` is only a convenience for scripts and tests.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "membra", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    AQE stays on so joins against data-derived dimensions can switch to a
    broadcast at run time from measured sizes, small shuffle partitions are
    coalesced and skewed join partitions are split.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("MEMBRA_DRIVER_MEMORY", "16g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    The location comes from ``spark.checkpoint.dir`` (or the context's
    checkpoint dir).  Where neither is set it is a folder under the session's
    warehouse, registered as checkpoint dir; on a cluster that must not be a
    local file system, which driver and executors don't share.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
            base = jdir.get() if jdir.isDefined() else None
        except Exception:  # noqa: BLE001 - no JVM handle (Spark Connect)
            base = None
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_membra"
        if not spark.sparkContext.master.startswith("local") and base.split(":")[0] in ("file", base):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def checkpoint(df, eager: bool = True):
    """Cut lineage with a reliable checkpoint (never ``localCheckpoint``)."""
    spark = df.sparkSession
    shared_dir(spark, "probe")  # makes sure a checkpoint dir is registered
    return df.checkpoint(eager=eager)


def bound_batches(spark: SparkSession, rows: int, size: int) -> None:
    """Has the session hand Python tasks at most ``rows`` rows and ``size`` bytes
    at once (lower settings stay), so that long texts fit in memory."""
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        name = "spark.sql.execution.arrow." + name
        have = spark.conf.get(name, None)
        if have is None or not have.isdigit() or not 0 < int(have) <= most:
            spark.conf.set(name, str(most))
