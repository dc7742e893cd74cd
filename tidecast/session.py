"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "tidecast") -> SparkSession:
    """Local session for tests and the bench.

    On a cluster the platform provides the session; only the settings that
    the library relies on (UTC, AQE) matter there.
    """
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the session names in spark.checkpoint.dir.

    On a cluster it must be set: executors don't share a local folder.  A
    session of one machine (master ``local``) may do without; it gets a scratch folder.
    """
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="tidecast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current
