"""Session construction and shared-folder settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(cpus: int | str = "*", app: str = "runsight", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the cluster's own session."""
    shuffle = shuffle_partitions or (8 if cpus == "*" else max(2, int(cpus)))
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(shuffle))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("RUNSIGHT_DRIVER_MEM", "16g"))
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="runsight-wh-")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that has none gets a private folder; on a cluster that is an error, as executors do not
    share the driver's disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="runsight-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark)
    import uuid
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
