"""Session helpers.

The library never creates its own session implicitly; ``get_spark`` is for
tests, the bench and the command line. ``checkpoint_dir`` reads the shared
folder the cluster names in ``spark.checkpoint.dir`` and only falls back to
a fresh scratch folder when that setting is unset (local runs, tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "modenorm", checkpoint: str | None = None) -> SparkSession:
    master = master or os.environ.get("MODENORM_MASTER") or "local[*]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("MODENORM_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if checkpoint:
        builder = builder.config("spark.checkpoint.dir", checkpoint)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the cluster's setting, else a local scratch dir.

    On a cluster ``spark.checkpoint.dir`` must point at shared storage; a
    machine-local folder is only used when nothing is configured (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        try:
            path = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - not readable as a SQL conf
            path = None
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="modenorm-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written table."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
