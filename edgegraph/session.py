"""Session construction and cluster-facing settings.

Library code never creates its own session: it takes the caller's. ``get_spark`` is only
for tests, the bench and the examples, where nothing is configured yet.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "edgegraph") -> SparkSession:
    master = master or os.environ.get("EDGEGRAPH_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("EDGEGRAPH_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("EDGEGRAPH_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # delete a round's checkpoint files once the loop no longer references them
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...). Only a session
    whose driver is its only process (``local``, ``local[N]``: tests, bench) falls back to a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for iterative operators")
        configured = tempfile.mkdtemp(prefix="edgegraph-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
