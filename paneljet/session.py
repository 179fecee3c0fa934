"""Spark session helpers.

Cluster settings (master, memory, shuffle partitions, checkpoint folder) come from the
environment that launches the job. The helpers here only fill in what is unset, which is
what tests and the local bench need.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "paneljet") -> SparkSession:
    """Return the active session, or build a local one tuned for small test data."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # checkpoints of finished rounds/intermediates are removed once unreferenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.driver.memory": os.environ.get("PANELJET_DRIVER_MEMORY", "16g"),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure RDD checkpoints have a folder and return it.

    On a cluster the folder is the shared one named by ``spark.checkpoint.dir``; it is read
    from the session and never replaced. Only when nothing is configured (local tests) a
    fresh scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        try:
            configured = spark.conf.get(CHECKPOINT_CONF, None)
        except Exception:  # noqa: BLE001 - core confs are not always readable here
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder: iterative jobs cut their lineage "
                "with reliable checkpoints there")
        configured = tempfile.mkdtemp(prefix="paneljet-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
