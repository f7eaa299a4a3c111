"""Session helpers.

Library code never builds its own session; it uses the one it is handed.
`get_session` is for tests, the bench and local runs only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import SparkSession

# Settings every job here relies on: adaptive execution re-plans joins with
# runtime sizes (broadcast only what turned out small), coalesces tiny
# shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # checkpoints of the ranking operators are dropped once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "marketlens") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Make sure reliable checkpoints have a home.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared
    file system the cluster names). Only a local-mode session without that
    setting gets a private temporary folder, as in tests. A Spark Connect
    session has no SparkContext here; the server's setting applies.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except (PySparkAttributeError, PySparkNotImplementedError):  # Spark Connect: the server's folder holds
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; the distributed ranking operators "
            "need a shared folder for reliable checkpoints")
    path = tempfile.mkdtemp(prefix="marketlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path
