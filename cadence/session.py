"""Spark session helpers.

Library code never builds its own session; it takes the caller's. ``local_session``
is for tests, the bench and the smoke entry only.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cadence") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SCRATCH: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share
    and which may outlive the session. A session on one machine (master
    ``local``) that names none gets a scratch folder; on a cluster that is an
    error, since executors would write to their own disks."""
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _SCRATCH:
        _SCRATCH.append(tempfile.mkdtemp(prefix="cadence-ckpt-"))
    return _SCRATCH[0]


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, set to :func:`shared_folder` if none is."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = shared_folder(spark)
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def materialize(df):
    """Cut lineage of a frame that several jobs reuse: a reliable checkpoint
    in the session's shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
