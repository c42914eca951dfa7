"""Session settings the operators rely on for speed, never for results."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even if an aggregate reuses its partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # group prefixes keep up to 1024 rows per group; the default of 1000 would
    # switch the map-side rank limit off for them
    "spark.sql.optimizer.windowGroupLimitThreshold": "4096",
    # what a Python worker holds at a time is bounded in bytes, not only in rows
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


# of local sessions that name no folder, by application; removed when Python ends
_FALLBACK: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in TUNING.items():
        spark.conf.set(key, value)
    return spark


def named_dir(spark: SparkSession) -> str | None:
    """The folder that the session names in ``spark.checkpoint.dir``, if any."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables and checkpoints.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local master may
    fall back to a temporary folder.
    """
    named = named_dir(spark) or _FALLBACK.get(spark.sparkContext.applicationId)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="pressgrain-")
    _FALLBACK[spark.sparkContext.applicationId] = folder
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder

