"""A table of distinct rows that grows batch by batch."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from pressgrain.functions.text import row_digest

BATCH, DIGEST = "batch", "row_digest"


def append_new(df: DataFrame, path: str, batch: str) -> None:
    """Add the rows that no other batch holds yet, once each, as the batch ``batch``.

    Each batch is a folder.  Only the other batches' digests are read, and only digests
    meet them.  A batch that is appended again replaces its own folder alone, so a run
    that broke off, or ran twice, leaves the table as one whole run does.  Batches must
    not be appended at the same time.  Runs a job.
    """
    spark = df.sparkSession
    rows = df.withColumn(DIGEST, row_digest(df.columns)).dropDuplicates([DIGEST])
    held = _held(spark, path)
    if held is not None:
        others = held.where(F.col(BATCH) != F.lit(batch)).select(DIGEST)
        rows = rows.join(others, DIGEST, "left_anti")
    (
        rows.select(*df.columns, DIGEST, F.lit(batch).alias(BATCH))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)
    )


def _held(spark: SparkSession, path: str) -> DataFrame | None:
    """The digests and batches of the table; None before the first batch."""
    try:
        return spark.read.schema(f"{DIGEST} string, {BATCH} string").parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_grown(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches."""
    return spark.read.parquet(path).drop(DIGEST, BATCH)
