"""Small results written once and read back.

A table derived from a large scan and used several times is written to the
shared folder.  Its readers then scan kilobytes instead of the corpus, its size
is known when joins are planned (so Spark broadcasts it exactly when it is
below ``spark.sql.autoBroadcastJoinThreshold``, without shuffling the large side
first), and lost executors cost no recomputation.

The shuffle files of a write are removed as soon as it is done, so a job of several
writes holds those of one at a time.  Work over many rows with shuffles that would be
held together is done in slices of a key, one written after the other.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressgrain.session import shared_dir

SLICES = 4  # parts that large work is cut into
SLICED_BYTES = 16 << 20  # written tables from this size on are worked on in slices

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, slot: str | None = None) -> DataFrame:
    """Write the table below the shared folder and read it from there.  Runs a job.

    All tables of an application lie in its folder ``stored-<application>``, which can
    be removed once the application has ended.  A table with a ``slot`` replaces the one
    written there before, which must not be read any more: an iteration that alternates
    between two slots keeps two tables however long it runs.
    """
    spark = df.sparkSession
    path = f"{_folder(spark)}/{slot or uuid.uuid4().hex}"
    _write(df, path, "overwrite")
    return spark.read.schema(df.schema).parquet(path)


def stored_slices(make: Callable[[int], DataFrame], slices: int) -> DataFrame:
    """The tables ``make(0)``, ``make(1)``, ... of the same columns, written one after the other as one table.  Runs jobs."""
    path = None
    for i in range(slices):
        part = make(i)
        path = path or f"{_folder(part.sparkSession)}/{uuid.uuid4().hex}"
        _write(part, path, "append")
    return part.sparkSession.read.schema(part.schema).parquet(path)


def stored_by_slice(df: DataFrame, columns: list[str], slices: int) -> Callable[[int], DataFrame]:
    """Write the rows with those of a slice together, and read a slice from there.  Runs a job."""
    spark = df.sparkSession
    path = f"{_folder(spark)}/{uuid.uuid4().hex}"
    of_slice = F.pmod(F.xxhash64(*columns), F.lit(slices)).cast("int").alias("_slice")
    _write(df.select("*", of_slice), path, "overwrite", "_slice")
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = {f.getPath().getName() for f in _file_system(spark, root).listStatus(root)}

    def read(i: int) -> DataFrame:
        if f"_slice={i}" not in found:
            return spark.createDataFrame([], df.schema)
        return spark.read.schema(df.schema).parquet(f"{path}/_slice={i}")

    return read


def in_slice(columns: list[str | Column], i: int, slices: int) -> Column:
    """Whether a row is in slice ``i``: by the columns' hash, so equal values are in the same one."""
    return F.pmod(F.xxhash64(*columns), F.lit(slices)) == i if slices > 1 else F.lit(True)


def slices_of(table: DataFrame) -> int:
    """How many slices a table is worked on in, by the size of its files: one while it is small."""
    size = table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return SLICES if size >= SLICED_BYTES else 1


def discard(table: DataFrame) -> None:
    """Remove a table written here, or a slice of one; it must not be read any more."""
    spark = table.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        if f"/stored-{spark.sparkContext.applicationId}/" not in path:
            raise ValueError(f"not a stored table: {path}")
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        _file_system(spark, folder).delete(folder, True)


def _file_system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stored-{spark.sparkContext.applicationId}"


def _write(df: DataFrame, path: str, mode: str, *by: str) -> None:
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")  # a write has a plan of its own: nothing else reads its shuffles
    try:
        df.write.mode(mode).option("compression", "zstd").partitionBy(*by).parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
