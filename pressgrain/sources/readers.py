"""Readers: explicit schemas, recursive folders, keyed folders."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pressgrain.operators.rows import drop_repeated_rows
from pressgrain.schemas import API_ARTICLE


WILDCARD = re.compile(r"[\\{}\[\]*?]")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """One Parquet table; a missing path raises."""
    return spark.read.parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small table's scan out to all cores.

    A file with one row group is read by one task, however many cores there are.
    Files are counted in the plan, so no job runs; a table of as many files as
    cores is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def load_report(df: DataFrame, name: str) -> DataFrame:
    """(table_name, n_rows) of a loaded table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows"
    )


def read_articles_json(spark: SparkSession, path: str, schema: T.StructType = API_ARTICLE) -> DataFrame:
    """Article records, one JSON object per line, at any depth below the path."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(path)


def records_to_table(spark: SparkSession, records, schema: T.StructType = API_ARTICLE) -> DataFrame:
    """A list of dicts held by the driver as a table with an explicit schema."""
    return spark.createDataFrame(records, schema)


def read_recursive(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """All tables called ``name`` at any depth, appended; columns are merged by name.

    A table is a file of that name, or a folder of that name with the files of one
    table.  Without a schema the files' columns are merged, which reads every footer;
    pass one for large folders.  Runs a job that lists the files.  A name with wildcards
    means files only.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)
    roots = [] if WILDCARD.search(name) else _tables_below(spark, root, name)
    if not roots:
        return reader.option("pathGlobFilter", name).parquet(root)
    return reader.parquet(*[WILDCARD.sub(r"\\\g<0>", r) for r in roots])


def _tables_below(spark: SparkSession, root: str, name: str) -> list[str]:
    """Paths of the files and folders of that name; no file's content is read."""
    listed = spark.read.option("recursiveFileLookup", True).format("binaryFile").load(root)
    found = F.regexp_extract("path", f"{_below(root)}(?:[^/]+/)*?{_quoted(name)}(?=/|$)", 0)
    return sorted(r[0] for r in listed.select(found.alias("r")).where("r <> ''").distinct().collect())


def _quoted(text: str) -> str:
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _below(folder: str) -> str:
    """Pattern of a folder's own part of the full paths of its files."""
    scheme = "[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?"
    path = re.sub("/+", "/", re.sub(f"^{scheme}(?=/)", "", folder)).rstrip("/")
    return f"^(?:{scheme})?{_quoted(path)}/+" if path[:1] in ("", "/") else f"^.*?/{_quoted(path)}/+"


def read_combined(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """:func:`read_recursive` with one copy of each repeated row; rows that occur once are not shuffled."""
    return drop_repeated_rows(read_recursive(spark, root, name, schema), rare=True)


def read_keyed_folder(spark: SparkSession, folder: str, pattern: str = "*.parquet", key: str = "table_key") -> DataFrame:
    """All files of a folder as one table, the file stem in the key column.

    A folder that matches the pattern is one table, whatever its files are called, and its
    own name is the key.  Filter on the key to get one file's rows.  Files may have
    different columns: the table has all of them, null where a file lacks one.  That
    reads every footer.
    """
    path = F.col("_metadata.file_path")
    entry = F.regexp_extract(path, f"{_below(folder)}([^/]+)", 1)
    entry = F.when(entry == "", F.col("_metadata.file_name")).otherwise(entry)
    stem = F.regexp_replace(entry, r"\.[^.]*$", "")
    return spark.read.option("mergeSchema", True).parquet(f"{folder.rstrip('/')}/{pattern}").select("*", stem.alias(key))


def read_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    """A table written with one folder per group value; filters prune folders."""
    return spark.read.parquet(folder)
