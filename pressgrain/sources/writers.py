"""Writers: one table, one folder per group value, models, texts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pressgrain.functions.text import topic_slug


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


ROWS_PER_FILE = 1_000_000


def _by_value(df: DataFrame, column: str, rows_per_file: int):
    """A writer of one folder per value.

    Rows are rebalanced by value: small values share a task, so that each has one
    file, and a large one is split over tasks of the advisory partition size.  So
    there are about as many files as values and as the size asks for, not one for
    each task and value.  No file has more than ``rows_per_file`` rows.
    """
    return (
        df.hint("rebalance", column).write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file).partitionBy(column)
    )


def write_topics_json(
    df: DataFrame, path: str, tag: str = "search_keyword", rows_per_file: int = ROWS_PER_FILE
) -> None:
    """One JSON folder per topic, ``topic_slug=<slug>``; rows keep their tag."""
    slug = F.concat(F.lit("news_articles_"), topic_slug(F.col(tag)))
    _by_value(df.withColumn("topic_slug", slug), "topic_slug", rows_per_file).json(path)


def write_by_value(
    df: DataFrame, path: str, column: str = "editorial_stance", rows_per_file: int = ROWS_PER_FILE
) -> None:
    """One Parquet folder per value of the column."""
    _by_value(df, column, rows_per_file).parquet(path)


def write_summaries(df: DataFrame, path: str, group: str, text: str = "summary") -> None:
    """One text folder per group.  One row per group, so one file each."""
    df.select(group, text).write.mode("overwrite").partitionBy(group).text(path)


def save_prefixed_tables(spark: SparkSession, prefix: str, folder: str) -> list[str]:
    """Write every table or view of the session whose name has the prefix."""
    saved = []
    for table in spark.catalog.listTables():
        if table.name.startswith(prefix):
            spark.table(table.name).write.mode("overwrite").parquet(f"{folder}/{table.name}")
            saved.append(table.name)
    return sorted(saved)


MOST_VIEWS = 1000


def publish_views(df: DataFrame, column: str, values: Iterable | None = None) -> list[str]:
    """A temporary view ``df_<value>`` for each of the values, or for all that occur.

    Views are names that the session holds.  Without names a job finds the values, and
    more than ``MOST_VIEWS`` are an error: :func:`publish_by_value` serves any number.
    """
    if values is None:
        values = [r[0] for r in df.select(column).distinct().limit(MOST_VIEWS + 1).collect()]
        if len(values) > MOST_VIEWS:
            raise ValueError(f"{column} has more than {MOST_VIEWS} values; use publish_by_value")
    names = []
    for value in values:
        match = F.col(column).isNull() if value is None else F.col(column) == F.lit(value)
        df.where(match).createOrReplaceTempView(f"`df_{value}`")
        names.append(f"df_{value}")
    return sorted(names)


def publish_by_value(df: DataFrame, column: str, name: str = "df_by") -> str:
    """One SQL table function over the value: ``SELECT * FROM df_by('MAGA')``.

    It serves every value, however many there are, and none is looked up to make it:
    the value becomes a filter on the table, which reaches the scan.  Null gives the
    rows without a value.
    """
    spark = df.sparkSession
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    df.createOrReplaceTempView(f"{name}_rows")
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema)
    kind = df.schema[column].dataType.simpleString()
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(wanted {kind}) RETURNS TABLE({columns}) "
        f"RETURN SELECT {', '.join(quoted(c) for c in df.columns)} FROM {name}_rows WHERE {quoted(column)} <=> wanted"
    )
    return name


def route_outputs(files: DataFrame, folders: DataFrame) -> DataFrame:
    """(file_name, folder): the first folder whose name holds all the file's topic words.

    Topic words are the name's parts between the first and the last underscore,
    compared without case.  Names with fewer than four parts are skipped.  Each
    word meets the folders that contain it through the folders' own substrings
    of the few lengths that words have, so files and folders join on equal words.
    Runs a job for those lengths.
    """
    parts = F.split("file_name", "_")
    wanted = (
        files.select("file_name", parts.alias("parts"))
        .where(F.size("parts") >= 4)
        .select(
            "file_name",
            F.array_distinct(
                F.transform(F.slice("parts", 2, F.size("parts") - 2), F.lower)
            ).alias("topic_words"),
        )
    )
    words = wanted.select(
        "file_name", F.size("topic_words").alias("n_words"), F.explode("topic_words").alias("word")
    )
    low = F.lower(F.col("folder"))
    occurring = sorted(r[0] for r in words.select(F.length("word")).distinct().collect())
    lengths = F.filter(F.array(*[F.lit(n) for n in occurring]).cast("array<int>"), lambda n: n <= F.length(low))
    starts = lambda size: F.transform(
        F.sequence(F.lit(1), F.length(low) - size + 1), lambda at: F.substr(low, at, size)
    )
    pieces = folders.select(
        "folder",
        F.explode(
            F.array_distinct(
                F.flatten(
                    F.transform(
                        lengths, lambda size: F.when(size == 0, F.array(F.lit(""))).otherwise(starts(size))
                    )
                )
            )
        ).alias("word"),
    )
    first = Window.partitionBy("file_name").orderBy("folder")
    return (
        words.join(pieces, "word")
        .groupBy("file_name", "n_words", "folder")
        .agg(F.count(F.lit(1)).alias("n_hits"))
        .where(F.col("n_hits") == F.col("n_words"))
        .withColumn("rank", F.row_number().over(first))
        .where("rank = 1")
        .select("file_name", "folder")
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


