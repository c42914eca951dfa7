"""Registration of queries with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressgrain.session import tune
from pressgrain.sources.readers import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str = "documents", *columns: str) -> DataFrame:
    """A table for work that is heavy per row: its one file is dealt out to all cores."""
    return spread(table(spark, sf_dir, name).select(*(columns or ("*",))))


def r6(column) -> object:
    """Round to six places and turn -0.0 into 0.0, as both engines must agree."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, 6) + F.lit(0.0)


def sql_values(rows, *names: str) -> str:
    def literal(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"{v}::DOUBLE" if isinstance(v, float) else str(v)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({', '.join(names)}))"


def sql_in(items) -> str:
    return "(" + ", ".join("'" + i.replace("'", "''") + "'" for i in items) + ")"


def labelled(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents with labels, as articles with two sentiment labels."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("publisher"), F.col("text").alias("content"),
        F.col("lang").alias("theme"),
    )
    labels = table(spark, sf_dir, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("label_model"),
        F.when(F.col("toxic") == 0, "positive").otherwise("negative").alias("label_lex"),
    )
    if "content" in (columns or docs.columns):
        docs = spread(docs)
    joined = docs.join(labels, "doc_id")
    return joined.select(*columns) if columns else joined


# Same rows in SQL.
LABELLED_SQL = """
    SELECT d.doc_id, d.source AS publisher, d.text AS content, d.lang AS theme,
           CASE WHEN l.quality = 1 THEN 'positive' ELSE 'negative' END AS label_model,
           CASE WHEN l.toxic = 0 THEN 'positive' ELSE 'negative' END AS label_lex
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


def clean_list_sql(column: str) -> str:
    """Cleaned words of a column as a list."""
    return (
        f"list_filter(regexp_split_to_array(regexp_replace({column}, '[^a-zA-Z0-9\\s]', '', 'g'), '\\s+'), "
        "lambda w: length(w) BETWEEN 3 AND 13 AND NOT regexp_matches(w, '[0-9]'))"
    )


def clean_sql(column: str) -> str:
    return f"array_to_string({clean_list_sql(column)}, ' ')"


PUBLISHER_SQL = (
    "array_to_string(list_transform(string_split(split_part(regexp_replace("
    "regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1), '^www\\.', ''), '.', 1), '-'), "
    "lambda w: upper(w[1]) || lower(w[2:])), ' ')"
)


def class_report_sql(pairs: str) -> str:
    """Per-class figures and averages of (l, p) rows, as the tail of a WITH."""
    return f"""
    p AS ({pairs}),
    k AS (SELECT DISTINCT l AS class FROM p UNION SELECT DISTINCT p FROM p),
    c AS (SELECT class,
                 (SELECT count(*) FROM p WHERE l = class AND p.p = class) AS hit,
                 (SELECT count(*) FROM p WHERE p.p = class) AS predicted,
                 (SELECT count(*) FROM p WHERE l = class) AS support FROM k),
    m AS (SELECT class, coalesce(hit / nullif(predicted, 0), 0) AS precision,
                 coalesce(hit / nullif(support, 0), 0) AS recall, hit, support FROM c),
    f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM m)
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM f
    UNION ALL
    SELECT 'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6),
           round(sum(hit) / sum(support), 6), sum(support)::BIGINT FROM f
    UNION ALL
    SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM f
    UNION ALL
    SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
           round(sum(recall * support) / sum(support), 6),
           round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM f
    """
