"""The row-wise corpus steps on a stream of pages.

Parsing, cleaning, filtering and topic tagging look at one row only, so the
batch functions run on a stream unchanged and keep no state.  Duplicates, column
tidying and everything that compares rows stay with the batch corpus build.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pressgrain.functions.wordlists import EXCLUDED_TITLE_KEYWORDS
from pressgrain.operators.pages import extract_articles
from pressgrain.operators.rows import exclude_by_keywords
from pressgrain.plans.corpus import clean_articles
from pressgrain.session import named_dir, shared_dir


def page_stream(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def article_stream(
    pages: DataFrame, *, theme: str | None = None, excluded: Sequence[str] = EXCLUDED_TITLE_KEYWORDS
) -> DataFrame:
    articles = clean_articles(extract_articles(pages, theme=theme))
    return exclude_by_keywords(articles, "title", excluded)


def append_articles(articles: DataFrame, path: str, name: str) -> StreamingQuery:
    """Append what is available to Parquet, then stop.

    Progress is kept below ``spark.checkpoint.dir`` under ``name``; a restarted query
    goes on where it stopped.  Without that setting there is no folder that lasts, and
    a restart would append everything again, so it is an error.
    """
    if not named_dir(articles.sparkSession):
        raise ValueError("set spark.checkpoint.dir to a lasting folder before starting a stream")
    return (
        articles.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{shared_dir(articles.sparkSession)}/streams/{name}")
        .trigger(availableNow=True)
        .start()
    )
