"""From found articles and fetched pages to the clean corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from pressgrain.functions.text import clean_words
from pressgrain.functions.wordlists import EXCLUDED_TITLE_KEYWORDS, TOPICS
from pressgrain.operators.columns import consolidate_columns
from pressgrain.operators.lookups import topic_articles
from pressgrain.operators.pages import extract_articles
from pressgrain.operators.rows import drop_blank, drop_repeated_rows, exclude_by_keywords
from pressgrain.sources.stored import stored


def pages_to_read(
    found: DataFrame, pages: DataFrame, topics: Sequence[str | Sequence[str]] = TOPICS, **restrictions
) -> DataFrame:
    """Pages of the articles on the topics, tagged with the topic as ``theme``.

    ``found`` has (url, title, description, content), ``pages`` (url, html) and
    perhaps ``status``.  An article on two topics gives two rows.
    """
    tagged = topic_articles(
        found, topics, ["title", "description", "content"], tag="theme", **restrictions
    ).select("url", "theme")
    return tagged.join(pages, "url")


def clean_articles(articles: DataFrame, *, text_column: str = "content") -> DataFrame:
    """The steps that need no other row: clean the words, drop empty texts."""
    return drop_blank(
        articles.withColumn(text_column, clean_words(F.col(text_column))), text_column
    )


def build_corpus(
    pages: DataFrame,
    *,
    theme: str | None = "theme",
    status: str | None = None,
    nested: str = "once",
    excluded: Sequence[str] = EXCLUDED_TITLE_KEYWORDS,
) -> DataFrame:
    """Pages to deduplicated, cleaned articles without the excluded titles.

    Runs jobs: the distinct articles are stored, so that counting the columns'
    values does not parse the pages again.
    """
    articles = extract_articles(pages, theme=theme, status=status, nested=nested)
    return finish_corpus(stored(drop_repeated_rows(articles)), excluded=excluded)


def finish_corpus(articles: DataFrame, *, excluded: Sequence[str] = EXCLUDED_TITLE_KEYWORDS) -> DataFrame:
    """Clean, tidy and filter distinct articles.  Runs one aggregate."""
    tidy = consolidate_columns(clean_articles(articles))
    return exclude_by_keywords(tidy, "title", excluded)
