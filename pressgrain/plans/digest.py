"""Themes, top words and summaries per editorial stance."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from pressgrain.operators.inference import Predictor, embed
from pressgrain.operators.rows import union_by_name, where_equals
from pressgrain.operators.summaries import extractive_summary, generated_summary, group_beginning
from pressgrain.operators.themes import themes, top_listed_words
from pressgrain.sources.stored import stored


def stance_themes(
    articles: DataFrame,
    encoder: Callable[[], Predictor],
    key: str,
    *,
    group: str = "editorial_stance",
    values: Sequence[str] = ("MAGA", "Mainstream"),
    text_column: str = "content",
    n_topics: int = 30,
    stop_words: Sequence[str] | None = None,
) -> DataFrame:
    """(group, cluster, keywords) of the named groups, each clustered on its own.

    Runs jobs: the vectors are made and stored once, then each named group is
    clustered.
    """
    wanted = articles.where(F.col(group).isin(list(values))).select(key, group, text_column)
    vectors = stored(embed(wanted, text_column, encoder))
    parts = []
    for value in values:
        found = themes(
            where_equals(vectors, group, value), text_column, "embedding", key,
            n_topics=n_topics, stop_words=stop_words,
        )
        parts.append(found.select(F.lit(value).alias(group), "cluster", "keywords"))
    return union_by_name(*parts)


def theme_top_words(found: DataFrame, value: str, *, group: str = "editorial_stance", n: int = 5) -> DataFrame:
    """The words most often listed over one group's clusters."""
    return top_listed_words(where_equals(found, group, value), "keywords", "cluster", n)


def stance_summaries(
    articles: DataFrame,
    key: str,
    *,
    group: str = "editorial_stance",
    text_column: str = "content",
    max_words: int = 1024,
    generator: Callable[[], Callable[[str], str]] | None = None,
) -> DataFrame:
    """(group, summary): by a text generator if given, else the best sentences."""
    beginnings = group_beginning(articles, group, key, text_column, max_words)
    if generator is None:
        return extractive_summary(beginnings, group)
    return generated_summary(beginnings, group, generator)
