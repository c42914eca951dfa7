"""Sentiment scoring of articles: lexicon rules and batched models."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from pressgrain.functions.lexicon import Rules, literal_valence, polarity, sentiment_words
from pressgrain.functions.text import sentiment_category
from pressgrain.operators.tfidf import term_counts
from pressgrain.sources.stored import stored


def token_valences(df: DataFrame, key: str, text: Column, lexicon: DataFrame) -> DataFrame:
    """(key, token, n, valence) of the listed words of each text.

    Words are counted inside the row first, so a word repeated in a text
    reaches the join once.
    """
    low = F.transform(sentiment_words(text), F.lower)
    return (
        term_counts(df, key, low)
        .join(lexicon.groupBy("token").agg(F.max("valence").alias("valence")), "token")
        .select(key, "token", F.col("tf").alias("n"), "valence")
    )


def _listed_words(df: DataFrame, text: Column, lexicon: DataFrame) -> DataFrame:
    """Adds ``_listed``: the text's words that the lexicon has, with their valence, as a map.

    Only (digest, distinct word) rows meet the lexicon and only the words found are
    shuffled to their digest.  The maps are written first, so their size is known when
    they are joined to the texts: while they can be broadcast no text moves, beyond
    that each moves once.  Runs a job.
    """
    keyed = df.withColumn("_text", F.md5(text))
    low = F.array_distinct(F.transform(sentiment_words(text), F.lower))
    words = keyed.select("_text", F.explode(low).alias("token"))
    found = words.join(lexicon.groupBy("token").agg(F.max("valence").alias("valence")), "token")
    # rows with equal texts name the same words: a set holds each once
    listed = stored(
        found.groupBy(F.col("_text").alias("_of")).agg(
            F.map_from_entries(F.collect_set(F.struct("token", "valence"))).alias("_listed")
        )
    )
    return keyed.join(listed, F.col("_text") == F.col("_of"), "left").drop("_text", "_of")


def score_lexicon(
    df: DataFrame,
    text_column: str,
    lexicon: DataFrame | Mapping[str, float],
    rules: Rules | None = None,
    *,
    suffix: str = "vader",
) -> DataFrame:
    """Adds the four scores, the category and the intensity.

    ``lexicon`` has a valence for each lower-case token.  A mapping is part of the
    plan and the scoring is a projection.  A table is joined with the distinct words
    of each text, whatever its size; rows with equal texts share their words, so no
    key is needed, and a job runs for them.  Of a token listed more than once the
    greatest valence counts.
    """
    text = F.col(text_column)
    if isinstance(lexicon, Mapping):
        scored = df.withColumn("_scores", polarity(text, literal_valence(dict(lexicon)), rules))
    else:
        scored = _listed_words(df, text, lexicon).withColumn(
            "_scores", polarity(text, lambda t: F.try_element_at(F.col("_listed"), t), rules)
        ).drop("_listed")
    return scored.withColumns(
        {
            f"emotion_tone_scores_{suffix}": F.col("_scores"),
            f"overall_emotion_{suffix}": sentiment_category(F.col("_scores.compound")),
            f"emotion_intensity_{suffix}": F.col("_scores.compound"),
        }
    ).drop("_scores")
