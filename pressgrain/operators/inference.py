"""Batched model inference over a text column.

A predictor factory is called once per Python task and returns a function from
a list of texts to a numpy array with one row per text.  Only the text column
travels to Python, in Arrow batches; the other columns stay in the JVM.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from pressgrain.functions.text import first_words, sentiment_category

# executors get this module's functions with the plan, not from an installation
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Predictor = Callable[[list[str]], np.ndarray]


def _in_batches(texts: list[str], predict: Predictor, size: int) -> list[np.ndarray]:
    parts = [np.asarray(predict(texts[at : at + size])) for at in range(0, len(texts), size)]
    return [row for part in parts for row in part]


def predicted(
    text: Column, factory: Callable[[], Predictor], batch_size: int = 64, kind: str = "array<double>"
) -> Column:
    """The predictor's output row for each text; null texts are predicted as empty."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = factory()
        for texts in batches:
            yield pd.Series(_in_batches(texts.fillna("").tolist(), predict, batch_size))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    # marked nondeterministic so that filters on its output do not run it twice
    return F.pandas_udf(run, kind).asNondeterministic()(text)


def score_model(
    df: DataFrame,
    text_column: str,
    factory: Callable[[], Predictor],
    *,
    batch_size: int = 64,
    max_words: int | None = 256,
    suffix: str = "bert",
) -> DataFrame:
    """Adds score = p(positive) - p(negative) and its category.

    The predictor gives (negative, positive) probabilities.  Its input is cut to
    ``max_words`` words before it leaves the JVM: the scorer's input limit.  A
    tokenizer that makes at least one token per word cuts at the same place or
    earlier.
    """
    text = F.col(text_column)
    if max_words is not None:
        text = first_words(text, max_words)
    return (
        df.withColumn("_p", predicted(text, factory, batch_size))
        .withColumn(f"sentiment_score_{suffix}", F.get("_p", F.lit(1)) - F.get("_p", F.lit(0)))
        .withColumn(
            f"sentiment_category_{suffix}", sentiment_category(F.col(f"sentiment_score_{suffix}"))
        )
        .drop("_p")
    )


def embed(
    df: DataFrame,
    text_column: str,
    factory: Callable[[], Predictor],
    *,
    batch_size: int = 64,
    max_words: int | None = 512,
    output: str = "embedding",
) -> DataFrame:
    """Adds one float vector per text; the predictor pools its token vectors."""
    text = F.col(text_column)
    if max_words is not None:
        text = first_words(text, max_words)
    return df.withColumn(output, predicted(text, factory, batch_size, "array<float>"))


def mean_pool(tokens: DataFrame, key: str, vector: str, output: str = "embedding") -> DataFrame:
    """Mean of the token vectors of each text, position by position.

    Partial sums per (text, position) are built in the map tasks.
    """
    positions = tokens.select(key, F.posexplode(vector).alias("i", "x"))
    means = positions.groupBy(key, "i").agg(F.avg("x").alias("m"))
    ordered = F.sort_array(F.collect_list(F.struct("i", "m")))
    return means.groupBy(key).agg(F.transform(ordered, lambda p: p["m"]).alias(output))

