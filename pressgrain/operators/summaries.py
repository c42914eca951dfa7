"""Text per group, and summaries of it."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from pressgrain.functions.text import first_words, sentences, word_tokens
from pressgrain.operators.tfidf import tfidf
from pressgrain.sources.stored import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SALTS = 64


def group_text(
    df: DataFrame, group: str, order: str, text_column: str, rows_per_block: int = 1000
) -> DataFrame:
    """All texts of each group, in order, joined by one space, whole.

    A row holds the texts whose integer ``order`` falls in one block of
    ``rows_per_block`` numbers; reading a group's blocks in order gives its full
    text.  Groups numbered below ``rows_per_block`` are a single row.  Blocks
    keep a huge group out of a single task and a single string.
    """
    block = F.floor(F.col(order) / F.lit(rows_per_block)).cast("long")
    ordered = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text_column).alias("t"))))
    return (
        df.where(F.col(text_column).isNotNull())
        .groupBy(group, block.alias("block"))
        .agg(
            F.count(F.lit(1)).alias("n_texts"),
            F.array_join(F.transform(ordered, lambda p: p["t"]), " ").alias("content"),
        )
    )


def group_beginning(
    df: DataFrame, group: str, order: str, text_column: str, max_words: int = 1024, salts: int = SALTS
) -> DataFrame:
    """(group, content): the first ``max_words`` words of each group's joined text.

    Texts of equal ``order`` stand in text order.

    This is all a summary reads.  Every text with words adds at least one, so
    the first ``max_words`` such texts suffice.  They are ranked twice: first in
    ``salts`` slices of each group, where the rank limit already works in the
    map tasks, then over the slices' survivors.  No task sees a whole group.
    """
    cut = first_words(F.col(text_column), max_words)
    rows = (
        df.select(F.col(group), F.col(order).alias("_o"), cut.alias("_t"))
        .where(F.col("_t") != "")
        .withColumn("_slice", F.pmod(F.xxhash64("_o"), F.lit(salts)))
    )
    in_slice = Window.partitionBy(group, "_slice").orderBy("_o", "_t")
    in_group = Window.partitionBy(group).orderBy("_o", "_t")
    so_far = in_group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.withColumn("_r", F.row_number().over(in_slice))
        .where(F.col("_r") <= max_words)
        .withColumn("_r", F.row_number().over(in_group))
        .where(F.col("_r") <= max_words)
        .withColumn("_n", F.size(F.split("_t", " ")))
        .withColumn("_before", F.sum("_n").over(so_far) - F.col("_n"))
        .where(F.col("_before") < max_words)
        .groupBy(group)
        .agg(F.sort_array(F.collect_list(F.struct("_o", "_t"))).alias("_l"))
        .select(
            group,
            first_words(
                F.array_join(F.transform("_l", lambda p: p["_t"]), " "), max_words
            ).alias("content"),
        )
    )


def extractive_summary(
    beginnings: DataFrame, group: str, text_column: str = "content", n_sentences: int = 3
) -> DataFrame:
    """(group, summary): the best sentences of each group's text, in text order.

    A sentence scores the mean TF-IDF weight of its words, with the groups as
    documents.  Ties go to the earlier sentence.  Input is one bounded text per
    group; it is stored first, as it is read four times.  Runs a job.
    """
    beginnings = stored(beginnings)
    weights = tfidf(beginnings, group, word_tokens(F.col(text_column))).select(
        group, "token", "weight"
    )
    parts = beginnings.select(
        group, F.posexplode(sentences(F.col(text_column))).alias("pos", "sentence")
    )
    scored = (
        parts.select(group, "pos", F.explode(word_tokens(F.col("sentence"))).alias("token"))
        .join(weights, [group, "token"])
        .groupBy(group, "pos")
        .agg(F.round(F.avg("weight"), 9).alias("score"))
    )
    best = Window.partitionBy(group).orderBy(F.desc("score"), F.asc("pos"))
    chosen = (
        parts.join(scored, [group, "pos"])
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= n_sentences)
    )
    ordered = F.sort_array(F.collect_list(F.struct("pos", "sentence")))
    return chosen.groupBy(group).agg(
        F.array_join(F.transform(ordered, lambda p: p["sentence"]), " ").alias("summary")
    )


def generated_summary(
    beginnings: DataFrame,
    group: str,
    factory: Callable[[], Callable[[str], str]],
    text_column: str = "content",
    prefix: str = "summarize: ",
) -> DataFrame:
    """(group, summary) from a text generator, made once per Python task.

    The generator gets the prefixed text; it sets its own search parameters.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        generate = factory()
        for texts in batches:
            yield pd.Series([generate(t) for t in texts], dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    written = F.pandas_udf(run, "string").asNondeterministic()
    return beginnings.select(
        group, written(F.concat(F.lit(prefix), F.col(text_column))).alias("summary")
    )


