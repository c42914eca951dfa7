"""Sentiment share per publisher, plain and weighted by audience."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pressgrain.functions.wordlists import FOLLOWERS_MILLIONS
from pressgrain.operators.lookups import lookup_table

CATEGORIES = ("negative", "positive")


def reach_table(spark: SparkSession, followers: Mapping[str, float] = FOLLOWERS_MILLIONS) -> DataFrame:
    return lookup_table(spark, list(followers.items()), "publisher string, followers double")


def influence_scores(reach: DataFrame, weight: str = "followers") -> DataFrame:
    """Audience as a share of the total audience."""
    total = reach.agg(F.sum(weight)).scalar()
    return reach.select("publisher", (F.col(weight) / total).alias("influence_score"))


def category_counts(df: DataFrame, publisher: str = "publisher", label: str = "label") -> DataFrame:
    """Rows per publisher and category; rows with a null key are left out."""
    return (
        df.where(F.col(publisher).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(publisher).alias("publisher"), F.col(label).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def category_shares(counts: DataFrame) -> DataFrame:
    """Adds the publisher's total and the percentage of each category in it."""
    total = F.sum("n").over(Window.partitionBy("publisher"))
    return counts.withColumn("publisher_total", total).withColumn(
        "traditional_percentage", F.col("n") / F.col("publisher_total") * 100
    )


def weighted_shares(shares: DataFrame, reach: DataFrame) -> DataFrame:
    """Adds influence and the percentage times influence; no audience gives null."""
    return shares.join(influence_scores(reach), "publisher", "left").withColumn(
        "weighted_percentage_with_influence",
        F.col("traditional_percentage") * F.col("influence_score"),
    )


def pivot_shares(weighted: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """One row per publisher, one column per measure and category, gaps as 0."""
    measures = ["traditional_percentage", "weighted_percentage_with_influence"]
    wide = (
        weighted.groupBy("publisher")
        .pivot("label", list(categories))
        .agg(*[F.avg(m).alias(m) for m in measures])
    )
    return wide.select(
        "publisher",
        *[
            F.coalesce(F.col(f"{c}_{m}"), F.lit(0.0)).alias(f"{m}_{c}")
            for m in measures
            for c in categories
        ],
    )


def bias_and_impact(
    df: DataFrame,
    reach: DataFrame,
    publisher: str = "publisher",
    label: str = "label",
    categories: Sequence[str] = CATEGORIES,
) -> DataFrame:
    """The whole report in one grouping.

    Same numbers as counting, sharing, weighting and pivoting one after the
    other, but the rows are grouped once, with partial counts in the map tasks,
    so a publisher with a third of all rows costs one row per task.
    """
    totals = (
        df.where(F.col(publisher).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(publisher).alias("publisher"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(F.col(label) == c).alias(f"n_{c}") for c in categories],
        )
    )
    joined = totals.join(influence_scores(reach), "publisher", "left")
    share = {c: F.col(f"n_{c}") / F.col("n") * 100 for c in categories}
    weight = F.coalesce(F.col("influence_score"), F.lit(0.0))
    return joined.select(
        "publisher",
        *[share[c].alias(f"traditional_percentage_{c}") for c in categories],
        *[
            (share[c] * weight).alias(f"weighted_percentage_with_influence_{c}")
            for c in categories
        ],
    )
