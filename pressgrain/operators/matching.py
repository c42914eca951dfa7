"""Best match of names against a catalogue by TF-IDF cosine similarity.

Names meet only through shared tokens, rarest first.  Each name is scored once
against the entry in which its rarest known token weighs most; that score is a
lower bound for its best match.  An entry is met at the first token it shares, and
only if its weight there and the most that all later tokens could add reach the
bound, so a frequent token (like ``news``) makes pairs with the entries it matters
to, not with all.  The result is exact.

Names and vectors are small next to the articles and used in several steps, so
they are stored once (:func:`pressgrain.sources.stored.stored`).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pressgrain.functions.text import without, word_tokens
from pressgrain.functions.wordlists import OUTLETS, english_stop_words
from pressgrain.operators.lookups import lookup_table
from pressgrain.operators.tfidf import document_frequency, smooth_idf, term_counts
from pressgrain.sources.stored import stored

_EPS = 1e-9


def name_tokens(name: Column, stop_words: Iterable[str] = ()) -> Column:
    return without(word_tokens(name), stop_words)


def name_vectors(names: DataFrame, catalogue: DataFrame, stop_words: Iterable[str] = ()):
    """Unit vectors of both sides, weighed on both sides together.

    ``names`` has (name, copies), ``catalogue`` (pos, entry).  Returns
    (name, token, df, weight) and (pos, token, df, weight).  Runs jobs.
    """
    stop = list(stop_words)
    left = term_counts(names, "name", name_tokens(F.col("name"), stop)).join(names, "name")
    right = term_counts(catalogue, "pos", name_tokens(F.col("entry"), stop))
    frequency = document_frequency(
        left.select("token", "tf", "copies").unionByName(
            right.select("token", "tf", F.lit(1).cast("long").alias("copies"))
        ),
        "copies",
    )
    n = (
        names.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n"))
        .unionAll(catalogue.agg(F.count(F.lit(1)).alias("n")))
        .agg(F.sum("n"))
        .scalar()
    )
    idf = frequency.select("token", "df", smooth_idf(n).alias("idf"))

    def unit(terms: DataFrame, key: str) -> DataFrame:
        raw = terms.join(idf, "token").withColumn("raw", F.col("tf") * F.col("idf"))
        length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
        return raw.select(key, "token", "df", (F.col("raw") / length).alias("weight"))

    return stored(unit(left.select("name", "token", "tf"), "name")), stored(unit(right, "pos"))


def _scores(left: DataFrame, right: DataFrame, pairs: DataFrame) -> DataFrame:
    """Full similarity of candidate (name, pos) pairs."""
    return (
        pairs.join(left.select("name", "token", F.col("weight").alias("w1")), "name")
        .join(right.select("pos", "token", F.col("weight").alias("w2")), ["pos", "token"])
        .groupBy("name", "pos")
        .agg(F.round(F.sum(F.col("w1") * F.col("w2")), 9).alias("similarity"))
    )


def best_matches(left: DataFrame, right: DataFrame) -> DataFrame:
    """(name, pos, similarity): the most similar entry, ties to the lowest pos.

    Names that share no token with the catalogue are left out.
    """
    heaviest = F.max(F.struct("weight", (-F.col("pos")).alias("back")))
    top = right.groupBy("token").agg(heaviest.alias("top")).select(
        "token", F.col("top.weight").alias("top_weight"), (-F.col("top.back")).alias("top_pos")
    )
    by_rarity = Window.partitionBy("name").orderBy("df", "token")
    later = by_rarity.rowsBetween(1, Window.unboundedFollowing)
    # what the more frequent tokens can add: each its heaviest entry, all of them a unit vector
    rest = F.least(
        F.coalesce(F.sum(F.col("weight") * F.col("top_weight")).over(later), F.lit(0.0)),
        F.sqrt(F.coalesce(F.sum(F.col("weight") * F.col("weight")).over(later), F.lit(0.0))),
    )
    ranked = left.join(top, "token").withColumn("rank", F.row_number().over(by_rarity)).withColumn("rest", rest)
    seeds = _scores(left, right, ranked.where("rank = 1").select("name", F.col("top_pos").alias("pos")))
    bound = seeds.select("name", F.col("similarity").alias("bound"))
    # an entry is met at the first token it shares, if that and the rest can reach the bound
    postings = right.select("token", "pos", F.col("weight").alias("entry_weight"))
    reaches = F.col("weight") * F.col("entry_weight") + F.col("rest") >= F.col("bound") - _EPS
    candidates = (
        ranked.join(bound, "name")
        .where(F.col("weight") * F.col("top_weight") + F.col("rest") >= F.col("bound") - _EPS)
        .select(F.col("token").alias("shared"), "name", "weight", "rest", "bound")
        .join(postings, (F.col("shared") == F.col("token")) & reaches)
        .select("name", "pos")
        .distinct()
    )
    best = Window.partitionBy("name").orderBy(F.desc("similarity"), F.asc("pos"))
    return (
        _scores(left, right, candidates)
        .withColumn("rank", F.row_number().over(best))
        .where("rank = 1")
        .drop("rank")
    )


def outlet_table(spark: SparkSession, outlets: Iterable[str] = OUTLETS) -> DataFrame:
    return lookup_table(spark, [(name,) for name in outlets], "outlet string")


def match_outlets(
    outlets: DataFrame, catalogue: DataFrame, threshold: float = 0.50
) -> DataFrame:
    """(outlet, id, similarity) of each outlet's best catalogue entry.

    ``outlets`` has (outlet), ``catalogue`` (pos, id, name), pos being the
    listing order.  Outlets whose best match stays below the threshold give no
    row; several outlets may give the same id.  A repeated outlet counts as
    often as it is listed, in the weights and in the result.  Runs jobs.
    """
    listed = stored(
        outlets.groupBy(F.col("outlet").alias("name")).agg(F.count(F.lit(1)).alias("copies"))
    )
    catalogue = stored(catalogue.select("pos", "id", "name"))
    left, right = name_vectors(listed, catalogue.select("pos", F.col("name").alias("entry")))
    best = best_matches(left, right).where(F.col("similarity") >= threshold)
    ids = best.join(catalogue.select("pos", "id"), "pos").select(
        F.col("name").alias("outlet"), "id", "similarity"
    )
    return outlets.join(ids, "outlet")


def stance_table(spark: SparkSession, stances: Mapping[str, str]) -> DataFrame:
    rows = [(i, k, v) for i, (k, v) in enumerate(stances.items())]
    return lookup_table(spark, rows, "pos int, entry string, stance string")


def stance_by_publisher(
    df: DataFrame,
    stances: DataFrame,
    *,
    publisher: str = "publisher",
    threshold: float = 0.60,
    fallback: str = "argmax",
    stop_words: Iterable[str] | None = None,
) -> DataFrame:
    """(publisher, editorial_stance, similarity), one row per distinct publisher.

    ``stances`` has (pos, entry, stance).  Words without meaning (by default the
    English list) do not count.  Token weights count every row's publisher.  Below the threshold ``fallback='argmax'`` still takes the most
    similar entry, and the first entry where no token is shared;
    ``fallback='null'`` leaves the stance empty.  Runs jobs.
    """
    if fallback not in ("argmax", "null"):
        raise ValueError(f"unknown fallback {fallback!r}")
    names = stored(
        df.where(F.col(publisher).isNotNull())
        .groupBy(F.col(publisher).alias("name"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    stop = english_stop_words() if stop_words is None else stop_words
    left, right = name_vectors(names, stances.select("pos", "entry"), stop)
    matched = names.select("name").join(best_matches(left, right), "name", "left")
    similarity = F.coalesce(F.col("similarity"), F.lit(0.0))
    first = stances.agg(F.min_by("stance", "pos")).scalar()
    stance = F.coalesce(F.col("stance"), first)
    if fallback == "null":
        stance = F.when(similarity >= threshold, stance)
    return matched.join(stances.select("pos", "stance"), "pos", "left").select(
        F.col("name").alias(publisher),
        stance.alias("editorial_stance"),
        similarity.alias("similarity"),
    )


def map_stance(df: DataFrame, stances: DataFrame, *, publisher: str = "publisher", **options) -> DataFrame:
    """Adds ``editorial_stance`` to every row; matching runs once per publisher.

    The stored stances join the articles without a shuffle while they are small
    enough to broadcast.
    """
    found = stored(stance_by_publisher(df, stances, publisher=publisher, **options))
    return df.join(found.drop("similarity"), publisher, "left")
