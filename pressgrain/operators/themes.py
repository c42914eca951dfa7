"""Word frequencies, clusters of text vectors and their keywords."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window, functions as F, types as T

from pressgrain.functions.text import keyword_tokens
from pressgrain.functions.wordlists import FILLERS, REPORTING_VERBS, english_stop_words
from pressgrain.sources.stored import stored


def _stop_words(stop_words):
    return english_stop_words(REPORTING_VERBS + FILLERS) if stop_words is None else list(stop_words)


def _first_seen(df: DataFrame, key: str, position: str):
    """Smallest (key, position) as one decimal, which a hash aggregate updates in place.

    Texts named by a string (a url, say) stand in no order of their own: a hash of the
    name is used, the same on every run.
    """
    is_integer = isinstance(df.schema[key].dataType, T.IntegralType)
    order = F.col(key) if is_integer else F.xxhash64(F.col(key))
    return F.min(order.cast("decimal(20,0)") * F.lit(10**10).cast("decimal(11,0)") + F.col(position))


def _occurrences(df: DataFrame, text_column: str, key: str, stop_words, *groups: str) -> DataFrame:
    tokens = keyword_tokens(F.col(text_column), _stop_words(stop_words))
    return df.select(*groups, key, F.posexplode(tokens).alias("pos", "token"))


def word_counts(
    df: DataFrame, text_column: str, key: str, *, groups: Sequence[str] = (), stop_words=None
) -> DataFrame:
    """(groups, token, n, first_seen) over the keyword tokens of the texts."""
    return _counted(_occurrences(df, text_column, key, stop_words, *groups), key, groups)


def _counted(tokens: DataFrame, key: str, groups: Sequence[str]) -> DataFrame:
    return tokens.groupBy(*groups, "token").agg(
        F.count(F.lit(1)).alias("n"), _first_seen(tokens, key, "pos").alias("first_seen")
    )


def top_words(df: DataFrame, text_column: str, key: str, n: int = 5, stop_words=None) -> DataFrame:
    """The n most frequent keyword tokens; ties in the order they first occur."""
    counts = word_counts(df, text_column, key, stop_words=stop_words)
    return counts.orderBy(F.desc("n"), F.asc("first_seen")).limit(n).select("token", "n")


# An item that a sketch of so many tracked items leaves out occurs at most this often:
# its lower bound is within the largest error, 3.5 / tracked of all occurrences, and its
# count within another one.
SKETCH_ERROR = 7.0


def frequent_words(
    df: DataFrame, text_column: str, key: str, n: int = 5, *, groups: Sequence[str] = (), stop_words=None,
    tracked: int = 1 << 14,
) -> DataFrame:
    """(groups, token, n, first_seen): each group's ``n`` most frequent words, exactly.

    For vocabularies too large to shuffle.  A sketch of ``tracked`` items per group and
    map task names candidates and bounds the count of every other word; the candidates
    are then counted exactly.  A group whose last place is not above the bound is counted
    in full, as :func:`word_counts` does, so the result never depends on the sketch.
    Ties stand in the order the words first occur.  Runs jobs; texts are read twice.
    """
    groups = list(groups)
    tokens = _occurrences(df, text_column, key, stop_words, *groups)
    sketch = tokens.groupBy(*groups).agg(
        F.call_function("approx_top_k", F.col("token"), F.lit(tracked), F.lit(tracked)).alias("items"),
        F.count(F.lit(1)).alias("total"),
    )
    found = stored(sketch.select(*groups, (F.col("total") * (SKETCH_ERROR / tracked)).alias("bound"), "items"))
    named = [F.col(c).alias(f"_{c}") for c in groups]
    candidates = found.select(*named, F.explode("items").alias("item")).select(
        *[f"_{c}" for c in groups], F.col("item.item").alias("_token")
    )
    match = F.col("token") == F.col("_token")
    for c in groups:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    hits = tokens.join(candidates, match).select(*tokens.columns)
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy(F.desc("n"), F.asc("first_seen")))

    def first(counted: DataFrame) -> DataFrame:
        return counted.withColumn("rank", rank).where(F.col("rank") <= n)

    top = stored(first(_counted(hits, key, groups)))
    last = top.where(F.col("rank") == n).select(*named, F.col("n").alias("least"))
    bounds = found.select(*groups, "bound")
    beside = F.lit(True)
    for c in groups:
        beside = beside & F.col(c).eqNullSafe(F.col(f"_{c}"))
    checked = stored(bounds.join(last, beside, "left").select(
        *groups, F.coalesce(F.col("least") > F.col("bound"), F.lit(False)).alias("sure")
    ))
    names = [*groups, "token", "n", "first_seen"]

    def of(rows: DataFrame, sure: bool) -> DataFrame:
        chosen = checked.where(F.col("sure") == sure).select(*named)
        return rows.join(chosen, beside, "left_semi")

    if checked.where(~F.col("sure")).isEmpty():
        return top.select(*names)
    if not groups:
        return first(_counted(tokens, key, groups)).select(*names)
    rest = first(_counted(of(tokens, False), key, groups))
    return of(top, True).select(*names).unionByName(rest.select(*names))


def split_keywords(df: DataFrame, column: str = "keywords", key: str | None = None) -> DataFrame:
    """One row per keyword of a comma-joined list, with its position."""
    carried = [key] if key else []
    return df.select(*carried, F.posexplode(F.split(column, ", ")).alias("pos", "token"))


def top_listed_words(df: DataFrame, column: str, key: str, n: int = 5) -> DataFrame:
    """The n words listed most often over all keyword lists; ties as first listed.

    Lists stand in the order of their key, whatever its type.  Whole numbers are joined
    with the position into one decimal, which a hash aggregate updates in place; a struct
    makes Spark sort every occurrence.
    """
    listed = split_keywords(df, column, key)
    first = F.min(F.struct(key, "pos"))
    if isinstance(df.schema[key].dataType, T.IntegralType):
        before_all = F.lit("-1e19").cast("decimal(20,0)")  # lists without a key come first
        order = F.coalesce(F.col(key).cast("decimal(20,0)"), before_all)
        first = F.min(order * F.lit(10**10).cast("decimal(11,0)") + F.col("pos"))
    return (
        listed.groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"), first.alias("first_seen"))
        .orderBy(F.desc("n"), F.asc("first_seen"))
        .limit(n)
        .select("token", "n")
    )


def cluster_keywords(
    df: DataFrame,
    text_column: str,
    cluster: str,
    key: str,
    *,
    n: int = 5,
    groups: Sequence[str] = (),
    stop_words=None,
) -> DataFrame:
    """(groups, cluster, keywords): each cluster's most frequent words, joined.

    Words are counted per (cluster, word) with partial counts; the rank limit
    also starts in the map tasks, so no cluster's vocabulary meets in one task.
    """
    keys = [*groups, cluster]
    counts = word_counts(df, text_column, key, groups=keys, stop_words=stop_words)
    rank = F.row_number().over(
        Window.partitionBy(*keys).orderBy(F.desc("n"), F.asc("first_seen"))
    )
    top = counts.withColumn("rank", rank).where(F.col("rank") <= n)
    words = F.sort_array(F.collect_list(F.struct("rank", "token")))
    return top.groupBy(*keys).agg(
        F.array_join(F.transform(words, lambda p: p["token"]), ", ").alias("keywords")
    ).select(
        *groups,
        F.concat(F.lit("Cluster "), (F.col(cluster) + 1).cast("string")).alias("cluster"),
        "keywords",
    )


def capped_clusters(df: DataFrame, text_column: str, n_topics: int) -> int:
    """min(n_topics, distinct texts).  Runs a job.

    The first rows usually hold enough distinct texts already; only if they do
    not is the whole table looked at, by digest.
    """
    texts = df.select(F.sha2(text_column, 256).alias("d"))
    first = texts.limit(20 * n_topics).distinct().count()
    return n_topics if first >= n_topics else texts.distinct().limit(n_topics).count()


def assign_clusters(
    df: DataFrame, vector_column: str, k: int, *, seed: int = 0, output: str = "cluster"
) -> tuple[DataFrame, KMeansModel]:
    """Adds the KMeans cluster of each vector.  Runs jobs."""
    vectors = df.withColumn("_features", array_to_vector(F.col(vector_column)))
    model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol=output).fit(vectors)
    return model.transform(vectors).drop("_features"), model


def themes(
    df: DataFrame,
    text_column: str,
    vector_column: str,
    key: str,
    *,
    n_topics: int = 5,
    n_keywords: int = 5,
    stop_words=None,
) -> DataFrame:
    """Clusters the texts by their vectors and names each cluster's keywords."""
    k = capped_clusters(df, text_column, n_topics)
    clustered, _ = assign_clusters(df, vector_column, k)
    return cluster_keywords(
        clustered, text_column, "cluster", key, n=n_keywords, stop_words=stop_words
    )
