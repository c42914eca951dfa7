"""Exact TF-IDF in long form: (id, token, tf) -> (id, token, weight)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pressgrain.functions.columns import counted
from pressgrain.sources.stored import discard, in_slice, slices_of, stored, stored_by_slice, stored_slices

LENGTHS = {False: 1 << 18, True: 1 << 22}  # documents whose lengths are broadcast, at most; with numbers as keys


def term_counts(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(key, token, tf).  Counting happens inside each row, without a shuffle."""
    return df.select(F.col(key), F.inline(counted(tokens)))


def document_frequency(terms: DataFrame, copies: str | None = None) -> DataFrame:
    """(token, df, total): documents holding the token and its occurrences.

    ``copies`` names a column saying how many equal documents a row stands for.
    """
    n = F.col(copies) if copies else F.lit(1).cast("long")
    return terms.groupBy("token").agg(
        F.sum(n).alias("df"), F.sum(F.col("tf") * n).alias("total")
    )


def limit_vocabulary(frequency: DataFrame, max_features: int) -> DataFrame:
    """The tokens with most occurrences; ties in token order."""
    return frequency.orderBy(F.desc("total"), F.asc("token")).limit(max_features)


def limit_document_share(frequency: DataFrame, max_df: float, n_documents: Column) -> DataFrame:
    """Tokens in at most ``max_df`` of the documents; 1.0 keeps all."""
    return frequency if max_df >= 1.0 else frequency.where(F.col("df") <= max_df * n_documents)


def smooth_idf(n_documents: Column) -> Column:
    return F.log((n_documents + 1) / (F.col("df") + 1)) + 1


def weigh(terms: DataFrame, frequency: DataFrame, n_documents: Column, key: str) -> DataFrame:
    """TF times smooth idf, each document scaled to length one."""
    return scaled(terms.join(frequency.select("token", "df"), "token"), n_documents, key)


def scaled(known: DataFrame, n_documents: Column, key: str) -> DataFrame:
    """The weights of (key, token, tf, df) rows.  Rows are shuffled with their counts only."""
    raw = known.select(key, "token", "tf", "df").repartition(key).withColumn("raw", F.col("tf") * smooth_idf(n_documents))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return raw.select(key, "token", "tf", (F.col("raw") / length).alias("weight"))


def tfidf(
    df: DataFrame,
    key: str,
    tokens: Column,
    *,
    max_df: float = 1.0,
    max_features: int | None = None,
) -> DataFrame:
    """(key, token, tf, weight) of a document table.

    The document count includes documents without tokens.  Runs jobs: the documents'
    counted terms are written, so that texts are tokenised once.  All terms of a large
    table are written in slices and meet their frequencies a slice at a time; the lengths
    of up to ``LENGTHS`` documents are then broadcast, so those rows are not shuffled again.
    """
    slices = slices_of(df) if max_features is None else 1
    if slices == 1:
        documents = stored(df.select(F.col(key), counted(tokens).alias("_terms")))
        n_documents = documents.agg(F.count(F.lit(1))).scalar()
        terms = documents.select(key, F.inline("_terms"))
        frequency = limit_document_share(document_frequency(terms), max_df, n_documents)
        if max_features is not None:
            frequency = limit_vocabulary(frequency, max_features)
        return weigh(terms, frequency, n_documents, key)
    slices *= 2  # rows carry their tokens
    terms_of = stored_by_slice(term_counts(df, key, tokens), ["token"], slices)
    n = df.count()
    n_documents = F.lit(n)
    done = []

    def known(i: int) -> DataFrame:
        for table in done:
            discard(table)
        done[:] = [terms_of(i)]
        frequency = limit_document_share(document_frequency(done[0]), max_df, n_documents)
        return done[0].join(frequency.select("token", "df"), "token").select(key, "token", "tf", "df")

    met = stored_slices(known, slices)
    discard(*done)

    def measured(i: int) -> DataFrame:
        """The lengths of a slice of the documents."""
        counts = met.where(in_slice([key], i, slices)).select(F.col(key).alias("_key"), "tf", "df").repartition("_key")
        raw = counts.withColumn("raw", F.col("tf") * smooth_idf(n_documents))
        return raw.groupBy("_key").agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("length"))

    if n > LENGTHS[dict(met.dtypes)[key] in ("int", "bigint")]:
        return scaled(met, n_documents, key)
    lengths = stored_slices(measured, slices)
    without_key = lengths.where(F.col("_key").isNull()).agg(F.max("length")).scalar()
    found = met.join(F.broadcast(lengths.where(F.col("_key").isNotNull())), F.col(key) == F.col("_key"), "left")
    weight = F.col("tf") * smooth_idf(n_documents) / F.coalesce("length", without_key)
    return found.select(key, "token", "tf", weight.alias("weight"))
