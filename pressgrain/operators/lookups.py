"""Joins of large tables with lookup tables, and topic tagging.

Equi-joins carry no broadcast hint: Spark broadcasts the lookup side while its
measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
sorts and merges, splitting skewed partitions of the large side.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from pressgrain.functions.columns import bind

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MANY_TERMS = 100  # beyond it, texts are searched for all terms at once


def lookup_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A short list held by the driver as a table whose size the planner knows.

    The list is handed over as an Arrow table, which Spark keeps as a local relation:
    its estimate is the size of the rows, so a join broadcasts it only while that is
    below the threshold.
    """
    layout = spark.createDataFrame([], schema).schema
    if not rows:
        return spark.createDataFrame([], layout)
    columns = [
        pa.array([row[i] for row in rows], type=f.type) for i, f in enumerate(to_arrow_schema(layout))
    ]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=to_arrow_schema(layout)), layout)


def topic_query(topic: str | Sequence[str]) -> str:
    return topic if isinstance(topic, str) else " AND ".join(topic)


def topic_terms(query: str) -> list[str]:
    return [t.strip() for t in query.split(" AND ") if t.strip()]


def topics_table(spark: SparkSession, topics: Sequence[str | Sequence[str]]) -> DataFrame:
    """(query, term) rows of the topics."""
    rows = [(q, t) for q in map(topic_query, topics) for t in topic_terms(q)]
    return lookup_table(spark, rows, "query string, term string")


def matching_topics(text: Column, topics: Sequence[str | Sequence[str]]) -> Column:
    """array<string> of the topics whose terms all occur in the text.

    Terms are phrases, matched anywhere in any case.  A table is scanned once however
    many topics there are: a few are one literal and searched for in turn, more than
    ``MANY_TERMS`` terms are searched for in one pass over each text.
    """
    queries = [topic_query(t) for t in topics]
    if not queries:
        return F.array().cast("array<string>")
    if sum(len(topic_terms(q)) for q in queries) > MANY_TERMS:
        return _matching_many(F.lower(text), queries)
    catalogue = F.array(
        *[
            F.struct(
                F.lit(q).alias("query"),
                F.array(*[F.lit(t.lower()) for t in topic_terms(q)]).alias("terms"),
            )
            for q in queries
        ]
    )
    return bind(
        F.lower(text),
        lambda low: F.transform(
            F.filter(catalogue, lambda t: F.forall(t["terms"], lambda term: F.contains(low, term))),
            lambda t: t["query"],
        ),
    )


def _matching_many(low: Column, queries: Sequence[str]) -> Column:
    """The same, by an automaton of all terms and an inverted list from each term to its topics.

    A text costs its length and its hits, whatever the number of topics.
    """
    needed = [sorted({t.lower() for t in topic_terms(q)}) for q in queries]
    of_term: dict[str, list[int]] = {}
    for topic, terms in enumerate(needed):
        for term in terms:
            of_term.setdefault(term, []).append(topic)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term in of_term:
            automaton.add_word(term, term)
        automaton.make_automaton()

        def topics_of(text: str | None) -> list[str]:
            left = {topic: len(terms) for topic, terms in enumerate(needed) if not terms}
            for term in {term for _, term in automaton.iter(text or "")}:
                for topic in of_term[term]:
                    left[topic] = left.get(topic, len(needed[topic])) - 1
            return [queries[topic] for topic in sorted(t for t, n in left.items() if n == 0)]

        for texts in batches:
            yield pd.Series([topics_of(t) for t in texts])

    return F.pandas_udf(run, "array<string>").asNondeterministic()(low)


def tag_topics(
    df: DataFrame,
    topics: Sequence[str | Sequence[str]],
    text_columns: Sequence[str],
    tag: str = "search_keyword",
) -> DataFrame:
    """One row per (row, matching topic), tagged with the topic."""
    text = F.concat_ws("\n", *[F.col(c) for c in text_columns])
    return df.withColumn(tag, F.explode(matching_topics(text, topics)))


def topic_articles(
    df: DataFrame,
    topics: Sequence[str | Sequence[str]],
    text_columns: Sequence[str],
    *,
    source_column: str | None = None,
    sources: Sequence | None = None,
    date_column: str | None = None,
    start: str | None = None,
    end: str | None = None,
    tag: str = "search_keyword",
) -> DataFrame:
    """Articles on the topics, optionally of some sources and within two dates.

    No sources, or an empty list, is no restriction.  ``start`` and ``end`` are ``yyyy-MM-dd``, both inclusive.  The source and
    date filters stand before the text match, so they reach the scan.
    """
    if sources:
        df = df.where(F.col(source_column).isin(list(sources)))
    if start is not None:
        df = df.where(F.col(date_column) >= F.to_date(F.lit(start), "yyyy-MM-dd"))
    if end is not None:
        df = df.where(F.col(date_column) < F.date_add(F.to_date(F.lit(end), "yyyy-MM-dd"), 1))
    return tag_topics(df, topics, text_columns, tag)


def topic_counts(df: DataFrame, topics: Sequence[str | Sequence[str]], text_columns: Sequence[str]) -> DataFrame:
    """Articles found per topic."""
    return (
        tag_topics(df.select(*text_columns), topics, text_columns)
        .groupBy("search_keyword")
        .agg(F.count(F.lit(1)).alias("n_articles"))
    )


def attach(df: DataFrame, lookup: DataFrame, on: str | list[str]) -> DataFrame:
    """Left equi-join: every row of ``df`` stays, unmatched ones get nulls."""
    return df.join(lookup, on, "left")


def merge_scores(df: DataFrame, *results: DataFrame, key: str = "unique_id", suffixes=None) -> DataFrame:
    """Left-join the outputs of scorers that wrote their scores to tables.

    A column a later result shares with the table gets that result's suffix.
    """
    suffixes = suffixes or [f"_{i + 1}" for i in range(len(results))]
    for result, suffix in zip(results, suffixes, strict=True):
        taken = set(df.columns) - {key}
        renamed = [
            F.col(c).alias(c + suffix) if c in taken else F.col(c) for c in result.columns
        ]
        df = df.join(result.select(*renamed), key, "left")
    return df
