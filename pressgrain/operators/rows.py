"""Row filters, duplicate removal and the figures reported about them."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pressgrain.functions.text import has_content, row_digest


def keyword_hit(column: str, keywords: Sequence[str], escape: bool = False) -> Column:
    """True where the column matches any keyword, case-insensitively, anywhere.

    Keywords are patterns; ``escape=True`` takes them literally.  Null is no hit.
    """
    if not keywords:
        return F.lit(False)
    parts = [re.escape(k) if escape else k for k in keywords]
    return F.coalesce(F.col(column).rlike("(?i)(?:" + "|".join(parts) + ")"), F.lit(False))


def exclude_by_keywords(
    df: DataFrame, column: str, keywords: Sequence[str], escape: bool = False
) -> DataFrame:
    return df.where(~keyword_hit(column, keywords, escape))


def drop_blank(df: DataFrame, column: str = "content") -> DataFrame:
    return df.where(has_content(F.col(column)))


def keep_agreeing(df: DataFrame, left: str, right: str) -> DataFrame:
    """Rows whose two labels are equal; a null label never agrees."""
    return df.where(F.col(left) == F.col(right))


def where_equals(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def at_least(df: DataFrame, column: str, threshold: float) -> DataFrame:
    return df.where(F.col(column) >= F.lit(threshold))


def filter_report(df: DataFrame, kept: Column) -> DataFrame:
    """One row: rows before and after the filter, dropped, percent dropped.

    An empty input has a null percentage.
    """
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(F.coalesce(kept, F.lit(False))).alias("rows_after"),
    ).select(
        "rows_before",
        "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("rows_dropped"),
        (
            F.try_divide(F.col("rows_before") - F.col("rows_after"), F.col("rows_before")) * 100
        ).alias("percent_dropped"),
    )


def drop_repeated_rows(df: DataFrame, *, rare: bool = False) -> DataFrame:
    """One copy of each row over all columns; nulls equal each other.

    All columns are grouping keys, so copies collapse inside each map task
    before the shuffle and a row copied many times never piles up in one task.

    With ``rare``, for stored tables of wide rows of which few are repeated: only
    digests are shuffled to find the repeated ones, and only rows that may have a
    repeated digest are shuffled whole and compared.  The result is the same; the
    table is read three times instead of once.
    """
    return _drop_rare_repeats(df) if rare else df.dropDuplicates()


FILTER_LOG2 = 26  # bits of the filter of repeated digests: at most 2**20 words of 64


def _drop_rare_repeats(df: DataFrame) -> DataFrame:
    # -0.0 and 0.0 are one value to a comparison, so they must be one to the digest
    zero = {c: F.lit(0.0).cast(kind) for c, kind in df.dtypes if kind in ("double", "float")}
    names = [(F.col(f"`{c}`") + zero[c]).alias(c) if c in zero else F.col(f"`{c}`") for c in df.columns]
    digest = F.xxhash64(*names)
    word = F.shiftrightunsigned(digest, 70 - FILTER_LOG2).alias("_word")
    place = F.shiftrightunsigned(digest, 64 - FILTER_LOG2).bitwiseAND(F.lit(63)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
    repeated = df.select(digest.alias("d")).groupBy("d").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("d")
    d = F.col("d")
    bits = repeated.select(
        F.shiftrightunsigned(d, 70 - FILTER_LOG2).alias("_of"),
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(d, 64 - FILTER_LOG2).bitwiseAND(F.lit(63)).cast("int")).alias("b"),
    ).groupBy("_of").agg(F.bit_or("b").alias("_bits"))
    # at most 2**20 rows of two numbers, whatever the table: 16 MB
    marked = df.select("*", word, bit.alias("_bit")).join(F.broadcast(bits), F.col("_word") == F.col("_of"), "left")
    may_repeat = F.coalesce(F.col("_bits").bitwiseAND(F.col("_bit")) != 0, F.lit(False))
    once = marked.where(~may_repeat).select(*names)
    return once.unionByName(marked.where(may_repeat).select(*names).dropDuplicates())


def repeated_rows_report(df: DataFrame) -> DataFrame:
    """Rows before and after :func:`drop_repeated_rows`.

    Groups on a 256-bit digest instead of the row, so the shuffle carries 32
    bytes per distinct row whatever the text length.
    """
    return (
        df.select(F.unhex(row_digest(df.columns)).alias("d"))
        .groupBy("d")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"), F.count(F.lit(1)).alias("rows_after"))
        .select(
            "rows_before",
            "rows_after",
            (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
        )
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """One row with the number of distinct non-null values, compared by digest."""
    digest = F.unhex(F.sha2(F.col(column).cast("string"), 256))
    return df.where(F.col(column).isNotNull()).select(digest.alias("d")).agg(
        F.count_distinct("d").alias("n_distinct")
    )


def union_by_name(*tables: DataFrame) -> DataFrame:
    """Append tables, matching columns by name; missing ones become null."""
    if not tables:
        raise ValueError("nothing to append")
    combined = tables[0]
    for table in tables[1:]:
        combined = combined.unionByName(table, allowMissingColumns=True)
    return combined


def with_row_id(df: DataFrame, name: str = "unique_id") -> DataFrame:
    """Add a content hash as key; rows must already be distinct."""
    return df.withColumn(name, row_digest(df.columns))


def in_column_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Exactly the named columns; names the table lacks become null strings."""
    have = set(df.columns)
    return df.select(
        *[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in order]
    )


def fill_text(df: DataFrame) -> DataFrame:
    """Nulls in string columns become empty strings."""
    return df.fillna("")
