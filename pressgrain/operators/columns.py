"""Column pruning and renaming driven by column names and contents."""

from __future__ import annotations

import re
from collections import Counter
from difflib import SequenceMatcher

from pyspark.sql import DataFrame, functions as F, types as T

_SUFFIX = re.compile(r"_[xy]$")


def _positional(df: DataFrame) -> DataFrame:
    """Rename columns to c0, c1, ...: names may repeat, positions do not."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def non_null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of non-null values of each column."""
    return df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are all null, or numeric/boolean and all zero.

    Runs one aggregate over the table to find them.  An empty table loses
    every column, as all of its columns count as all null.
    """
    flat = _positional(df)
    checks = []
    for field in flat.schema.fields:
        column = F.col(field.name)
        checks.append((F.count(column) == 0).alias(f"null_{field.name}"))
        if isinstance(field.dataType, (T.NumericType, T.BooleanType)):
            nonzero = F.coalesce(column.cast("double") != 0, F.lit(True))
            checks.append((F.count_if(nonzero) == 0).alias(f"zero_{field.name}"))
    if not checks:
        return df
    found = flat.agg(*checks).first().asDict()
    keep = [
        i
        for i, name in enumerate(flat.columns)
        if not found[f"null_{name}"] and not found.get(f"zero_{name}", False)
    ]
    return flat.select(*[F.col(f"c{i}").alias(df.columns[i]) for i in keep])


def drop_unwanted_names(df: DataFrame) -> DataFrame:
    """Drop columns with a digit in the name, or ``unnamed`` in any case."""
    return _select_positions(
        df,
        [i for i, c in enumerate(df.columns) if not re.search(r"\d", c) and "unnamed" not in c.lower()],
    )


def name_similarity(left: str, right: str) -> int:
    """100 for equal names; share of matching characters, rounded."""
    return int(round(100 * SequenceMatcher(None, left, right).ratio()))


def near_duplicate_names(names: list[str], threshold: int = 95) -> set[str]:
    """Names that resemble an earlier name, which itself may be one of them."""
    return {
        later
        for at, later in enumerate(names)
        if any(name_similarity(earlier, later) >= threshold for earlier in names[:at])
    }


def drop_near_duplicate_names(df: DataFrame, threshold: int = 95) -> DataFrame:
    gone = near_duplicate_names(df.columns, threshold)
    return _select_positions(df, [i for i, c in enumerate(df.columns) if c not in gone])


def strip_merge_suffix(df: DataFrame) -> DataFrame:
    """Remove a trailing ``_x`` or ``_y`` from names; names may then repeat."""
    return df.toDF(*[_SUFFIX.sub("", c) for c in df.columns])


def order_by_fill(df: DataFrame) -> DataFrame:
    """Columns with the most non-null values first; ties keep their order.

    Runs one aggregate.
    """
    return _select_positions(df, _fill_order(df))


def keep_last_of_repeated_names(df: DataFrame) -> DataFrame:
    last = {name: i for i, name in enumerate(df.columns)}
    return _select_positions(df, sorted(last.values()))


def _fill_order(df: DataFrame) -> list[int]:
    counts = non_null_counts(_positional(df)).first()
    return sorted(range(len(df.columns)), key=lambda i: -counts[i])


def _select_positions(df: DataFrame, positions: list[int]) -> DataFrame:
    names = df.columns
    return _positional(df).select(*[F.col(f"c{i}").alias(names[i]) for i in positions])


def consolidate_columns(df: DataFrame) -> DataFrame:
    """Tidy a merged table: names, near-duplicate names, merge suffixes, order.

    Of names that collide once their suffix is gone, the copy that stood last
    in the input stays, at the place the name's emptiest copy takes in the
    fill order.  Runs one aggregate.
    """
    tidy = drop_near_duplicate_names(drop_unwanted_names(df))
    renamed = strip_merge_suffix(tidy)
    if not renamed.columns:
        return renamed
    names = renamed.columns
    last = {name: i for i, name in enumerate(names)}
    remaining = Counter(names)
    chosen = []
    for i in _fill_order(renamed):
        remaining[names[i]] -= 1
        if remaining[names[i]] == 0:
            chosen.append(last[names[i]])
    return _select_positions(renamed, chosen)
