"""Small helpers for building column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Inside higher-order functions the optimizer may inline a projected
    expression into the lambda and evaluate it once per element.  A lambda
    variable cannot be inlined.
    """
    return F.transform(F.array(value), body).getItem(0)


def counted(tokens: Column) -> Column:
    """array<string> -> array<struct<token, tf>>, one entry per distinct token.

    Sorts the array and measures the runs: O(n log n) inside the row, so term
    counts need no shuffle.
    """
    def runs(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return bind(
            starts,
            lambda s: F.transform(
                s,
                lambda at, k: F.struct(
                    F.get(ordered, at).alias("token"),
                    (F.coalesce(F.get(s, k + 1), F.size(ordered)) - at).alias("tf"),
                ),
            ),
        )

    empty = F.expr("cast(array() as array<struct<token:string,tf:int>>)")
    return F.when(F.size(tokens) > 0, bind(F.sort_array(tokens), runs)).otherwise(empty)
