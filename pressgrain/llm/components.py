"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pressgrain.llm.common import stored


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root): the smallest node reachable, for every node that has a link.

    Alternates two steps until nothing changes: every larger neighbour of a node is
    hung on the node's smallest neighbour, then every smaller one.  Both are one
    aggregate with partial sums and one join on the node; a node with very many
    links is split by the skew join, never gathered.  Each round is written to the
    shared folder, so that plans stay short and lost executors cost one round.

    Nulls and links from a node to itself are ignored; repeated links count once;
    no links give no rows.  Runs jobs.
    """
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    edges = stored(
        links.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
        .where(x.isNotNull() & y.isNotNull() & (x != y))
        .distinct()
    )
    state = _state(edges)
    while True:
        edges = stored(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(
        F.col("v").alias("u"), F.col("m").alias("v")
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where(F.col("v") != F.col("m")).select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()
