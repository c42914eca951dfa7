"""Near copies among vectors by a pivot-permutation index.

A vector is described by its ``nearest`` closest reference points (pivots) in order.
Every vector is entered into the inverted lists of its pivots; two vectors of a list are
candidates if they share at least ``shared`` pivots, and candidates are verified by
their cosine in double precision.  A candidate pair is counted in one place only: the
list of the smallest pivot that both share, under the second smallest one.

Equal vectors are one entry with a count.  A list longer than ``block`` is cut into
blocks and each pair of blocks is a task of its own, so no task holds a long list and
no pair is skipped.  A task returns each vector's number of links and the smallest
vector that it reaches there, never the pairs.

Links are missed only where two similar vectors share too few pivots; see ``recall``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pressgrain.llm.common import map_batches, stored
from pressgrain.llm.components import connected_components

TILE = 1 << 20  # pairs compared at a time
MOST_PIVOTS = 4096
SAMPLE = 4  # vectors that pivots are chosen from, for each pivot


def _rows(column: pa.Array) -> list[np.ndarray | None]:
    """The vectors of a list column in double precision; None for a null one or one that holds a null."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten()
    gaps = values.is_null().to_numpy(zero_copy_only=False)
    numbers = values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    stop = np.cumsum(lengths)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return [
        numbers[e - n : e] if ok and not gaps[e - n : e].any() else None for ok, e, n in zip(valid, stop, lengths)
    ]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square leaves the range of doubles."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def entries(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (vec_id, digest, size, vector): one for each input row.

    ``digest`` names the vector's value with 128 bits, ``size`` is its length; both
    are null, like the vector, where it is null, empty, zero or holds a null or
    non-finite component.
    """
    element = vectors.schema[vector_col].dataType.elementType.simpleString()
    kept = "float" if element == "float" else "double"
    source = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(f"array<{kept}>").alias("vector"))

    def of(batch: pa.RecordBatch) -> dict:
        found = [
            v + 0.0 if v is not None and len(v) and np.isfinite(v).all() and v.any() else None for v in _rows(batch.column(1))
        ]  # adding zero makes -0.0 and 0.0 one value
        return {
            "vec_id": batch.column(0),
            "digest": [None if v is None else xxhash.xxh3_128_hexdigest(v.tobytes()) for v in found],
            "size": [None if v is None else len(v) for v in found],
            "vector": found,
        }

    return map_batches(source, of, f"vec_id long, digest string, size int, vector array<{kept}>")


def choose_pivots(vectors: np.ndarray, count: int) -> np.ndarray:
    """``count`` of the unit vectors, each the farthest from those already taken, from the first on."""
    taken = [0]
    nearest = vectors @ vectors[0]
    while len(taken) < min(count, len(vectors)):
        at = int(np.argmin(nearest))
        taken.append(at)
        np.maximum(nearest, vectors @ vectors[at], out=nearest)
    return vectors[taken]


def fit_pivots(values: DataFrame, rows: int, per_root: float = 4.0) -> np.ndarray:
    """Pivots for so many vectors: ``per_root`` times the root of their number, from 64 to 4096.

    Chosen from a sample of at most four times as many, those with the smallest
    hash of their value, so the same on every run, and numbered from the rarest on.  At most 16,384 vectors come to the
    driver, whatever the number of rows.  Runs a job.
    """
    count = int(min(MOST_PIVOTS, max(64, per_root * rows**0.5)))
    sample = values.select("vector", F.xxhash64("digest").alias("order")).orderBy("order").limit(SAMPLE * count)
    found = _rows(sample.select("vector").toArrow().column(0))
    if not found:
        return np.zeros((0, 1))
    units = unit(np.array(found))
    pivots = choose_pivots(units, count)
    # numbered from the rarest on: pairs are counted at the rarest pivots that they share
    close = np.argsort(-(units @ pivots.T), axis=1)[:, :8]
    return pivots[np.argsort(np.bincount(close.ravel(), minlength=len(pivots)), kind="stable")]


def described(values: DataFrame, pivots: np.ndarray, nearest: int) -> DataFrame:
    """Adds ``pivots``: the numbers of the closest pivots, the closest first."""
    shared = values.sparkSession.sparkContext.broadcast(pivots)
    names = [f.name for f in values.schema]
    at = names.index("vector")

    def of(batch: pa.RecordBatch) -> dict:
        close = unit(np.array(_rows(batch.column(at)))) @ shared.value.T
        n = min(nearest, close.shape[1])
        first = np.argpartition(-close, n - 1, axis=1)[:, :n]
        order = np.argsort(-np.take_along_axis(close, first, axis=1), axis=1, kind="stable")
        columns = {name: batch.column(i) for i, name in enumerate(names)}
        return columns | {"pivots": list(np.take_along_axis(first, order, axis=1).astype(np.int32))}

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in values.schema) + ", pivots array<int>"
    return map_batches(values, of, schema)


def _sublists(pivots: np.ndarray, pivot: int, shared: int) -> Iterator[tuple[int, np.ndarray]]:
    """(second, members) for each further, larger pivot that members of a list share; all members if one is enough."""
    if shared < 2:
        yield -1, np.arange(len(pivots))
        return
    member, place = np.nonzero(pivots > pivot)
    other = pivots[member, place]
    order = np.argsort(other, kind="stable")
    member, other = member[order], other[order]
    starts = np.flatnonzero(np.r_[True, other[1:] != other[:-1]][: len(other)])
    for s, e in zip(starts, [*starts[1:], len(other)]):
        if e - s > 1:
            yield int(other[s]), member[s:e]


def _elsewhere(pivots: np.ndarray, first: int, second: int, shared: int) -> np.ndarray:
    """A label for each vector: two with the same one, other than -1, belong to another list.

    They share a pivot before this list's, or one between its two.  So the members of a
    large group of near vectors are compared pair by pair in the list of their own two
    smallest pivots only.
    """
    least = np.sort(pivots, axis=1)[:, :2]
    label = least[:, 0].astype(np.int64)
    here = label == first
    if shared < 2:
        return np.where(here, -1, label)
    return np.where(here, np.where(least[:, 1] == second, -1, -2 - least[:, 1]), label)


def _links(units, pivots, side, members, first, second, shared, threshold) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified links among the members, without those that belong to another list.

    ``side`` tells the two blocks of a task apart, of which only mixed pairs count.
    """
    label = _elsewhere(pivots[members], first, second, shared)
    step = max(1, TILE // len(members))
    for at in range(0, len(members), step):
        rows, own = members[at : at + step], label[at : at + step, None]
        x, y = np.nonzero((units[rows] @ units[members].T >= threshold - 1e-9) & ((own != label) | (own == -1)))
        a, b = rows[x], members[y]
        keep = a < b if side is None else (a < b) & (side[a] != side[b])
        a, b = a[keep], b[keep]
        for low in range(0, len(a), TILE // 64):
            p, q = a[low : low + TILE // 64], b[low : low + TILE // 64]
            both = (pivots[p][:, :, None] == pivots[q][:, None, :]).any(axis=2)
            common = np.sort(np.where(both, pivots[p], np.iinfo(np.int32).max), axis=1)
            here = (both.sum(axis=1) >= shared) & (common[:, 0] == first)
            if shared > 1:
                here &= common[:, 1] == second
            p, q = p[here], q[here]
            right = np.einsum("ij,ij->i", units[p], units[q]) >= threshold
            yield p[right], q[right]


def _hang(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the trees of linked places; every place then points to the smallest one of its tree."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root[:] = root[root]


def _list_links(table: pa.Table, shared: int, threshold: float) -> pa.Table:
    """Of one list, or of two blocks of one: each linked vector's number of links and one that it reaches."""
    table = table.sort_by("node")
    first, i, j = (table.column(c)[0].as_py() for c in ("pivot", "i", "j"))
    node, times = table.column("node").to_numpy(), table.column("times").to_numpy()
    units = unit(np.array(_rows(table.column("vector"))))
    pivots = np.array(table.column("pivots").to_pylist(), dtype=np.int32)
    side = table.column("block").to_numpy() == j if i != j else None
    links, root = np.zeros(len(node), dtype=np.int64), np.arange(len(node))
    for second, members in _sublists(pivots, first, shared):
        for a, b in _links(units, pivots, side, members, first, second, shared, threshold):
            np.add.at(links, a, times[b])
            np.add.at(links, b, times[a])
            _hang(root, a, b)
    found = links > 0
    return pa.table({"node": node[found], "links": links[found], "least": node[root[found]]})


def near_vectors(
    vectors: DataFrame, threshold: float = 0.9, nearest: int = 8, shared: int = 2, block: int = 2048,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each input row.

    ``n_links`` counts the other rows found whose cosine with this one is at least
    ``threshold``; ``component_id`` is the smallest vec_id that links reach, itself
    included; ``kept`` says whether it is the row's own.

    Vectors that are null, empty, zero, hold a null or non-finite component, or are
    not as long as most vectors, link with nothing.  Repeated rows and equal vectors
    link with each other.  Rows without vec_id count in others' links and name no
    component; where a component has no vec_id at all, it is null and kept.  An empty
    table gives no rows; other columns are not read.  Runs jobs.
    """
    found = stored(entries(vectors, id_col, vector_col))
    usual = found.where("size IS NOT NULL").groupBy("size").count().orderBy(F.desc("count"), "size").first()
    valid = found.where(F.col("size") == (usual["size"] if usual else 0))
    values = stored(
        valid.groupBy("digest")
        .agg(F.first("vector").alias("vector"), F.count("*").alias("times"), F.min("vec_id").alias("first_id"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    pivots = fit_pivots(values, values.count())
    shared = min(shared, nearest, max(1, len(pivots)))
    known = stored(described(values.select("node", "times", "vector", "digest"), pivots, nearest).drop("digest"))
    # two vectors that share `shared` pivots meet at the smallest of them
    meet = F.slice(F.array_sort("pivots"), 1, F.greatest(F.lit(1), F.size("pivots") - shared + 1))
    lists = known.withColumn("pivot", F.explode(meet))
    blocks = stored(lists.groupBy("pivot").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")))
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    pairs = F.transform(other, lambda o: F.struct(F.least("block", o).alias("i"), F.greatest("block", o).alias("j")))
    dealt = (
        lists.join(blocks, "pivot")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .select("pivot", "block", "node", "times", "vector", "pivots", F.inline(pairs))
    )
    linked = stored(
        dealt.groupBy("pivot", "i", "j").applyInArrow(
            lambda table: _list_links(table, shared, threshold), "node long, links long, least long"
        )
    )
    roots = connected_components(linked, "node", "least")
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = values.drop("vector").join(roots, "node", "left").join(links, "node", "left").select(
        "digest", "first_id", F.coalesce("root", "node").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
    )
    names = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_value = stored(grouped.join(names, "root").select("digest", "n_links", "component_id"))
    named = valid.select("vec_id", "digest").join(of_value, "digest").select("vec_id", "n_links", "component_id")
    alone = found.where(F.col("size").isNull() | (F.col("size") != (usual["size"] if usual else 0)))
    rest = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return named.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def recall(vectors: DataFrame, result: DataFrame, threshold: float = 0.9, queries: int = 512) -> float:
    """The share of links that ``result`` has, of all that brute force finds for some query vectors.

    Queries are the linked vectors with the smallest hash of their id, compared with
    every row, a batch at a time; ids must be unique.  Runs jobs.
    """
    rows = vectors.sparkSession
    chosen = (
        result.where("n_links > 0 OR pmod(vec_id, 20) = 0").select("vec_id", F.col("n_links").alias("n"))
        .orderBy(F.xxhash64("vec_id")).limit(queries)
    )
    table = entries(vectors).where("size IS NOT NULL").join(chosen, "vec_id").select("vector", "n").toArrow()
    if not table.num_rows:
        return 1.0
    shared = rows.sparkContext.broadcast(unit(np.array(_rows(table.column("vector")))))

    def count(batch: pa.RecordBatch) -> dict:
        own = [v for v in _rows(batch.column(0)) if len(v) == shared.value.shape[1]]
        return {"n": [int((unit(np.array(own)) @ shared.value.T >= threshold).sum()) if own else 0]}

    true = map_batches(entries(vectors).where("size IS NOT NULL").select("vector"), count, "n long").agg(F.sum("n")).first()[0]
    others = true - table.num_rows
    return 1.0 if others == 0 else sum(table.column("n").to_pylist()) / others
