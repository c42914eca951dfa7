import numpy as np
import pytest

from pressgrain.llm import pivots as V
from tests.conftest import rows


def clouds(seed=0, groups=60, alone=400, dim=24, low=0.9):
    """Vectors of their own, and groups of near copies at cosines from ``low`` to 1."""
    rng = np.random.default_rng(seed)
    out = list(rng.normal(size=(alone, dim)))
    for _ in range(groups):
        u = rng.normal(size=dim)
        u /= np.linalg.norm(u)
        for _ in range(rng.integers(1, 6)):
            w = rng.normal(size=dim)
            w -= (w @ u) * u
            c = rng.uniform(low, 1)
            out.append((c * u + np.sqrt(1 - c * c) * w / np.linalg.norm(w)) * rng.uniform(0.1, 10))
    return np.array(out, dtype=np.float32)


def by_hand(vectors, threshold=0.9):
    """All cosines; rows as the operator returns them."""
    usable = [v is not None and None not in v and np.isfinite(v).all() and np.any(v) for _, v in vectors]
    units = [np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float)) if ok else None for (_, v), ok in zip(vectors, usable)]
    root = list(range(len(vectors)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(vectors)
    for i in range(len(vectors)):
        for j in range(i):
            if usable[i] and usable[j] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold:
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    names = {}
    for i, (name, _) in enumerate(vectors):
        if name is not None:
            names[top(i)] = min(names.get(top(i), name), name)
    return sorted(((n, links[i], names.get(top(i)), n == names.get(top(i))) for i, (n, _) in enumerate(vectors)), key=str)


SCHEMA = "vec_id long, embedding array<float>, label int, node long, digest string"


def frame(spark, vectors):
    return spark.createDataFrame([(n, None if v is None else [None if x is None else float(x) for x in v], 1, 7, "x") for n, v in vectors], SCHEMA)


def test_rows_match_brute_force(spark):
    vectors = [(5 * i, v) for i, v in enumerate(clouds(groups=40, alone=100, dim=8, low=0.97))]
    # few pivots shared by all: nothing can be missed
    got = rows(V.near_vectors(frame(spark, vectors).repartition(5), nearest=64, shared=1))
    assert got == by_hand(vectors)
    assert rows(V.near_vectors(frame(spark, vectors).repartition(3), nearest=64, shared=2, block=16)) == got
    assert any(r[1] > 1 for r in got)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (1, [1, 0, 0]), (2, [1, 0, 0]), (2, [1, 0, 0]), (3, [2, 0.1, 0]), (4, None), (4, None), (5, []), (6, [0, 0, 0]), (7, [nan, 1, 0]),
        (8, [inf, 0, 0]), (9, [None, 1, 0]), (10, [1e-30, 0, 0]), (11, [-1, 0, 0]), (12, [0, 1, -0.0]), (13, [0, 1, 0.0]), (None, [0, 3, 0]),
        (None, [0, 0, 5]), (14, [1e30, 1e30, 1e30]),
    ]
    assert rows(V.near_vectors(frame(spark, vectors))) == by_hand(vectors)
    other = [(1, [1, 0, 0]), (2, [1, 0]), (3, [1, 0]), (4, [1, 0, 0]), (5, [1, 0, 0])]
    assert {r[0]: r[1] for r in rows(V.near_vectors(frame(spark, other)))} == {1: 2, 4: 2, 5: 2, 2: 0, 3: 0}
    assert rows(V.near_vectors(frame(spark, []))) == []
    assert rows(V.near_vectors(frame(spark, [(1, None)]))) == [(1, 0, 1, True)]


def test_recall_against_brute_force(spark):
    vectors = [(i, v) for i, v in enumerate(clouds(1, groups=700, alone=2000, dim=64))]
    df = frame(spark, vectors)
    found = V.near_vectors(df)
    units = V.unit(np.array([v for _, v in vectors], dtype=float))
    close = units @ units.T >= 0.9
    true = close.sum(axis=1) - 1
    got = {r["vec_id"]: r["n_links"] for r in found.collect()}
    assert all(got[i] <= n for i, n in enumerate(true))
    share = sum(got.values()) / true.sum()
    assert share >= 0.95
    assert V.recall(df, found) == pytest.approx(share, abs=0.03)


def test_one_large_group_of_near_copies(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=64)
    hot = base + 0.1 * rng.normal(size=(900, 64))
    vectors = [(i, v) for i, v in enumerate(np.concatenate([hot, rng.normal(size=(1500, 64))]).astype(np.float32))]
    vectors += [(10_000 + i, vectors[0][1]) for i in range(300)]
    got = {r["vec_id"]: r for r in V.near_vectors(frame(spark, vectors), block=256).collect()}
    units = V.unit(np.array([v for _, v in vectors], dtype=float))
    true = dict(zip([n for n, _ in vectors], (units @ units.T >= 0.9).sum(axis=1) - 1))
    assert sum(r["n_links"] for r in got.values()) >= 0.99 * sum(true.values())
    assert all(got[i]["component_id"] == 0 for i in [*range(900), *range(10_000, 10_300)])
    assert all(got[i]["kept"] for i in range(900, 2400))


def test_a_double_column(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0000001])], "vec_id int, embedding array<double>")
    assert [r[1] for r in rows(V.near_vectors(df))] == [1, 1]
