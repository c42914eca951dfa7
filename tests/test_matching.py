import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pressgrain.operators import matching as M
from tests.conftest import final_plan, rows

STANCES = {"Mainstream Post": "Mainstream", "Fox News": "MAGA", "The Guardian": "Progressive", "Fox Sports": "Other"}


def tokens(name):
    import re

    return re.findall(r"\b\w\w+\b", name.lower())


def brute_best(names, entries):
    """names: list with repeats; best entry position and score of each distinct name."""
    docs = [Counter(tokens(n)) for n in names] + [Counter(tokens(e)) for e in entries]
    df = Counter(t for d in docs for t in d)

    def unit(c):
        v = {t: n * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t, n in c.items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {t: x / norm for t, x in v.items()}

    right = [unit(Counter(tokens(e))) for e in entries]
    best = {}
    for n in set(names):
        left = unit(Counter(tokens(n)))
        sims = [round(sum(w * r.get(t, 0.0) for t, w in left.items()), 9) for r in right]
        top = max(sims)
        best[n] = (sims.index(top), top)
    return best


def test_stance_map(spark):
    names = ["Fox", "Fox News", "Guardian", "Guardian", "Unknown Paper", "fox sports daily", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, publisher string")
    got = {r["id"]: r["editorial_stance"] for r in M.map_stance(df, M.stance_table(spark, STANCES)).collect()}
    best = brute_best([n for n in names if n], list(STANCES))
    values = list(STANCES.values())
    for i, n in enumerate(names):
        assert got[i] == (values[best[n][0]] if n else None)
    # no shared word: the first entry; a tie: the earlier one
    assert got[4] == "Mainstream" and got[0] == "MAGA"


def test_stance_fallback_null(spark):
    df = spark.createDataFrame([("Fox",), ("Fox News",), ("Nobody",)], "publisher string")
    found = M.stance_by_publisher(df, M.stance_table(spark, STANCES), fallback="null")
    got = {r["publisher"]: r["editorial_stance"] for r in found.collect()}
    assert got["Fox News"] == "MAGA" and got["Nobody"] is None
    with pytest.raises(ValueError):
        M.stance_by_publisher(df, M.stance_table(spark, STANCES), fallback="other")


def test_match_outlets(spark):
    outlets = spark.createDataFrame([("BBC News",), ("The New York Times",), ("BBC",), ("Nothing here",), ("BBC",)], "outlet string")
    catalogue = spark.createDataFrame(
        [(0, "bbc-news", "BBC News"), (1, "nyt", "New York Times"), (2, "bbc-sport", "BBC Sport")],
        "pos int, id string, name string",
    )
    got = [(r["outlet"], r["id"]) for r in M.match_outlets(outlets, catalogue).collect()]
    assert Counter(got) == Counter(
        [("BBC News", "bbc-news"), ("The New York Times", "nyt"), ("BBC", "bbc-news"), ("BBC", "bbc-news")]
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pruned_matching_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    # "news" is in a third of all names on both sides
    words = ["news"] * 12 + [f"w{i:02d}" for i in range(24)]
    make = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
    names = [make() for _ in range(150)]
    entries = list(dict.fromkeys(make() for _ in range(60)))
    left = spark.createDataFrame(list(Counter(names).items()), "name string, copies long")
    right = spark.createDataFrame(list(enumerate(entries)), "pos int, entry string")
    vectors = M.name_vectors(left, right)
    got = {r["name"]: (r["pos"], round(r["similarity"], 6)) for r in M.best_matches(*vectors).collect()}
    want = {n: (p, round(s, 6)) for n, (p, s) in brute_best(names, entries).items() if s > 0}
    assert got == want


def test_small_stance_table_joins_without_shuffling_articles(spark, sf):
    docs = spark.read.parquet(f"{sf}/part.parquet").withColumnRenamed("p_name", "publisher")
    plan = final_plan(M.map_stance(docs, M.stance_table(spark, STANCES)))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert rows(docs.groupBy().agg(F.count("*")))
