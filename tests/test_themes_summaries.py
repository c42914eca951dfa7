import random

import pytest
from pyspark.sql import Window, functions as F

from pressgrain.operators import summaries as SU, themes as TH
from tests.conftest import final_plan, rows


def test_top_words_ties_in_first_seen_order(spark):
    df = spark.createDataFrame([(2, "zeta beta"), (1, "gamma alpha gamma"), (3, "alpha beta")], "id int, t string")
    got = [tuple(r) for r in TH.top_words(df, "t", "id", 3, []).collect()]
    assert got == [("gamma", 2), ("alpha", 2), ("beta", 2)]
    text_key = df.withColumn("id", F.col("id").cast("string"))
    assert [tuple(r) for r in TH.top_words(text_key, "t", "id", 3, []).collect()] == got


def test_word_counts_stay_in_the_hash_aggregate(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = final_plan(TH.top_words(docs, "text", "doc_id"))
    assert "SortAggregate" not in plan and "Python" not in plan


def test_listed_words_of_numbered_lists_are_not_sorted(spark):
    lists = [(7, "b, a"), (None, "z, y"), (-9223372036854775808, "x"), (9223372036854775807, "w, b"), (-3, "d, c, a")]
    df = spark.createDataFrame(lists, "k long, keywords string")
    top = TH.top_listed_words(df, "keywords", "k", 8)
    assert "SortAggregate" not in final_plan(top)
    by_name = df.withColumn("k", F.struct(F.col("k")))  # a key that is no number: by its struct
    expected = [("a", 2), ("b", 2), ("z", 1), ("y", 1), ("x", 1), ("d", 1), ("c", 1), ("w", 1)]
    assert [tuple(r) for r in top.collect()] == expected == [tuple(r) for r in TH.top_listed_words(by_name, "keywords", "k", 8).collect()]


def test_top_listed_words(spark):
    df = spark.createDataFrame(
        [("Cluster 1", "tax, vote"), ("Cluster 2", "vote, law, tax"), ("Cluster 3", "court")], "cluster string, keywords string"
    )
    got = [tuple(r) for r in TH.top_listed_words(df, "keywords", "cluster", 5).collect()]
    assert got == [("tax", 2), ("vote", 2), ("law", 1), ("court", 1)]


def test_cluster_keywords_per_group(spark):
    df = spark.createDataFrame(
        [(1, "m", 0, "tax tax vote"), (2, "m", 0, "vote law"), (3, "m", 1, "court"), (4, "p", 0, "the sea")],
        "id int, g string, c int, t string",
    )
    got = TH.cluster_keywords(df, "t", "c", "id", n=2, groups=["g"], stop_words=["the"])
    assert rows(got) == [("m", "Cluster 1", "tax, vote"), ("m", "Cluster 2", "court"), ("p", "Cluster 1", "sea")]


def test_themes_cap_the_clusters(spark):
    df = spark.createDataFrame(
        [(i, f"word{'abc'[i % 3]}", [float(i % 3), 1.0]) for i in range(12)], "id int, t string, v array<double>"
    )
    assert TH.capped_clusters(df, "t", 30) == 3 and TH.capped_clusters(df, "t", 2) == 2
    got = TH.themes(df, "t", "v", "id", n_topics=30, stop_words=[])
    assert sorted(r["keywords"] for r in got.collect()) == ["worda", "wordb", "wordc"]
    clustered, _ = TH.assign_clusters(df, "v", 3)
    assert rows(clustered) == rows(TH.assign_clusters(df, "v", 3)[0])


def beginnings(data, limit):
    texts = {}
    for g, o, t in sorted(data, key=lambda r: (r[0], r[1], " ".join((r[2] or "").split()))):
        texts.setdefault(g, []).extend((t or "").split())
    return {g: " ".join(w[:limit]) for g, w in texts.items() if w}


def test_group_beginning_equals_joining_everything(spark):
    rng = random.Random(3)
    data = []
    for i in range(900):  # one group holds two thirds of the rows
        n = rng.choice([0, 1, 1, 2, 5, 40])
        text = " ".join(f"w{i}x{k}" for k in range(n)) if n else rng.choice(["", None, " \n"])
        data.append(("hot" if i % 3 else f"g{i % 7}", 7 * i % 1000 + i, text))
    df = spark.createDataFrame(data, "g string, o int, t string").repartition(6)
    for limit in (1, 30, 1024):
        got = {r["g"]: r["content"] for r in SU.group_beginning(df, "g", "o", "t", limit).collect()}
        assert got == beginnings(data, limit)


def test_rank_limit_starts_in_the_map_tasks(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = final_plan(SU.group_beginning(docs, "source", "doc_id", "text")).split("== Initial Plan ==")[0]
    assert plan.count("WindowGroupLimit") == 4 and plan.count(", Partial") >= 2


def test_group_text_blocks_are_whole(spark):
    data = [(1, i, f"t{i}") for i in range(25)] + [(2, 0, "x"), (2, 1, None)]
    df = spark.createDataFrame(data, "g int, o int, t string")
    blocks = rows(SU.group_text(df, "g", "o", "t", rows_per_block=10))
    joined = " ".join(b[3] for b in sorted(b for b in blocks if b[0] == 1))
    assert joined == " ".join(f"t{i}" for i in range(25)) and len(blocks) == 4
    assert rows(SU.group_text(df, "g", "o", "t"))[1] == (2, 0, 1, "x")


def test_extractive_summary_keeps_text_order(spark):
    text = "Common words here. Zebra quartz! Plain things. Unique lynx ocelot?"
    other = "Common words here. Plain things."
    df = spark.createDataFrame([("a", text), ("b", other), ("c", other)], "g string, content string")
    got = dict(rows(SU.extractive_summary(df, "g", n_sentences=2)))
    assert got["a"] == "Zebra quartz! Unique lynx ocelot?" and got["b"] == other


def test_generated_summary(spark):
    df = spark.createDataFrame([("a", "long text")], "g string, content string")
    make = lambda: lambda text: text.upper()
    assert rows(SU.generated_summary(df, "g", make)) == [("a", "SUMMARIZE: LONG TEXT")]


@pytest.mark.parametrize("tracked", [8, 64, 1 << 12])
def test_frequent_words_are_exact_whatever_the_sketch_holds(spark, tracked):
    rng = random.Random(tracked)
    common = [f"{a}{b}" for a in ("alpha", "beta", "gamma") for b in "xyz"]
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows_ = []
    for i in range(150):
        rare = ["".join(rng.choice(letters) for _ in range(6)) for _ in range(12)]
        words = [rng.choice(common) for _ in range(rng.randrange(8))] + rare
        rng.shuffle(words)
        rows_.append((i, rng.choice(["a", "b", None]), " ".join(words)))
    rows_ += [(200, "even", " ".join(f"{a}{b}q" for a in "mnop" for b in "uvw")), (201, "none", "")]  # ties only; no words
    df = spark.createDataFrame(rows_, "id int, g string, t string").repartition(4)
    counts = TH.word_counts(df, "t", "id", groups=["g"], stop_words=[])
    rank = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("n"), "first_seen"))
    want = rows(counts.withColumn("r", rank).where("r <= 5").select("g", "token", "n", "first_seen"))
    assert rows(TH.frequent_words(df, "t", "id", 5, groups=["g"], stop_words=[], tracked=tracked)) == want
    one = TH.frequent_words(df, "t", "id", 3, stop_words=[], tracked=tracked).select("token", "n")
    assert rows(one) == rows(TH.top_words(df, "t", "id", 3, stop_words=[]))
