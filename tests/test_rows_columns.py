import random

import pytest
from pyspark.sql import functions as F

from pressgrain.operators import columns as C, lookups as L, rows as R
from tests.conftest import final_plan, rows


def test_keyword_filter_matches_inside_words_and_keeps_null(spark):
    df = spark.createDataFrame([("SYRIAn news",), ("calm",), (None,), ("a.b",), ("axb",)], "title string")
    kept = R.exclude_by_keywords(df, "title", ["Syria", "a.b"])
    assert rows(kept) == [("calm",), (None,)]
    assert len(rows(R.exclude_by_keywords(df, "title", ["a.b"], escape=True))) == 4
    assert len(rows(R.exclude_by_keywords(df, "title", []))) == 5


def test_blank_rows_are_dropped(spark):
    df = spark.createDataFrame([("x",), (" ",), ("",), (None,), (" \t",)], "content string")
    assert rows(R.drop_blank(df)) == [("x",)]


def test_agreement_and_report(spark):
    df = spark.createDataFrame([("p", "p"), ("p", "n"), (None, None), ("n", "n")], "a string, b string")
    assert len(rows(R.keep_agreeing(df, "a", "b"))) == 2
    report = R.filter_report(df, F.col("a") == F.col("b")).first()
    assert tuple(report) == (4, 2, 2, 50.0)
    assert R.filter_report(df.where("false"), F.col("a") == F.col("b")).first()["percent_dropped"] is None


def test_repeated_rows_with_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "b")], "x string, y string")
    assert len(rows(R.drop_repeated_rows(df))) == 2
    assert tuple(R.repeated_rows_report(df).first()) == (3, 2, 1)
    assert tuple(R.repeated_rows_report(df.where("false")).first()) == (0, 0, 0)


def test_rarely_repeated_rows_give_the_same(spark, monkeypatch):
    rng = random.Random(1)
    value = lambda: rng.choice([None, 0.0, -0.0, 1.5, float("nan")])
    data = [(rng.choice("abc"), rng.choice([None, "a", "b"]), value(), [rng.randrange(3)], i if i % 4 else 0) for i in range(300)]
    df = spark.createDataFrame(data, "x string, `odd.name` string, d double, l array<int>, i int").repartition(5)
    for bits in (26, 7):  # a filter that is nearly exact, and one that is nearly full
        monkeypatch.setattr(R, "FILTER_LOG2", bits)
        assert str(rows(R.drop_repeated_rows(df, rare=True))) == str(rows(R.drop_repeated_rows(df)))
    assert rows(R.drop_repeated_rows(df.where("false"), rare=True)) == []


def test_only_repeated_rows_are_shuffled_whole(spark, tmp_path):
    wide = spark.range(4000).select(F.when(F.col("id") < 40, F.col("id") % 4).otherwise(F.col("id")).alias("id")).select(
        "id", F.repeat(F.sha2(F.col("id").cast("string"), 256), 20).alias("text")
    )
    wide.write.parquet(str(tmp_path / "wide"))
    got = R.drop_repeated_rows(spark.read.parquet(str(tmp_path / "wide")), rare=True)
    assert got.count() == 3964
    got.collect()
    plan = got._jdf.queryExecution().executedPlan()
    moved, todo = [], [plan.executedPlan()]
    while todo:  # the rows that each exchange writes
        node = todo.pop()
        if "ShuffleQueryStage" in node.nodeName():
            node = node.plan()
        if "QueryStage" in node.nodeName():
            node = node.plan()
        if node.nodeName() == "Exchange":
            columns = node.output().size()
            wide_row = "text" in node.output().toString()
            moved.append((wide_row, columns, node.metrics().apply("shuffleRecordsWritten").value()))
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    assert moved and all(n <= 60 for wide_row, _, n in moved if wide_row)


def test_union_order_fill(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([("y", 2.0)], "s string, d double")
    both = R.union_by_name(a, b)
    assert both.columns == ["i", "s", "d"] and both.count() == 2
    ordered = R.in_column_order(both, ["s", "missing", "i"])
    assert ordered.columns == ["s", "missing", "i"] and ordered.first()["missing"] is None
    assert R.fill_text(ordered).first()["missing"] == ""
    with pytest.raises(ValueError):
        R.union_by_name()


def test_empty_columns(spark):
    df = spark.createDataFrame(
        [(1, None, 0, 0, "0", False, None), (2, None, 0, None, "0", False, 5)],
        "a int, nothing string, zero int, zero_null int, text string, no boolean, some int",
    )
    assert C.drop_empty_columns(df).columns == ["a", "zero_null", "text", "some"]
    assert C.drop_empty_columns(df.where("false")).columns == []


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "`Unnamed: x` int, col1 int, keep int, `a.b` int")
    assert C.drop_unwanted_names(df).columns == ["keep", "a.b"]
    assert C.name_similarity("title_x", "title_y") == 86
    long = "abcdefghijklmnopqrst"
    assert C.near_duplicate_names([long, long[:-1] + "z", "other"]) == {long[:-1] + "z"}
    # compared with every earlier column, also one that goes itself
    names = ["a" * 20, "a" * 19 + "b", "a" * 18 + "cb"]
    assert C.near_duplicate_names(names) == {names[1], names[2]}


def test_consolidate_keeps_the_last_copy_in_fill_order(spark):
    df = spark.createDataFrame(
        [("a", "u1", None), ("b", "u2", None), ("c", None, "z")], "title_x string, url string, title_y string"
    )
    got = C.consolidate_columns(df)
    assert got.columns == ["url", "title"]
    assert rows(got.select("title")) == [("z",), (None,), (None,)]


def test_order_by_fill_ties_keep_order(spark):
    df = spark.createDataFrame([(1, None, 3, 4), (1, None, None, 4)], "a int, b int, c int, d int")
    assert C.order_by_fill(df).columns == ["a", "d", "c", "b"]
    assert tuple(C.non_null_counts(df).first()) == (2, 0, 1, 2)
    twice = df.toDF("a", "b", "a", "c")
    assert C.keep_last_of_repeated_names(twice).columns == ["b", "a", "c"]


ARTICLES = [
    (1, "bbc", "2024-03-01", "Immigration and new POLICY now"),
    (2, "cnn", "2024-03-05", "immigration only"),
    (3, "bbc", "2024-03-10", "Policy on refugees, immigration"),
    (4, "xyz", "2024-03-05", "nothing"),
]


def test_topic_articles(spark):
    df = spark.createDataFrame(ARTICLES, "id int, source string, day string, text string").withColumn(
        "day", F.to_date("day")
    )
    topics = [["immigration", "policy"], "refugees"]
    got = L.topic_articles(
        df, topics, ["text"], source_column="source", sources=["bbc"],
        date_column="day", start="2024-03-01", end="2024-03-10",
    )
    assert rows(got.select("id", "search_keyword")) == [
        (1, "immigration AND policy"), (3, "immigration AND policy"), (3, "refugees"),
    ]
    late = L.topic_articles(df, topics, ["text"], date_column="day", start="2024-03-02")
    assert rows(late.select("id").distinct()) == [(3,)]
    assert rows(L.tag_topics(df, [], ["text"])) == []
    assert "Join" not in final_plan(got)


def test_many_topics_match_as_few(spark, monkeypatch):
    rng = random.Random(2)
    words = ["visa", "Visas", "İstanbul", "policy", "ai", "a", "of", "border control", "control", "ß", "x.y", "(a)"]
    topics = [rng.choice(words) for _ in range(40)] + [[rng.choice(words), rng.choice(words)] for _ in range(60)] + ["", " AND "]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 8))).swapcase() for _ in range(80)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "id int, t string")
    found = lambda: [(r[0], list(r[1])) for r in rows(df.select("id", L.matching_topics(F.col("t"), topics)))]
    many = found()
    monkeypatch.setattr(L, "MANY_TERMS", 10**6)
    assert many == found()
    assert max(len(t) for _, t in many) > 3


def test_merge_scores(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "unique_id string, n int")
    one = spark.createDataFrame([("a", 0.5)], "unique_id string, score double")
    two = spark.createDataFrame([("a", 0.1), ("b", 0.2)], "unique_id string, score double")
    got = L.merge_scores(base, one, two, suffixes=["", "_bert"])
    assert got.columns == ["unique_id", "n", "score", "score_bert"]
    assert rows(got) == [("a", 1, 0.5, 0.1), ("b", 2, None, 0.2)]


def test_distinct_count(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("",)], "t string")
    assert R.distinct_count(df, "t").first()[0] == 2
