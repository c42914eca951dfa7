import math

from pyspark.sql import functions as F

from pressgrain.functions.wordlists import FOLLOWERS_MILLIONS
from pressgrain.operators import evaluation as E, report as B
from pressgrain.operators.lookups import attach
from tests.conftest import final_plan, rows

LABELS = (
    [("Bbc", "positive")] * 3 + [("Bbc", "negative")] + [("Cnn", "negative")] * 2
    + [("Local", "positive")] + [(None, "positive"), ("Cnn", None), ("Gone", None)]
)
REACH = [("Bbc", 10.0), ("Cnn", 30.0)]


def tables(spark):
    return (
        spark.createDataFrame(LABELS, "publisher string, label string"),
        spark.createDataFrame(REACH, "publisher string, followers double"),
    )


def test_report(spark):
    df, reach = tables(spark)
    report = B.bias_and_impact(df, reach)
    assert report.columns == [
        "publisher", "traditional_percentage_negative", "traditional_percentage_positive",
        "weighted_percentage_with_influence_negative", "weighted_percentage_with_influence_positive",
    ]
    assert rows(report) == [
        ("Bbc", 25.0, 75.0, 6.25, 18.75), ("Cnn", 100.0, 0.0, 75.0, 0.0), ("Local", 0.0, 100.0, 0.0, 0.0),
    ]


def test_steps_give_the_same_report(spark):
    df, reach = tables(spark)
    stepwise = B.pivot_shares(B.weighted_shares(B.category_shares(B.category_counts(df)), reach))
    assert rows(stepwise.select(*B.bias_and_impact(df, reach).columns)) == rows(B.bias_and_impact(df, reach))


def test_no_publisher_with_audience_keeps_the_columns(spark):
    df, reach = tables(spark)
    report = B.bias_and_impact(df, reach.where("publisher = 'x'"))
    assert len(report.columns) == 5
    assert report.agg(F.sum("weighted_percentage_with_influence_positive")).first()[0] == 0.0


def test_influence_sums_to_one(spark):
    reach = spark.createDataFrame(list(FOLLOWERS_MILLIONS.items()), "publisher string, followers double")
    scores = {r["publisher"]: r["influence_score"] for r in B.influence_scores(reach).collect()}
    assert math.isclose(sum(scores.values()), 1.0) and scores["Cnn"] == 62.2 / sum(FOLLOWERS_MILLIONS.values())


def test_rows_are_grouped_once(spark):
    df, _ = tables(spark)
    plan = final_plan(B.bias_and_impact(df, B.reach_table(spark, dict(REACH))))
    assert plan.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1


def test_short_lookup_is_broadcast(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("source", "publisher")
    plan = final_plan(attach(docs, B.reach_table(spark, {"src1": 2.0}), "publisher"))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


PREDICTIONS = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")]


def test_classification_report(spark):
    df = spark.createDataFrame(PREDICTIONS, "label string, prediction string")
    got = {r["class"]: tuple(r)[1:] for r in E.classification_report(df).collect()}
    assert got["a"] == (0.75, 0.75, 0.75, 4)
    assert got["c"] == (0.0, 0.0, 0.0, 1)
    assert math.isclose(got["b"][0], 2 / 3) and got["b"][1] == 1.0
    assert math.isclose(got["accuracy"][0], 5 / 7)
    assert math.isclose(got["macro avg"][1], (0.75 + 1.0 + 0.0) / 3)
    assert math.isclose(got["weighted avg"][2], (0.75 * 4 + 0.8 * 2) / 7)
    assert E.classification_report(df.where("false")).where("class = 'accuracy'").first()["precision"] == 0.0


def test_confusion_matrix(spark):
    df = spark.createDataFrame(PREDICTIONS, "label string, prediction string")
    assert rows(E.confusion_matrix(df, ["c", "a", "b"])) == [("a", 3, 1, 0), ("b", 0, 2, 0), ("c", 1, 0, 0)]
