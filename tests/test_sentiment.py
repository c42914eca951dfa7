import math
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pressgrain.functions import lexicon as X
from pressgrain.operators import inference as I, sentiment as S
from tests.conftest import final_plan, rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEXICON = {"good": 1.9, "great": 3.1, "bad": -2.5, "terrible": -2.1, "kind": 2.4, "happy": 2.7, "least": 0.1}


def compound(total):
    return round(total / math.sqrt(total * total + 15), 4)


def scores(spark, texts, lexicon=None, rules=None):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = S.score_lexicon(df, "t", lexicon or LEXICON, rules).orderBy("i").collect()
    return [r["emotion_intensity_vader"] for r in out]


B, N, C = X.BOOST, X.NEGATED, X.CAPITALS

CASES = [
    ("the food is good", 1.9),
    ("nothing to see", 0.0 ),
    ("the food is not good", 1.9 * N),
    ("not the good", 1.9 * N),
    ("not the food good", 1.9 * N),
    ("not one two three good", 1.9),
    ("isn't good", 1.9 * N),
    ("very good", 1.9 + B),
    ("very much good", 1.9 + B * 0.95),
    ("very much so good", ((1.9 + B) + B * 0.9) * 1.25),
    ("barely good", 1.9 - B),
    ("very bad", -2.5 - B),
    ("good food but bad place", 1.9 * 0.5 - 2.5 * 1.5),
    ("the GOOD food", 1.9 + C),
    ("GOOD FOOD", 1.9),
    ("VERY good food", 1.9 + (B + C)),
    ("good!!", 1.9 + 2 * X.EXCLAMATION),
    ("good !!!!!!", 1.9 + 4 * X.EXCLAMATION),
    ("good??", 1.9 + 2 * X.QUESTION),
    ("good ????", 1.9 + X.QUESTIONS_MANY),
    ("good?", 1.9),
    ("a kind of good", 1.9),  # "kind" before "of" is neutral
    ("food sort of so good", ((1.9 + B) * 1.25) - B),  # weakened by "sort of"
    ("food kind of so good", 1.9 + B),  # a listed word three before ends the search
    ("never so good", (1.9 + B) * 1.5),
    ("bad good", -2.5 + 1.9),
    ("it least good", 0.1 + 1.9),  # "least" is listed here, so it does not negate
    ("good!!!!!!", 0.0),  # only runs of up to three marks are split off
    ("", 0.0),
    # a repeated word takes the context of its first occurrence
    ("not good and good", 2 * 1.9 * N),
    ("good and not good", 2 * 1.9),
]


def test_rules_on_hand_made_texts(spark):
    got = scores(spark, [t for t, _ in CASES])
    want = [compound(total) for _, total in CASES]
    assert dict(zip([t for t, _ in CASES], got)) == dict(zip([t for t, _ in CASES], want))


def test_least_negates_when_unlisted(spark):
    lexicon = {k: v for k, v in LEXICON.items() if k != "least"}
    texts = ["it least good", "at least good", "least good", "very least good"]
    assert scores(spark, texts, lexicon) == [
        compound(1.9 * N), compound(1.9), compound(1.9 * N), compound(1.9 + B * 0.95),
    ]


def test_idioms(spark):
    got = scores(spark, ["one two the bomb", "well now it was good the bomb"], LEXICON | {"bomb": -2.9})
    assert got == [compound(3.0), compound(1.9 + 3.0)]


def test_shares_category_and_null(spark):
    df = spark.createDataFrame([(1, "good day bad night"), (2, None), (3, "day")], "i int, t string")
    out = {r["i"]: r for r in S.score_lexicon(df, "t", LEXICON).collect()}
    s = out[1]["emotion_tone_scores_vader"]
    total = (1.9 + 1) + (2.5 + 1) + 2
    assert (s["pos"], s["neg"], s["neu"]) == (round(2.9 / total, 3), round(3.5 / total, 3), round(2 / total, 3))
    assert out[3]["overall_emotion_vader"] == "negative"
    assert out[2]["emotion_tone_scores_vader"] is None


def test_table_lexicon_gives_the_same_as_literal(spark):
    """Also for a large lexicon, equal texts, nulls and tokens listed twice."""
    texts = [t for t, _ in CASES] + [CASES[0][0], None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    literal = rows(S.score_lexicon(df, "t", LEXICON))
    more = [(f"word{i}", 1.0) for i in range(30_000)]
    twice = [(token, valence - 1) for token, valence in LEXICON.items()]
    for entries in ([], more, more + twice):
        lexicon = spark.createDataFrame([*LEXICON.items(), *entries], "token string, valence double")
        assert rows(S.score_lexicon(df, "t", lexicon)) == literal


def test_literal_lexicon_needs_no_shuffle_and_no_python(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = final_plan(S.score_lexicon(docs.select("doc_id", "text"), "text", LEXICON))
    assert "Exchange" not in plan and "Python" not in plan


def test_large_literal_lexicon_plans_quickly(spark):
    big = {f"word{i}": (i % 70 - 35) / 10 for i in range(7500)}
    df = spark.createDataFrame([(1, "word36 word1")], "i int, t string")
    got = S.score_lexicon(df, "t", big).first()["emotion_intensity_vader"]
    assert got == compound((36 - 35) / 10 + (1 - 35) / 10)


def sized_predictor():
    """Remembers batch sizes; equal probabilities for the empty text."""

    def predict(texts):
        n = len(texts)
        return np.array([(0.5, 0.5) if not t else (0.0, n / 1000) for t in texts])

    return predict


@pytest.mark.parametrize("n, last", [(63, 63), (64, 64), (65, 1)])
def test_model_batches(spark, n, last):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(n)], "i int, t string").coalesce(1)
    got = [r["sentiment_score_bert"] for r in I.score_model(df, "t", sized_predictor).orderBy("i").collect()]
    assert got[-1] == last / 1000 and got[0] == min(n, 64) / 1000


def test_model_zero_empty_and_cut(spark):
    df = spark.createDataFrame([(1, None), (2, "a b c d")], "i int, t string").repartition(8)
    out = {r["i"]: r for r in I.score_model(df, "t", sized_predictor).collect()}
    assert out[1]["sentiment_category_bert"] == "negative" and out[1]["sentiment_score_bert"] == 0.0

    def length_predictor():
        return lambda texts: np.array([(0.0, float(len(t))) for t in texts])

    cut = I.score_model(df.where("i = 2"), "t", length_predictor, max_words=2).first()
    assert cut["sentiment_score_bert"] == len("a b")


def test_failing_model_fails_the_job(spark):
    def broken():
        raise RuntimeError("no weights")

    df = spark.createDataFrame([("x",)], "t string")
    with pytest.raises(Exception, match="no weights"):
        I.score_model(df, "t", broken).collect()


def test_model_runs_once_per_row_under_a_filter(spark):
    df = spark.createDataFrame([("x",)], "t string")
    scored = I.score_model(df, "t", sized_predictor).where(F.col("sentiment_category_bert") == "positive")
    assert final_plan(scored).split("Initial Plan")[0].count("ArrowEvalPython") == 1


def test_mean_pool(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 6.0])], "k int, v array<double>")
    assert rows(I.mean_pool(df, "k", "v")) == [(1, [2.0, 3.0]), (2, [5.0, 6.0])]


def test_no_text_is_shuffled_to_a_table_lexicon(spark):
    texts = [(i, f"a good and {w} text number {i}") for i, w in enumerate(["great", "bad", "plain", "horrible"] * 50)]
    df = spark.createDataFrame(texts, "i int, t string").repartition(3)
    lexicon = spark.createDataFrame(list(LEXICON.items()), "token string, valence double")
    scored = S.score_lexicon(df, "t", lexicon)
    scored.collect()
    plan = scored._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert not exchanges, exchanges  # the maps are broadcast
    assert rows(scored) == rows(S.score_lexicon(df, "t", LEXICON))
