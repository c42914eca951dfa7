import zlib

import numpy as np
import pytest

from pressgrain.llm import quality as Q


@pytest.fixture(scope="module")
def scored(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    rows = {r["doc_id"]: r for r in Q.score_documents(docs, labels).collect()}
    return rows, {r["doc_id"]: r["quality"] for r in labels.collect()}


def test_held_out_accuracy(scored):
    rows, labels = scored
    assert len(rows) == 1000
    out = [(rows[d]["score"], y) for d, y in labels.items() if rows[d]["held_out"]]
    good, bad = [s for s, y in out if y == 1], [s for s, y in out if y == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.95
    assert np.mean([s >= 0.7 for s in good]) > 0.97
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows.values())
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in rows.items())


def test_held_out_labels_are_never_read(spark, scored):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    flipped = labels.withColumn("quality", Q.F.when(Q.held_out(Q.F.col("doc_id")), 1 - Q.F.col("quality")).otherwise(Q.F.col("quality")))
    a, b = Q.fit(docs, labels), Q.fit(docs, flipped)
    x = Q.feature_matrix([r["text"] for r in docs.collect()])
    assert np.array_equal(a.scores(x), b.scores(x))


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "a"), (2, "", "b"), (None, "some words here", "c"), (2, "", "b"), (3, "x " * 100_000, "d")],
        "doc_id long, text string, score string",
    )
    labels = spark.createDataFrame([(1, None), (2, 1), (2, 0), (None, 1), (9, 5)], "doc_id long, quality int")
    rows = Q.score_documents(docs, labels).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    assert not [r for r in rows if r["doc_id"] is None][0]["held_out"]
    assert Q.score_documents(docs.limit(0), labels.limit(0)).count() == 0
    assert Q.keep_good(docs, labels.limit(0), threshold=0.0).columns == docs.columns


def test_tables_and_pairs_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = Q.train(x, y, rounds=20, pair_rounds=60)
    fresh = rng.random((2000, 3))
    truth = (fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5)
    assert ((model.scores(fresh) > 0.5) == truth).mean() > 0.85
    assert (0, 1) in model.pairs
    by_row = [model.scores(fresh[i : i + 1])[0] for i in range(50)]
    assert np.allclose(by_row, model.scores(fresh)[:50])


def test_ties_and_repeated_rows(spark):
    """Equal texts score alike whatever their labels; the order and number of rows change nothing."""
    texts = ["the same words again and again", "9 9 9 $$ ## !!", "the same words again and again"]
    rows = [(i, texts[i % 3], "z") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, y string")
    labels = spark.createDataFrame([(i, (i // 3) % 2) for i in range(60)], "doc_id long, quality int")
    one = {(r["doc_id"], r["score"], r["predicted"]) for r in Q.score_documents(docs, labels).collect()}
    again = {(r["doc_id"], r["score"], r["predicted"]) for r in Q.score_documents(docs.union(docs).repartition(7), labels.union(labels)).collect()}
    assert one == again
    by_text = {}
    for d, score, predicted in one:
        by_text.setdefault(texts[d % 3], set()).add((score, predicted))
    assert all(len(found) == 1 for found in by_text.values())
    score = next(iter(by_text[texts[0]]))[0]
    assert {r["predicted"] for r in Q.score_documents(docs.where("doc_id % 3 = 0"), labels, threshold=score).collect()} <= {0, 1}
    kept = Q.keep_good(docs, labels, threshold=score).where("doc_id % 3 = 0").count()
    assert kept == 20  # a score equal to the threshold is good
