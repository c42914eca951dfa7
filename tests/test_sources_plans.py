import sys

import duckdb
import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pressgrain.plans import corpus, digest, labelling, modelling
from pressgrain.session import shared_dir
from pressgrain.schemas import ENRICHED_ORDER
from pressgrain.sources import growing, readers, writers
from pressgrain.sources.stored import stored
from pressgrain.streaming import ingest
from tests.conftest import rows
from tests.test_pages import page

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_topic_json_round_trip(spark, tmp_path):
    records = [
        {"title": "a", "url": "u1", "source": {"id": "bbc", "name": "BBC"}, "search_keyword": "visa AND policy"},
        {"title": "b", "url": "u2", "search_keyword": "refugees"},
    ]
    table = readers.records_to_table(spark, records)
    path = str(tmp_path / "json")
    writers.write_topics_json(table, path)
    assert sorted(p.name for p in (tmp_path / "json").glob("topic_slug=*")) == [
        "topic_slug=news_articles_refugees", "topic_slug=news_articles_visa_policy",
    ]
    back = readers.read_articles_json(spark, path)
    assert rows(back.select("title", "source.id", "search_keyword")) == [
        ("a", "bbc", "visa AND policy"), ("b", None, "refugees"),
    ]


def test_recursive_scan_merges_columns_and_drops_copies(spark, tmp_path):
    for i, (folder, cols) in enumerate([("a", "x string"), ("b/c", "x string, y int")]):
        rows_ = [("same",), ("same",)] if i == 0 else [("other", 1)]
        part = tmp_path / "parts" / str(i)
        spark.createDataFrame(rows_, cols).coalesce(1).write.parquet(str(part))
        target = tmp_path / "root" / folder
        target.mkdir(parents=True)
        next(part.glob("*.parquet")).rename(target / "combined.parquet")
    (tmp_path / "root" / "a" / "ignored.json").write_text("{}")
    got = readers.read_combined(spark, str(tmp_path / "root"), "combined.parquet")
    assert rows(got.select("x", "y")) == [("other", 1), ("same", None)]
    keyed = readers.read_keyed_folder(spark, str(tmp_path / "root" / "a"))
    assert {r["table_key"] for r in keyed.collect()} == {"combined"}


def test_tables_stored_as_folders_are_found_by_their_name(spark, tmp_path):
    root = tmp_path / "with [odd] name"
    spark.createDataFrame([("same", 1), ("same", 1), ("one", 2)], "x string, y int").repartition(3).write.parquet(f"{root}/a/labels.parquet")
    spark.createDataFrame([("same", 1)], "x string, y int").coalesce(1).write.parquet(f"{root}/b/c/labels.parquet")
    spark.createDataFrame([(1.5,)], "z double").write.parquet(f"{root}/a/others.parquet")
    spark.createDataFrame([("file", 3)], "x string, y int").coalesce(1).write.parquet(f"{tmp_path}/part")
    (root / "d").mkdir()
    next((tmp_path / "part").glob("*.parquet")).rename(root / "d" / "labels.parquet")
    found = readers.read_recursive(spark, f"file:{tmp_path}", "labels.parquet")
    assert rows(found) == [("file", 3), ("one", 2), ("same", 1), ("same", 1), ("same", 1)]
    assert rows(readers.read_combined(spark, str(tmp_path), "labels.parquet")) == [("file", 3), ("one", 2), ("same", 1)]
    plain = tmp_path / "plain"
    spark.createDataFrame([("a", 1), ("b", 2)], "x string, y int").repartition(2).write.parquet(f"{plain}/labels.parquet")
    spark.createDataFrame([(1.5,)], "z double").coalesce(1).write.parquet(f"{plain}/others.parquet")
    keyed = readers.read_keyed_folder(spark, f"{plain}/", "l*.parquet")
    assert rows(keyed) == [("a", 1, "labels"), ("b", 2, "labels")]
    every = readers.read_keyed_folder(spark, f"file://{plain}")
    assert rows(every.select("table_key", "x", "z")) == [("labels", "a", None), ("labels", "b", None), ("others", None, 1.5)]


def test_missing_path_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_table(spark, str(tmp_path / "nothing"))


def test_write_by_value_prunes_on_read(spark, tmp_path):
    df = spark.createDataFrame([(1, "MAGA"), (2, "Mainstream"), (3, "MAGA")], "id int, editorial_stance string")
    writers.write_by_value(df, str(tmp_path / "t"))
    back = readers.read_partitioned(spark, str(tmp_path / "t")).where("editorial_stance = 'MAGA'")
    assert rows(back.select("id")) == [(1,), (3,)]
    assert "PartitionFilters: [isnotnull(editorial_stance" in back._jdf.queryExecution().executedPlan().toString()


def test_views_and_prefixed_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "MAGA"), (2, None), (3, "Main stream")], "id int, s string")
    assert writers.publish_views(df, "s") == ["df_MAGA", "df_Main stream", "df_None"]
    assert rows(spark.table("`df_Main stream`").select("id")) == [(3,)]
    assert rows(spark.table("df_None").select("id")) == [(2,)]
    assert writers.publish_views(df, "s", ["MAGA", "none such"]) == ["df_MAGA", "df_none such"]
    assert spark.table("`df_none such`").count() == 0
    df.createOrReplaceTempView("keepme_one")
    assert writers.save_prefixed_tables(spark, "keepme_", str(tmp_path)) == ["keepme_one"]
    assert spark.read.parquet(str(tmp_path / "keepme_one")).count() == 3


def test_more_values_than_views(spark, monkeypatch):
    monkeypatch.setattr(writers, "MOST_VIEWS", 2)
    df = spark.createDataFrame([(i, f"v{i}") for i in range(3)], "id int, s string")
    with pytest.raises(ValueError):
        writers.publish_views(df, "s")


def test_one_table_function_serves_ten_thousand_values(spark):
    df = spark.range(30_000).select("id", F.when(F.col("id") >= 3, F.concat(F.lit("v"), F.col("id") % 10_000)).alias("odd name"))
    name = writers.publish_by_value(df, "odd name", "rows_of")
    assert name == "rows_of"
    assert rows(spark.sql("SELECT id FROM rows_of('v9999')")) == [(19999,), (29999,), (9999,)]
    assert spark.sql("SELECT * FROM rows_of(NULL)").columns == ["id", "odd name"]
    assert rows(spark.sql("SELECT id FROM rows_of(NULL)")) == [(0,), (1,), (2,)]
    assert spark.sql("SELECT * FROM rows_of('none')").count() == 0
    every = spark.sql("SELECT count(*) FROM (SELECT DISTINCT `odd name` AS v FROM rows_of_rows) w, LATERAL rows_of(v)")
    assert every.first()[0] == 30_000


def test_value_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string").write.parquet(str(tmp_path / "t"))
    writers.publish_by_value(spark.read.parquet(str(tmp_path / "t")), "s", "of_s")
    plan = spark.sql("SELECT id FROM of_s('b')")._jdf.queryExecution().executedPlan().toString()
    assert "EqualNullSafe(s,b)" in plan or "EqualTo(s,b)" in plan


def files_of(folder):
    return {p.name: len(list(p.glob("part-*"))) for p in folder.iterdir() if p.is_dir()}


def test_files_do_not_multiply_with_tasks(spark, tmp_path):
    df = spark.range(4000).select("id", F.when(F.col("id") < 3900, "large").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("v")).repartition(24)
    writers.write_by_value(df, str(tmp_path / "t"), "v")
    found = files_of(tmp_path / "t")
    assert len(found) == 51 and sum(found.values()) <= 60
    writers.write_by_value(df, str(tmp_path / "u"), "v", rows_per_file=500)
    assert 8 <= files_of(tmp_path / "u")["v=large"] <= 16
    assert all(len(r) for r in rows(readers.read_partitioned(spark, str(tmp_path / "u"))))
    assert readers.read_partitioned(spark, str(tmp_path / "u")).count() == 4000
    topics = df.select("id", F.col("v").alias("search_keyword"))
    writers.write_topics_json(topics, str(tmp_path / "j"))
    assert sum(files_of(tmp_path / "j").values()) <= 60


def test_growing_table_is_the_same_when_a_batch_comes_again(spark, tmp_path):
    path = str(tmp_path / "grown")
    one = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, None)], "t string, n int")
    two = spark.createDataFrame([("b", None), ("c", 3), ("a", 2)], "t string, n int")
    growing.append_new(one, path, "one")
    assert rows(growing.read_grown(spark, path)) == [("a", 1), ("b", None), (None, None)]
    growing.append_new(two, path, "two")
    expected = [("a", 1), ("a", 2), ("b", None), ("c", 3), (None, None)]
    assert rows(growing.read_grown(spark, path)) == expected
    for batch, name in ((two, "two"), (one, "one"), (two, "two")):
        growing.append_new(batch, path, name)
        assert rows(growing.read_grown(spark, path)) == expected
    growing.append_new(one, path, "three")  # nothing new
    assert rows(growing.read_grown(spark, path)) == expected


def test_route_outputs(spark):
    files = spark.createDataFrame(
        [("df_border_security_x.xlsx",), ("df_x.xlsx",), ("df_Visa_y.xlsx",), ("df_visa_policy_new.xlsx",), ("df_moon_base_x.xlsx",), ("a__b_c",)],
        "file_name string",
    )
    folders = spark.createDataFrame(
        [("news_articles_Border_Security",), ("news_articles_Visa_Policy",), ("old_visa_policy_NEW",), ("b",)], "folder string"
    )
    assert rows(writers.route_outputs(files, folders)) == [
        ("a__b_c", "b"),
        ("df_border_security_x.xlsx", "news_articles_Border_Security"),
        ("df_visa_policy_new.xlsx", "news_articles_Visa_Policy"),
    ]


def test_spread_leaves_enough_files_alone(spark, tmp_path):
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    spark.range(100, numPartitions=1).write.parquet(one)
    spark.range(100, numPartitions=9).write.parquet(many)
    assert readers.spread(spark.read.parquet(one)).rdd.getNumPartitions() == 4
    table = spark.read.parquet(many)
    assert readers.spread(table) is table


def test_stored_in_the_shared_folder(spark):
    df = stored(spark.range(3).toDF("x"))
    assert rows(df) == [(0,), (1,), (2,)]
    assert shared_dir(spark) in df.inputFiles()[0]


def letters():
    def predict(texts):
        return np.array([(0.2, 0.8) if "good" in t else (0.9, 0.1) for t in texts])

    return predict


def encoder():
    return lambda texts: np.array([[float(t.count("good")), float(len(t))] for t in texts], dtype=np.float32)


def fetched(spark):
    data = []
    for i in range(60):
        mood = "good lovely" if i % 2 else "awful broken"
        host = ["www.fox-news.com", "bbc.co.uk", "m.paper.org"][i % 3]
        body = f"<p>Immigration policy story number{'abcdefghij'[i % 10]} was {mood} today.</p><p>People agree. Border town {'xyz'[i % 3] * 4} {'klm'[i // 3 % 3] * 5} {'pqrstuvwxyz'[i % 11] * 6}</p>"
        data.append((f"https://{host}/{i}", 200, page(body).replace("A &amp; B", f"Story {i}")))
    data.append(("https://bbc.co.uk/0", 200, page("<p>Gaza story</p>").replace("A &amp; B", "gaza")))
    data.append(data[0])
    return spark.createDataFrame(data, "url string, status int, html string")


def test_all_stages(spark):
    pages = fetched(spark)
    found = pages.select("url", F.lit("Immigration Policy").alias("title"), F.lit(None).cast("string").alias("description"), F.lit("x").alias("content"))
    read = corpus.pages_to_read(found.dropDuplicates(["url"]), pages, ["immigration AND policy"])
    articles = corpus.build_corpus(read, status="status")
    assert articles.count() == 60 and articles.where("theme <> 'immigration AND policy'").count() == 0
    lexicon = {"good": 2.0, "lovely": 2.5, "awful": -2.0, "broken": -1.5, "agree": 0.4}
    labelled = stored(
        labelling.label_articles(articles, lexicon, letters, stances={"BBC": "Mainstream", "Fox News": "MAGA"})
    )
    assert labelled.count() == 60
    stances = {(r["publisher"], r["editorial_stance"]) for r in labelled.collect()}
    assert stances == {("Fox News", "MAGA"), ("Bbc", "Mainstream"), ("M", "Mainstream")}
    modelled = modelling.model_articles(labelled, grid_search=False, depths=(5,), stop_words=["the"])
    assert modelled.articles.columns == ENRICHED_ORDER and modelled.articles.count() == 60
    assert modelled.classifier.report.where("class = 'accuracy'").first()["precision"] > 0.8
    final = stored(modelled.articles)
    found_themes = digest.stance_themes(final, encoder, "url", n_topics=2, stop_words=[])
    assert {r["editorial_stance"] for r in found_themes.collect()} == {"MAGA", "Mainstream"}
    assert digest.theme_top_words(found_themes, "MAGA").count() == 5
    summaries = digest.stance_summaries(final, "url")
    assert {r["editorial_stance"] for r in summaries.collect()} == {"MAGA", "Mainstream"}
    generated = digest.stance_summaries(final, "url", generator=lambda: lambda t: t[:12])
    assert {r["summary"] for r in generated.collect()} == {"summarize: I"}


def test_models_are_fitted_on_one_written_table(spark, monkeypatch):
    data = [(i, f"{'bright happy' if i % 3 else 'dark gloomy'} street water {'abcdefg'[i % 7] * 4}", "positive" if i % 3 else "negative", None) for i in range(60)]
    labelled = spark.createDataFrame(data, "unique_id int, content string, overall_emotion_vader string, author string")
    seen = []
    for name in ("train", "tree_features", "fit_topics"):
        fit = getattr(modelling, name)
        monkeypatch.setattr(modelling, name, lambda df, *a, fit=fit, **k: seen.append(df) or fit(df, *a, **k))
    made = modelling.model_articles(labelled.withColumn("content", F.upper("content")), grid_search=False, depths=(2,), stop_words=["the"])
    assert len(seen) == 3 and all(sorted(df.columns) == ["content", "overall_emotion_vader", "unique_id"] for df in seen)
    assert not any("upper(" in df._jdf.queryExecution().optimizedPlan().toString() for df in seen)
    assert made.articles.columns == ENRICHED_ORDER and made.articles.count() == 60
    assert made.articles.where("predicted_sentiment_multinomialnb <> overall_emotion_vader").count() == 0


def test_stream_equals_batch(spark, tmp_path):
    pages = fetched(spark)
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    pages.repartition(3).write.parquet(folder)
    stream = ingest.article_stream(ingest.page_stream(spark, folder, pages.schema))
    query = ingest.append_articles(stream, out, "articles")
    query.awaitTermination(120)
    assert rows(spark.read.parquet(out)) == rows(ingest.article_stream(pages))
    pages.limit(1).write.mode("append").parquet(folder)
    ingest.append_articles(stream, out, "articles").awaitTermination(120)
    assert spark.read.parquet(out).count() == ingest.article_stream(pages).count() + 1


def test_entry_and_registry(spark):
    report = entry.entry(spark)
    assert report.count() > 0 and report.columns[0] == "publisher"
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 90


SAMPLE = ["ag05_bias_report", "jn04_map_stance", "ml13_lexicon_scores", "ag11_group_beginning", "ml08_naive_bayes_tables", "prj04_page_fields"]


@pytest.mark.parametrize("name", SAMPLE)
def test_queries_equal_their_sql(spark, sf, name):
    from pathlib import Path

    from tools.check_oracle import normal

    con = duckdb.connect()
    for f in Path(sf).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    df = entry.queries()[name](spark, sf)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(entry.oracle_sql()[name])
    assert got == normal([d[0] for d in cursor.description], cursor.fetchall())
