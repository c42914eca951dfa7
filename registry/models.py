"""Text features, classifiers, topics, trees, themes, summaries and sinks."""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window, functions as F

from pressgrain.functions import text as T
from pressgrain.operators import (
    bayes as NB,
    features as FE,
    rows as R,
    summaries as SU,
    tfidf as TF,
    themes as TH,
    topics as TO,
    trees as TR,
)
from pressgrain.operators.grid import grid_accuracy
from pressgrain.session import shared_dir
from pressgrain.sources import growing, readers, writers
from pressgrain.sources.stored import stored
from registry.base import (
    LABELLED_SQL,
    class_report_sql,
    clean_sql,
    labelled,
    query,
    r6,
    sql_in,
    table,
    texts,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STOP = ["the", "and", "that", "for", "les", "que", "und", "der", "para", "del", "like", "said", "says"]


def _articles(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "text")
    return docs.select("doc_id", T.clean_words(F.col("text")).alias("content"))


def _labelled_articles(spark, sf):
    rows = labelled(spark, sf, "doc_id", "content", "label_model")
    return rows.withColumn("content", T.clean_words(F.col("content")))


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/queries-{uuid.uuid4().hex}"


def tokens_sql(column: str = "text", stop=()) -> str:
    keep = f" AND w NOT IN {sql_in(stop)}" if stop else ""
    return f"list_filter(string_split(lower({clean_sql(column)}), ' '), lambda w: w <> ''{keep})"


TOK = f"tok AS (SELECT doc_id, unnest({tokens_sql()}) AS token FROM documents)"
TOK_STOP = f"tok AS (SELECT doc_id, unnest({tokens_sql(stop=STOP)}) AS token FROM documents)"
COUNTS = "tc AS (SELECT doc_id, token, count(*) AS tf FROM tok GROUP BY 1, 2), fr AS (SELECT token, count(*) AS df, sum(tf)::BIGINT AS total FROM tc GROUP BY 1), nd AS (SELECT count(*) AS n FROM documents)"
WEIGH = """
    rw AS (SELECT doc_id, tc.token, tf, tf * (ln((n + 1) / (df + 1)) + 1) AS raw FROM tc JOIN vocab USING (token), nd),
    wt AS (SELECT doc_id, token, tf, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM rw)
"""


@query(f"""
    SELECT doc_id, array_to_string(list_filter({tokens_sql()}, lambda w: length(w) >= 2), ' ') AS word_tokens,
           array_to_string({tokens_sql()}, ' ') AS alpha_tokens FROM documents
""")
def ml01_tokens(spark, sf):
    return _articles(spark, sf).select(
        "doc_id",
        F.array_join(T.word_tokens(F.col("content")), " ").alias("word_tokens"),
        F.array_join(T.alpha_tokens(F.col("content")), " ").alias("alpha_tokens"),
    )


@query(f"SELECT doc_id, array_to_string({tokens_sql(stop=STOP)}, ' ') AS tokens FROM documents")
def ml02_stop_words(spark, sf):
    kept = T.without(T.alpha_tokens(F.col("content")), STOP)
    return _articles(spark, sf).select("doc_id", F.array_join(kept, " ").alias("tokens"))


@query(f"WITH {TOK}, {COUNTS}, vocab AS (SELECT * FROM fr), {WEIGH} SELECT doc_id, token, tf, round(weight, 6) AS weight FROM wt")
def ml03_tfidf(spark, sf):
    weights = TF.tfidf(_articles(spark, sf), "doc_id", T.word_tokens(F.col("content")))
    return weights.withColumn("weight", r6("weight"))


BIGRAM_TOK = f"""
    lists AS (SELECT doc_id, {tokens_sql(stop=STOP)} AS ts FROM documents),
    tok AS (SELECT doc_id, unnest(ts) AS token FROM lists UNION ALL
            SELECT doc_id, unnest(list_transform(range(1, len(ts)), lambda i: ts[i] || ' ' || ts[i + 1])) FROM lists)
"""


@query(f"""
    WITH {BIGRAM_TOK}, {COUNTS}, vocab AS (SELECT fr.* FROM fr, nd WHERE df <= 0.5 * n), {WEIGH}
    SELECT doc_id, token, tf, round(weight, 6) AS weight FROM wt
""")
def ml04_tfidf_bigrams(spark, sf):
    rows = FE.with_tokens(_articles(spark, sf), "content", STOP)
    weights = TF.tfidf(rows, "doc_id", F.col("tokens_pairs"), max_df=0.5)
    return weights.withColumn("weight", r6("weight"))


@query(f"""
    WITH {TOK}, {COUNTS}, vocab AS (SELECT * FROM fr ORDER BY total DESC, token LIMIT 1000), {WEIGH}
    SELECT doc_id, token, tf, round(weight, 6) AS weight FROM wt
""")
def ml05_tfidf_limited(spark, sf):
    weights = TF.tfidf(_articles(spark, sf), "doc_id", T.word_tokens(F.col("content")), max_features=1000)
    return weights.withColumn("weight", r6("weight"))


@query(f"""
    WITH {TOK}, {COUNTS}, vocab AS (SELECT * FROM fr), {WEIGH}
    SELECT doc_id, count(*) AS n_terms, round(sum(weight), 6) AS weight_sum, round(max(weight), 6) AS weight_max FROM wt GROUP BY 1
""")
def ml04_mllib_tfidf(spark, sf):
    """The MLlib stages give the exact formula: figures per document."""
    words = T.word_tokens(F.col("content"))
    rows = stored(_articles(spark, sf).select("doc_id", words.alias("tokens")))  # read by each stage
    fitted = Pipeline(stages=FE.tfidf_stages()).fit(rows)
    weights = fitted.transform(rows).select("doc_id", F.unwrap_udt("features")["values"].alias("v"))
    kept = F.filter("v", lambda x: x != 0)
    return weights.select("doc_id", kept.alias("v")).where(F.size("v") > 0).select(
        "doc_id",
        F.size("v").cast("long").alias("n_terms"),
        r6(F.aggregate("v", F.lit(0.0), lambda a, x: a + x)).alias("weight_sum"),
        r6(F.array_max("v")).alias("weight_max"),
    )


@query(f"WITH {TOK_STOP}, {COUNTS} SELECT doc_id, token, tf FROM tc")
def ml06_bag_of_words(spark, sf):
    tokens = T.without(T.alpha_tokens(F.col("content")), STOP)
    counts = TF.term_counts(_articles(spark, sf), "doc_id", tokens)
    return counts.withColumn("tf", F.col("tf").cast("long"))


@query(f"WITH {TOK}, {COUNTS} SELECT token, df, total FROM fr")
def ag17_document_frequency(spark, sf):
    terms = TF.term_counts(_articles(spark, sf), "doc_id", T.word_tokens(F.col("content")))
    return TF.document_frequency(terms)


SPLIT_SQL = "('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 5 = 0"


@query(f"SELECT doc_id, CASE WHEN {SPLIT_SQL} THEN 'test' ELSE 'train' END AS split FROM documents")
def ml07_train_test_split(spark, sf):
    return FE.with_split(table(spark, sf, "documents").select("doc_id"), "doc_id")


TEXTBOOK_PRIOR = "ln(k / n)"
WITH_PAIRS = "list_concat(ts, list_transform(range(1, len(ts)), lambda i: ts[i] || ' ' || ts[i + 1]))"


def nb_sql(target: str, alpha: str | float, ngrams: str | int = 1, max_df: str | float = 1.0) -> str:
    """Predictions for the (doc_id, ts) rows of ``target`` by the textbook formulas.

    The settings may be SQL expressions.
    """
    terms = f"CASE WHEN {ngrams} = 2 THEN {WITH_PAIRS} ELSE ts END"
    return f"""
    art AS (SELECT doc_id, label_model AS label, {tokens_sql('content', STOP)} AS ts, {SPLIT_SQL} AS test FROM ({LABELLED_SQL})),
    tok AS (SELECT doc_id, label, unnest({terms}) AS token FROM art WHERE NOT test),
    tc AS (SELECT doc_id, label, token, count(*) AS tf FROM tok GROUP BY ALL),
    nd AS (SELECT count(*) AS n FROM art WHERE NOT test),
    fr AS (SELECT token, ln((any_value(n) + 1) / (count(*) + 1)) + 1 AS idf FROM tc, nd GROUP BY token
           HAVING count(*) / any_value(n) <= {max_df}),
    rw AS (SELECT doc_id, label, token, tf * idf AS raw FROM tc JOIN fr USING (token)),
    wt AS (SELECT *, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS w FROM rw),
    cls AS (SELECT label, {TEXTBOOK_PRIOR} AS prior FROM (SELECT label, count(*) AS k FROM art WHERE NOT test GROUP BY label), nd),
    sums AS (SELECT g.token, g.label, coalesce(sum(w), 0) + {alpha} AS s FROM (SELECT token, label FROM fr, cls) g
             LEFT JOIN wt t ON t.token = g.token AND t.label = g.label GROUP BY 1, 2),
    theta AS (SELECT token, label, ln(s) - ln(sum(s) OVER (PARTITION BY label)) AS lp FROM sums),
    tgt AS ({target}),
    ttc AS (SELECT doc_id, token, count(*) AS tf FROM (SELECT doc_id, unnest({terms}) AS token FROM tgt) GROUP BY ALL),
    trw AS (SELECT doc_id, token, tf * idf AS raw FROM ttc JOIN fr USING (token)),
    twt AS (SELECT *, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS w FROM trw),
    ev AS (SELECT doc_id, label, sum(w * lp) AS e FROM twt JOIN theta USING (token) GROUP BY ALL),
    sc AS (SELECT t.doc_id, c.label, round(c.prior + coalesce(ev.e, 0), 9) AS score
           FROM tgt t CROSS JOIN cls c LEFT JOIN ev ON ev.doc_id = t.doc_id AND ev.label = c.label),
    pred AS (SELECT doc_id, label AS prediction FROM
             (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS r FROM sc) WHERE r = 1)
    """


TEST_ROWS = "SELECT doc_id, ts FROM art WHERE test"
LABELLED_ROWS = "SELECT doc_id, ts FROM art"
ALL_ROWS = f"SELECT doc_id, {tokens_sql(stop=STOP)} AS ts FROM documents"
CLASSES = ["negative", "positive"]


@query(f"WITH {nb_sql(TEST_ROWS, 0.01)} SELECT doc_id, prediction FROM pred")
def ml08_naive_bayes_tables(spark, sf):
    rows = _labelled_articles(spark, sf).withColumnRenamed("label_model", "label")
    train, test = rows.where(~FE.in_test("doc_id")), rows.where(FE.in_test("doc_id"))
    tokens = T.without(T.alpha_tokens(F.col("content")), STOP)
    n_train = train.agg(F.count(F.lit(1))).scalar()
    train_terms = TF.term_counts(train, "doc_id", tokens)
    frequency = TF.document_frequency(train_terms)
    train_weights = TF.weigh(train_terms, frequency, n_train, "doc_id")
    test_weights = TF.weigh(TF.term_counts(test, "doc_id", tokens), frequency, n_train, "doc_id")
    token_table, priors = NB.train_tables(
        train_weights, train.select("doc_id", "label"), "doc_id", CLASSES, alpha=1e-2
    )
    return NB.predict_tables(test, test_weights, token_table, priors, "doc_id", CLASSES)


@query(f"""
    WITH {nb_sql(TEST_ROWS, 1.0)},
    {class_report_sql("SELECT label AS l, prediction AS p FROM art JOIN pred USING (doc_id)")}
""")
def ml08_naive_bayes_report(spark, sf):
    """Held-out report of the model without grid search."""
    trained = NB.train(
        _labelled_articles(spark, sf), "content", "label_model", "doc_id", grid_search=False, stop_words=STOP
    )
    report = trained.report
    return report.select("class", *[r6(m).alias(m) for m in ("precision", "recall", "f1")], "support")


MAX_DF, NGRAMS, ALPHA, FOLDS = NB.MAX_DF, NB.NGRAMS, NB.ALPHA, 5
FOLD_SQL = "(row_number() OVER (PARTITION BY label_model ORDER BY md5(doc_id::VARCHAR)) - 1) % 5"
GRID_SQL = f"""
    WITH art AS (SELECT doc_id, label_model AS label, {tokens_sql('content', STOP)} AS ts, {FOLD_SQL} AS home
                 FROM ({LABELLED_SQL}) WHERE NOT ({SPLIT_SQL})),
    tok AS (SELECT doc_id, 1 AS ngrams, unnest(ts) AS token FROM art UNION ALL
            SELECT doc_id, 2, unnest(ts) FROM art UNION ALL
            SELECT doc_id, 2, unnest(list_transform(range(1, len(ts)), lambda i: ts[i] || ' ' || ts[i + 1])) FROM art),
    tc AS (SELECT doc_id, label, home, ngrams, token, count(*) AS tf FROM tok JOIN art USING (doc_id) GROUP BY ALL),
    fold AS (SELECT unnest(range(5)) AS fold),
    mx AS (SELECT unnest([0.5, 0.75, 1.0]::DOUBLE[]) AS max_df),
    al AS (SELECT unnest([0.01, 0.001, 0.0001]::DOUBLE[]) AS alpha),
    nd AS (SELECT fold, count(*) AS n FROM fold JOIN art ON home <> fold GROUP BY fold),
    fr AS (SELECT fold, ngrams, token, count(*) AS df FROM fold JOIN tc ON home <> fold GROUP BY ALL),
    vo AS (SELECT max_df, fr.fold, ngrams, token, ln((n + 1) / (df + 1)) + 1 AS idf FROM fr JOIN nd USING (fold) JOIN mx ON df / n <= max_df),
    rw AS (SELECT max_df, fold, ngrams, token, doc_id, label, home <> fold AS train, tf * idf AS raw FROM tc JOIN vo USING (ngrams, token)),
    wt AS (SELECT *, raw / sqrt(sum(raw * raw) OVER (PARTITION BY max_df, fold, ngrams, doc_id)) AS w FROM rw),
    cls AS (SELECT fold, label, ln(count(*) / any_value(n)) AS prior FROM nd JOIN art ON home <> fold GROUP BY fold, label),
    sm AS (SELECT max_df, fold, ngrams, token, c.label, coalesce(sum(w) FILTER (wt.label = c.label), 0) AS s
           FROM wt JOIN cls c USING (fold) WHERE train GROUP BY ALL),
    th AS (SELECT alpha, max_df, fold, ngrams, token, label,
                  ln(s + alpha) - ln(sum(s + alpha) OVER (PARTITION BY alpha, max_df, fold, ngrams, label)) AS lp FROM sm, al),
    ev AS (SELECT alpha, th.max_df, th.fold, th.ngrams, doc_id, th.label, sum(w * lp) AS e
           FROM wt JOIN th ON th.max_df = wt.max_df AND th.fold = wt.fold AND th.ngrams = wt.ngrams AND th.token = wt.token
           WHERE NOT train GROUP BY ALL),
    cand AS (SELECT alpha, max_df, ng.ngrams, a.doc_id, a.label AS truth, c.fold, c.label, prior
             FROM art a JOIN cls c ON c.fold = a.home, al, mx, (SELECT unnest([1, 2]) AS ngrams) ng),
    sc AS (SELECT c.*, round(prior + coalesce(e, 0), 9) AS score FROM cand c LEFT JOIN ev USING (alpha, max_df, fold, ngrams, doc_id, label)),
    pr AS (SELECT *, row_number() OVER (PARTITION BY alpha, max_df, ngrams, doc_id ORDER BY score DESC, label) AS r FROM sc),
    ac AS (SELECT max_df, ngrams, alpha, fold, avg((label = truth)::INT) AS a FROM pr WHERE r = 1 GROUP BY ALL)
    SELECT max_df, ngrams, alpha, round(avg(a), 6) AS accuracy FROM ac GROUP BY ALL
"""


@query(GRID_SQL)
def ml09_grid_search(spark, sf):
    """Cross-validated accuracy of all eighteen settings."""
    rows = NB.training_rows(_labelled_articles(spark, sf), "content", "label_model", "doc_id", stop_words=STOP)
    accuracy = grid_accuracy(
        rows.where(~FE.in_test("doc_id")), "doc_id", CLASSES,
        max_df=MAX_DF, ngrams=NGRAMS, alpha=ALPHA, folds=FOLDS,
    )
    return accuracy.withColumn("accuracy", r6("accuracy"))


BEST_SQL = f"best AS (SELECT * FROM ({GRID_SQL}) ORDER BY accuracy DESC, alpha DESC, max_df, ngrams LIMIT 1)"


@query(f"""
    WITH {BEST_SQL},
    {nb_sql(TEST_ROWS, "(SELECT alpha FROM best)", "(SELECT ngrams FROM best)", "(SELECT max_df FROM best)")},
    rep AS (WITH {class_report_sql("SELECT label AS l, prediction AS p FROM art JOIN pred USING (doc_id)")})
    SELECT rep.*, max_df::DOUBLE AS best_max_df, ngrams::DOUBLE AS best_ngrams, alpha::DOUBLE AS best_alpha FROM rep, best
""")
def ml09_best_model(spark, sf):
    """Held-out report of the best setting of the grid."""
    trained = NB.train(_labelled_articles(spark, sf), "content", "label_model", "doc_id", stop_words=STOP)
    best = trained.best_parameters
    return trained.report.select(
        "class", *[r6(m).alias(m) for m in ("precision", "recall", "f1")], "support",
        *[F.lit(float(best[k])).alias(f"best_{k}") for k in ("max_df", "ngrams", "alpha")],
    )


@query(f"WITH {nb_sql(ALL_ROWS, 1.0)} SELECT doc_id, prediction AS predicted_sentiment_multinomialnb FROM pred")
def ml11_predict_all(spark, sf):
    """A label for every document, from a model fitted on the labelled ones."""
    trained = NB.train(
        _labelled_articles(spark, sf), "content", "label_model", "doc_id", grid_search=False, stop_words=STOP
    )
    return NB.add_prediction(_articles(spark, sf), "content", trained.model, stop_words=STOP).drop("content")


@query("""
    SELECT doc_id, lang, (SELECT count(DISTINCT lang) FROM documents q WHERE q.lang < d.lang)::DOUBLE AS label FROM documents d
""")
def prj15_label_encode(spark, sf):
    return FE.encode_labels(table(spark, sf, "documents").select("doc_id", "lang"), "lang")


@query("SELECT lang, (row_number() OVER (ORDER BY lang) - 1)::INT AS code FROM (SELECT DISTINCT lang FROM documents)")
def prj15_label_codes(spark, sf):
    return FE.label_codes(table(spark, sf, "documents"), "lang")


# --- topics and trees ---------------------------------------------------------


def _topics(spark, sf):
    articles = stored(_articles(spark, sf))  # cleaned once
    return articles, TO.fit_topics(articles, "content", stop_words=STOP)


@query(f"""
    WITH {TOK_STOP}, v AS (SELECT count(DISTINCT token) AS n_vocabulary FROM tok)
    SELECT d.doc_id, count(token) AS n_words, any_value(n_vocabulary) AS n_vocabulary,
           (count(token) > 0)::INT::DOUBLE AS mass, count(token) > 0 AS proper
    FROM documents d CROSS JOIN v LEFT JOIN tok ON tok.doc_id = d.doc_id GROUP BY 1
""")
def ml12_lda_topics(spark, sf):
    """Each text's counted words and topic shares: every word is counted, shares sum to one (to zero without words)."""
    articles, topics = _topics(spark, sf)
    words = F.size(TO.topic_tokens("content", STOP)).cast("long")
    scored = TO.topic_shares(articles, topics, "share").select("doc_id", words.alias("n_words"), "share")
    return scored.select(
        "doc_id", "n_words", F.lit(topics.model.weights.count()).alias("n_vocabulary"),
        r6(F.aggregate("share", F.lit(0.0), lambda x, y: x + y)).alias("mass"),
        F.forall("share", lambda s: (s > 0) & (s < 1)).alias("proper"),
    )


@query(f"""
    WITH {TOK_STOP}, w AS (SELECT DISTINCT token FROM tok)
    SELECT t AS topic, p AS position, true AS occurs, true AS ordered
    FROM (SELECT unnest(range(5))::INT AS t), (SELECT unnest(range(10))::INT AS p) WHERE (SELECT count(*) FROM w) >= 10
""")
def tk02_topic_words(spark, sf):
    """Ten words for each topic, heaviest first, all of them words of the texts."""
    articles, topics = _topics(spark, sf)
    known = articles.select(F.explode(TO.topic_tokens("content", STOP)).alias("word")).distinct()
    before = F.lag("weight").over(Window.partitionBy("topic").orderBy("position"))
    return (
        topics.words.withColumn("ordered", F.coalesce(F.col("weight") <= before, F.lit(True)))
        .join(known.withColumn("occurs", F.lit(True)), "word", "left")
        .select("topic", F.col("position").cast("int").alias("position"), F.coalesce("occurs", F.lit(False)).alias("occurs"), "ordered")
    )


@query("SELECT doc_id, 10::BIGINT AS n_words, true AS heaviest FROM documents")
def ml12a_topic_labels(spark, sf):
    """Each text's label is the word list of its heaviest topic."""
    articles, topics = _topics(spark, sf)
    labelled_rows = TO.label_topics(articles, topics).select("doc_id", "LDA_label")
    shares = TO.topic_shares(articles, topics, "share").select("doc_id", F.posexplode("share").alias("topic", "share"))
    named = shares.join(topics.labels(), "topic").groupBy("doc_id").agg(
        F.max("share").alias("most"), F.map_from_entries(F.collect_list(F.struct("topic_label", "share"))).alias("of")
    )
    return labelled_rows.join(named, "doc_id").select(
        "doc_id", F.size(F.split("LDA_label", ", ")).cast("long").alias("n_words"),
        (F.element_at("of", F.col("LDA_label")) >= F.col("most") - 1e-9).alias("heaviest"),
    )


TOPICS, STEPS = 5, 3


def _digamma_sql(x: str) -> str:
    y, z = f"({x} + 6)", f"(1 / (({x} + 6) * ({x} + 6)))"
    shift = " + ".join(f"1 / ({x} + {i})" for i in range(6))
    series = f"{z} * (1.0 / 12 - {z} * (1.0 / 120 - {z} * (1.0 / 252 - {z} * (1.0 / 240 - {z} / 132.0))))"
    return f"(ln({y}) - 0.5 / {y} - {series} - ({shift}))"


def _inference_sql(name: str, weights: str) -> str:
    """Expected counts ``{name}c`` and topic weights ``{name}g`` of each text, from (token, j, w) weights."""
    psi = _digamma_sql
    parts = [f"""
        {name}t AS MATERIALIZED (SELECT j, sum(w) AS t FROM {weights} GROUP BY j),
        {name}b AS MATERIALIZED (SELECT token, j, exp({psi('w')} - {psi('t')}) AS e FROM {weights} JOIN {name}t USING (j)),
        {name}g0 AS MATERIALIZED (SELECT doc_id, j, 1.0::DOUBLE AS g FROM (SELECT DISTINCT doc_id FROM tc), (SELECT unnest(range({TOPICS})) AS j))"""]
    for s in range(STEPS):
        parts.append(f"""
        {name}h{s} AS MATERIALIZED (SELECT doc_id, j, exp({psi('g')} - {psi('s')}) AS e FROM (SELECT *, sum(g) OVER (PARTITION BY doc_id) AS s FROM {name}g{s})),
        {name}c{s} AS MATERIALIZED (SELECT doc_id, token, j, p * (tf / sum(p) OVER (PARTITION BY doc_id, token)) AS c
            FROM (SELECT tc.doc_id, tc.token, b.j, tf, h.e * b.e AS p FROM tc JOIN {name}b b USING (token) JOIN {name}h{s} h ON h.doc_id = tc.doc_id AND h.j = b.j)),
        {name}g{s + 1} AS MATERIALIZED (SELECT doc_id, j, sum(c) + {1 / TOPICS} AS g FROM {name}c{s} GROUP BY doc_id, j)""")
    return ",".join(parts) + f""",
        {name}c AS (SELECT * FROM {name}c{STEPS - 1}), {name}g AS (SELECT * FROM {name}g{STEPS})"""


ITERATION_SQL = f"""
    {TOK_STOP}, tc AS MATERIALIZED (SELECT doc_id, token, count(*) AS tf FROM tok GROUP BY 1, 2),
    w0 AS MATERIALIZED (SELECT token, j, 0.1 - ln((('0x' || substr(md5(token || ':' || j || ':42'), 1, 8))::BIGINT + 0.5) / 4294967296) AS w
           FROM (SELECT DISTINCT token FROM tc), (SELECT unnest(range({TOPICS})) AS j)),
    {_inference_sql("x", "w0")},
    w1 AS MATERIALIZED (SELECT token, j, sum(c) + {1 / TOPICS} AS w FROM xc GROUP BY token, j)
"""


def _after_one_iteration(spark, sf):
    articles = stored(_articles(spark, sf))
    blocks = TO.text_blocks(articles, "content", STOP)
    weights = TO.improved(blocks, TO.first_weights(blocks, TOPICS), TOPICS, 1 / TOPICS, STEPS)
    model = TO.TopicModel(stored(weights), TOPICS, 1 / TOPICS, STEPS)
    return articles, TO.Topics(model, model.top_words(10), blocks, "content")


@query(f"""
    WITH {ITERATION_SQL} SELECT token, {", ".join(f"round(max(w) FILTER (j = {j}), 6) AS w{j}" for j in range(TOPICS))} FROM w1 GROUP BY token
""")
def ml12_topic_iteration(spark, sf):
    """Every word's weight in every topic, after one iteration from the first weights."""
    _, topics = _after_one_iteration(spark, sf)
    return topics.model.weights.select("token", *[r6(F.get("weights", F.lit(j))).alias(f"w{j}") for j in range(TOPICS)])


@query(f"""
    WITH {ITERATION_SQL}, {_inference_sql("y", "w1")},
    top AS (SELECT j, string_agg(token, ', ' ORDER BY r) AS label FROM
            (SELECT *, row_number() OVER (PARTITION BY j ORDER BY w DESC, token) AS r FROM w1) WHERE r <= 10 GROUP BY j),
    best AS (SELECT doc_id, j FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(g / s, 9) DESC, j) AS r
             FROM (SELECT *, sum(g) OVER (PARTITION BY doc_id) AS s FROM yg)) WHERE r = 1)
    SELECT d.doc_id, label AS "LDA_label" FROM documents d LEFT JOIN best USING (doc_id) JOIN top ON top.j = coalesce(best.j, 0)
""")
def ml12a_labels_after_one_iteration(spark, sf):
    """Every text's label from the ten heaviest words of its dominant topic."""
    articles, topics = _after_one_iteration(spark, sf)
    return TO.label_topics(articles, topics).select("doc_id", "LDA_label")


@query("SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INT AS dominant FROM embeddings")
def tk05_vector_argmax(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", TO.argmax(F.col("embedding")).alias("dominant"))


def _tree_data(spark, sf):
    return TR.tree_features(_labelled_articles(spark, sf), "content", "label_model", "doc_id")


TREE_TOK = f"tok AS (SELECT unnest({tokens_sql('content')}) AS token FROM ({LABELLED_SQL}))"


@query(f"""
    WITH {TREE_TOK}, art AS (SELECT label_model AS label FROM ({LABELLED_SQL}) WHERE NOT ({SPLIT_SQL})),
    most AS (SELECT max(n) / sum(n) AS share FROM (SELECT count(*) AS n FROM art GROUP BY label))
    SELECT max_depth, depth_limit, least(1000, (SELECT count(DISTINCT token) FROM tok))::BIGINT AS n_features,
           true AS odd, true AS within, share IS NOT NULL AS better
    FROM (VALUES ('None', NULL::INT), ('10', 10), ('5', 5)) v(max_depth, depth_limit), most
""")
def ml15_decision_trees(spark, sf):
    """Trees at three depths: binary, within their limit, no worse than the most frequent label."""
    data = _tree_data(spark, sf)
    rows = TR.training_rows(data)
    trees = TR.train_trees(rows)
    largest = rows.rows.groupBy("code").count().agg((F.max("count") / F.sum("count"))).scalar()
    n_features = data.values.select(F.count_distinct("feature")).scalar()
    leaf_rows = F.sum(F.when(F.col("feature").isNull(), F.greatest("n0", "n1"))) / F.sum(
        F.when(F.col("feature").isNull(), F.col("n0") + F.col("n1"))
    )
    right = R.union_by_name(*[
        nodes.agg(leaf_rows.alias("accuracy")).select(F.lit("None" if d is None else str(d)).alias("max_depth"), "accuracy")
        for d, nodes in trees.items()
    ])
    return TR.tree_metrics(trees).join(right, "max_depth").select(
        "max_depth", "depth_limit", n_features.alias("n_features"), (F.col("n_nodes") % 2 == 1).alias("odd"),
        F.coalesce(F.col("depth") <= F.col("depth_limit"), F.lit(True)).alias("within"), (F.col("accuracy") >= largest).alias("better"),
    )


@query(f"""
    WITH art AS (SELECT label_model AS label FROM ({LABELLED_SQL}) WHERE NOT ({SPLIT_SQL}))
    SELECT max_depth, -1::BIGINT AS nodes_less_leaves, (SELECT count(*) FROM art) AS leaf_rows,
           (SELECT count(*) FROM art WHERE label = 'negative') AS root_negative, true AS placed
    FROM (VALUES ('None'), ('10'), ('5')) v(max_depth)
""")
def ml15b_tree_nodes(spark, sf):
    """Node tables of three trees: 2 n - 1 nodes for n leaves, every training row in one leaf."""
    data = _tree_data(spark, sf)
    parts = []
    for depth, nodes in TR.train_trees(TR.training_rows(data)).items():
        leaf = F.col("is_leaf")
        parts.append(TR.node_table(nodes, data.classes).agg(
            (F.count(F.lit(1)) - 2 * F.count_if(leaf)).alias("nodes_less_leaves"),
            F.sum(F.when(leaf, F.col("n0") + F.col("n1"))).alias("leaf_rows"),
            F.max(F.when(F.col("depth") == 0, F.col("n0"))).alias("root_negative"),
            (F.count_if(F.col("x").isNull() | (F.col("x") < 0)) == 0).alias("placed"),
        ).select(F.lit("None" if depth is None else str(depth)).alias("max_depth"), "*"))
    return R.union_by_name(*parts)


def _level_sql(d: int) -> str:
    """Best splits ``b{d}`` of the nodes of level d, and where they send the rows, ``p{d + 1}``."""
    return f"""
    n{d} AS MATERIALIZED (SELECT path, count(*) FILTER (code = 0) AS n0, count(*) FILTER (code = 1) AS n1 FROM p{d} GROUP BY path),
    v{d} AS (SELECT path, feature, value, count(*) FILTER (code = 0) AS m0, count(*) FILTER (code = 1) AS m1
             FROM p{d} JOIN val USING (doc_id) GROUP BY ALL),
    r{d} AS (SELECT path, feature, value, coalesce(lead(value) OVER w, 0) AS lower, sum(m0) OVER w AS r0, sum(m1) OVER w AS r1
             FROM v{d} WINDOW w AS (PARTITION BY path, feature ORDER BY value DESC)),
    c{d} AS (SELECT path, feature, (value + lower) / 2 AS threshold, (n0 - r0)::DOUBLE AS l0, (n1 - r1)::DOUBLE AS l1, r0::DOUBLE AS r0, r1::DOUBLE AS r1
             FROM r{d} JOIN n{d} USING (path) WHERE n0 + n1 > r0 + r1 AND n0 > 0 AND n1 > 0),
    s{d} AS (SELECT *, (l0 * l0 + l1 * l1) / (l0 + l1) + (r0 * r0 + r1 * r1) / (r0 + r1) AS score FROM c{d}),
    b{d} AS MATERIALIZED (SELECT path, feature, threshold FROM
             (SELECT *, row_number() OVER (PARTITION BY path ORDER BY score DESC, feature, threshold) AS k FROM s{d}) WHERE k = 1),
    p{d + 1} AS MATERIALIZED (SELECT p.doc_id, p.code, p.path || CASE WHEN coalesce(val.value, 0) <= b.threshold THEN 'L' ELSE 'R' END AS path
             FROM p{d} p JOIN b{d} b USING (path) LEFT JOIN val ON val.doc_id = p.doc_id AND val.feature = b.feature)"""


@query(f"""
    WITH art AS (SELECT doc_id, label_model AS label, {tokens_sql('content')} AS ts, {SPLIT_SQL} AS test FROM ({LABELLED_SQL})),
    tok AS (SELECT doc_id, unnest(list_filter(ts, lambda w: length(w) >= 2)) AS token FROM art),
    tc AS (SELECT doc_id, token, count(*) AS tf FROM tok GROUP BY 1, 2), nd AS (SELECT count(*) AS n FROM art),
    fr AS (SELECT token, count(*) AS df, sum(tf)::BIGINT AS total FROM tc GROUP BY 1),
    vocab AS (SELECT * FROM fr ORDER BY total DESC, token LIMIT 1000), {WEIGH},
    val AS MATERIALIZED (SELECT doc_id, token AS feature, round(weight, 9) AS value FROM wt WHERE round(weight, 9) > 0),
    p0 AS MATERIALIZED (SELECT doc_id, (label = 'positive')::INT AS code, '' AS path FROM art WHERE NOT test),
    {_level_sql(0)}, {_level_sql(1)},
    n2 AS (SELECT path, count(*) FILTER (code = 0) AS n0, count(*) FILTER (code = 1) AS n1 FROM p2 GROUP BY path)
    SELECT path, n0, n1, feature, round(threshold, 6) AS threshold FROM
    (SELECT n0.*, feature, threshold FROM n0 LEFT JOIN b0 USING (path) UNION ALL SELECT n1.*, feature, threshold FROM n1 LEFT JOIN b1 USING (path)
     UNION ALL SELECT *, NULL, NULL FROM n2)
""")
def ml15b_first_levels(spark, sf):
    """The first two levels of exact splits and the nodes below them, each level split by one plan."""
    nodes = TR.grow(TR.training_rows(_tree_data(spark, sf)), max_depth=2, local_entries=0)
    return nodes.select("path", "n0", "n1", "feature", r6("threshold").alias("threshold"))


# --- themes and summaries -------------------------------------------------------

WORDS_SQL = f"""
    lists AS (SELECT doc_id, lang, list_filter({tokens_sql()}, lambda w: w NOT IN {sql_in(STOP)}) AS ts FROM documents),
    occ AS (SELECT doc_id, lang, unnest(ts) AS token, unnest(range(len(ts))) AS pos FROM lists)
"""


@query(f"""
    WITH {WORDS_SQL}
    SELECT token, count(*) AS n FROM occ GROUP BY token ORDER BY n DESC, min(doc_id * 10000000000 + pos) LIMIT 5
""")
def ag12_top_words(spark, sf):
    return TH.top_words(_articles(spark, sf), "content", "doc_id", 5, STOP)


@query(f"""
    WITH lists AS (SELECT doc_id, list_distinct(string_split({clean_sql('text')}, ' ')) AS raw FROM documents),
    sorted AS (SELECT doc_id, list_sort(raw) AS ts FROM lists),
    occ AS (SELECT doc_id, unnest(ts) AS token, unnest(range(len(ts))) AS pos FROM sorted)
    SELECT token, count(*) AS n FROM occ GROUP BY token ORDER BY n DESC, min(doc_id * 10000000000 + pos) LIMIT 5
""")
def ag13_top_listed_words(spark, sf):
    """Each document's distinct words as its keyword list."""
    lists = _articles(spark, sf).select(
        "doc_id",
        F.array_join(F.sort_array(F.array_distinct(F.split("content", " "))), ", ").alias("keywords"),
    )
    return TH.top_listed_words(lists, "keywords", "doc_id", 5)


@query(f"""
    WITH {WORDS_SQL}, cnt AS (SELECT lang, token, count(*) AS n, min(doc_id * 10000000000 + pos) AS f FROM occ GROUP BY 1, 2)
    SELECT lang, token, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, f) AS r FROM cnt) WHERE r <= 7
""")
def tk03_most_common(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "lang", "text").withColumn("content", T.clean_words(F.col("text")))
    counts = TH.word_counts(docs, "content", "doc_id", groups=["lang"], stop_words=STOP)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("first_seen")))
    return counts.withColumn("r", rank).where("r <= 7").select("lang", "token", "n")


@query(f"""
    WITH {WORDS_SQL}, cnt AS (SELECT lang, token, count(*) AS n, min(doc_id * 10000000000 + pos) AS f FROM occ GROUP BY 1, 2)
    SELECT lang, token, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, f) AS r FROM cnt) WHERE r <= 7
""")
def tk03_frequent_words(spark, sf):
    """The most frequent words of each language, candidates from a sketch, counted exactly."""
    docs = texts(spark, sf, "documents", "doc_id", "lang", "text").withColumn("content", T.clean_words(F.col("text")))
    return TH.frequent_words(docs, "content", "doc_id", 7, groups=["lang"], stop_words=STOP).select("lang", "token", "n")


@query(f"""
    WITH lists AS (SELECT d.doc_id, e.label, list_filter({tokens_sql()}, lambda w: w NOT IN {sql_in(STOP)}) AS ts
                   FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id),
    occ AS (SELECT doc_id, label, unnest(ts) AS token, unnest(range(len(ts))) AS pos FROM lists),
    cnt AS (SELECT label, token, count(*) AS n, min(doc_id * 10000000000 + pos) AS f FROM occ GROUP BY 1, 2),
    rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, f) AS r FROM cnt)
    SELECT 'Cluster ' || (label + 1) AS cluster, string_agg(token, ', ' ORDER BY r) AS keywords FROM rk WHERE r <= 5 GROUP BY label
""")
def ml18_cluster_keywords(spark, sf):
    """Keywords of given clusters."""
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "label")
    return TH.cluster_keywords(
        _articles(spark, sf).join(vectors, "doc_id"), "content", "label", "doc_id", stop_words=STOP
    )


@query("SELECT vec_id, true AS nearest FROM embeddings")
def ml17_kmeans(spark, sf):
    """Every vector lies in the cluster whose centre is nearest."""
    clustered, model = TH.assign_clusters(table(spark, sf, "embeddings"), "embedding", 10)
    centres = F.array(*[
        F.struct(F.lit(i).alias("centre"), F.array(*[F.lit(float(x)) for x in c]).alias("place"))
        for i, c in enumerate(model.clusterCenters())
    ])
    away = lambda place: F.aggregate(
        F.zip_with("embedding", place, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, d: s + d
    )
    distances = F.transform(centres, lambda c: F.struct(away(c["place"]).alias("d"), c["centre"].alias("c")))
    own = F.array_min(F.transform(F.filter("distances", lambda d: d["c"] == F.col("cluster")), lambda d: d["d"]))
    return (
        clustered.select("vec_id", "cluster", distances.alias("distances"))
        .select("vec_id", (own <= F.array_min("distances")["d"] + 1e-6).alias("nearest"))
    )


@query(f"""
    WITH t AS (SELECT d.doc_id, {clean_sql('text')} AS content FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id)
    SELECT least(30, (SELECT count(DISTINCT content) FROM t))::BIGINT AS n_clusters, true AS five_words, true AS no_stop_word
""")
def ml18_themes(spark, sf):
    """Clusters of the texts that have vectors, and their keywords."""
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    found = TH.themes(
        _articles(spark, sf).join(vectors, "doc_id"), "content", "embedding", "doc_id", n_topics=30, stop_words=STOP
    )
    words = F.split("keywords", ", ")
    return found.agg(
        F.count_distinct("cluster").alias("n_clusters"),
        F.bool_and(F.size(F.array_distinct(words)).between(1, 5)).alias("five_words"),
        F.bool_and(~F.arrays_overlap(words, F.array(*[F.lit(w) for w in STOP]))).alias("no_stop_word"),
    )


@query("""
    SELECT conv_id, turn // 8 AS block, count(*) AS n_texts, string_agg(text, ' ' ORDER BY turn) AS content
    FROM conversations GROUP BY 1, 2
""")
def ag11_group_text(spark, sf):
    return SU.group_text(table(spark, sf, "conversations"), "conv_id", "turn", "text", rows_per_block=8)


BEGIN_SQL = """
    ws AS (SELECT source, doc_id, unnest(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS w,
                  unnest(range(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')))) AS pos FROM documents),
    rk AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, pos) AS r FROM ws),
    beg AS (SELECT source, string_agg(w, ' ' ORDER BY r) AS content FROM rk WHERE r <= 1024 GROUP BY source)
"""


@query(f"WITH {BEGIN_SQL} SELECT source, content FROM beg")
def ag11_group_beginning(spark, sf):
    return SU.group_beginning(texts(spark, sf, "documents", "source", "doc_id", "text"), "source", "doc_id", "text")


SUMMARY_SQL = f"""
    WITH {BEGIN_SQL},
    tok AS (SELECT source, unnest(regexp_extract_all(lower(content), '[\\p{{L}}\\p{{N}}_][\\p{{L}}\\p{{N}}_]+')) AS token FROM beg),
    tc AS (SELECT source, token, count(*) AS tf FROM tok GROUP BY 1, 2),
    fr AS (SELECT token, count(*) AS df FROM tc GROUP BY 1),
    rw AS (SELECT source, token, tf * (ln(((SELECT count(*) FROM beg) + 1) / (df + 1)) + 1) AS raw FROM tc JOIN fr USING (token)),
    wt AS (SELECT source, token, raw / sqrt(sum(raw * raw) OVER (PARTITION BY source)) AS weight FROM rw),
    sl AS (SELECT source, list_filter(list_transform(string_split(regexp_replace(content, '([.!?]) ', '\\1' || chr(1), 'g'), chr(1)),
                  lambda s: trim(s)), lambda s: s <> '') AS ss FROM beg),
    se AS (SELECT source, unnest(ss) AS sentence, unnest(range(len(ss))) AS pos FROM sl),
    st AS (SELECT source, pos, unnest(regexp_extract_all(lower(sentence), '[\\p{{L}}\\p{{N}}_][\\p{{L}}\\p{{N}}_]+')) AS token FROM se),
    sc AS (SELECT source, pos, round(avg(weight), 9) AS score FROM st JOIN wt USING (source, token) GROUP BY 1, 2),
    rk2 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY score DESC, pos) AS r FROM sc)
    SELECT source, string_agg(sentence, ' ' ORDER BY pos) AS summary FROM rk2 JOIN se USING (source, pos) WHERE r <= 3 GROUP BY source
"""


@query(SUMMARY_SQL)
def ml19_extractive_summary(spark, sf):
    beginnings = SU.group_beginning(texts(spark, sf, "documents", "source", "doc_id", "text"), "source", "doc_id", "text")
    return SU.extractive_summary(beginnings, "source")


def echo_generator():
    """Stand-in generator: the prefix and the text's length."""
    return lambda text: f"{text[:10]} {len(text)}"


@query(f"WITH {BEGIN_SQL} SELECT source, 'summarize: ' || (length(content) + 11) AS summary FROM beg")
def ml19_generated_summary(spark, sf):
    beginnings = SU.group_beginning(texts(spark, sf, "documents", "source", "doc_id", "text"), "source", "doc_id", "text")
    return SU.generated_summary(beginnings, "source", echo_generator)


# --- sinks: written to the shared folder and read back ---------------------------


@query("""
    SELECT 'news_articles_' || replace(trim(replace(k, 'AND', ' ')), ' ', '_') AS topic_slug, k AS search_keyword, text AS content
    FROM (SELECT source || ' AND' AS k, text FROM documents)
""")
def src04_topics_json(spark, sf):
    path = f"{_folder(spark)}/json"
    tagged = table(spark, sf, "documents").select(
        F.col("text").alias("content"), F.concat("source", F.lit(" AND")).alias("search_keyword")
    )
    writers.write_topics_json(tagged, path)
    return spark.read.schema("content string, search_keyword string, topic_slug string").json(path)


@query("SELECT doc_id, text, lang, source FROM documents")
def src06_records_to_table(spark, sf):
    """Records written as JSON lines and read with an explicit layout."""
    path = f"{_folder(spark)}/records"
    table(spark, sf, "documents").select("doc_id", "text", "lang", "source").write.json(path)
    return readers.read_articles_json(
        spark, path, "doc_id long, text string, lang string, source string"
    )


@query("SELECT DISTINCT doc_id, quality, toxic FROM labels")
def src07_combined_files(spark, sf):
    return readers.read_combined(spark, sf, "labels.parquet")


@query("SELECT doc_id, lang, n_chars FROM documents")
def src10_write_table(spark, sf):
    path = f"{_folder(spark)}/table"
    writers.write_table(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), path)
    return readers.read_table(spark, path)


@query("SELECT doc_id, source, lang FROM documents")
def src11_write_by_value(spark, sf):
    path = f"{_folder(spark)}/by_lang"
    writers.write_by_value(table(spark, sf, "documents").select("doc_id", "source", "lang"), path, "lang")
    return readers.read_partitioned(spark, path).select("doc_id", "source", "lang")


@query("SELECT 'pressgrain_tmp_labels' AS name, count(*) AS n FROM labels")
def src12_save_prefixed(spark, sf):
    folder = _folder(spark)
    table(spark, sf, "labels").createOrReplaceTempView("pressgrain_tmp_labels")
    names = writers.save_prefixed_tables(spark, "pressgrain_tmp_", folder)
    saved = [readers.load_report(spark.read.parquet(f"{folder}/{n}"), n) for n in names]
    return R.union_by_name(*saved).toDF("name", "n")


FILES_SQL = "SELECT DISTINCT 'df_' || lang || '_' || source || '_combined.xlsx' AS file_name, lower(lang) AS a, lower(source) AS b FROM documents"


@query(f"""
    SELECT file_name, min(folder) AS folder FROM ({FILES_SQL}) f
    JOIN (SELECT DISTINCT 'news_articles_' || upper(source) || '_' || lang AS folder FROM documents) d
      ON contains(lower(folder), a) AND contains(lower(folder), b) GROUP BY file_name
""")
def src13_route_outputs(spark, sf):
    docs = table(spark, sf, "documents")
    files = docs.select(F.concat(F.lit("df_"), "lang", F.lit("_"), "source", F.lit("_combined.xlsx")).alias("file_name"))
    folders = docs.select(
        F.concat(F.lit("news_articles_"), F.upper("source"), F.lit("_"), "lang").alias("folder")
    )
    return writers.route_outputs(files.distinct(), folders.distinct())


@query(f"""
    WITH {nb_sql(LABELLED_ROWS, 1.0)}
    SELECT doc_id, label AS label_model, prediction AS predicted_sentiment_multinomialnb FROM art JOIN pred USING (doc_id)
""")
def src14_saved_model(spark, sf):
    """Predictions of a model that was saved and loaded again."""
    trained = NB.train(
        _labelled_articles(spark, sf), "content", "label_model", "doc_id", grid_search=False, stop_words=STOP
    )
    path = f"{_folder(spark)}/model"
    NB.save_model(trained.model, path)
    return NB.add_prediction(
        _labelled_articles(spark, sf), "content", NB.load_model(spark, path), stop_words=STOP
    ).drop("content")


@query(f"WITH {BEGIN_SQL} SELECT source, 'summarize: ' || (length(content) + 11) AS summary FROM beg")
def src15_write_summaries(spark, sf):
    path = f"{_folder(spark)}/summaries"
    writers.write_summaries(ml19_generated_summary(spark, sf), path, "source")
    return spark.read.schema("value string, source string").text(path).select("source", F.col("value").alias("summary"))


@query("SELECT 'df_' || lang AS view_name, count(*) AS n FROM documents GROUP BY 1")
def ml20_views_by_value(spark, sf):
    """Each language's documents through one table function over the value."""
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    name = writers.publish_by_value(docs, "lang", f"df_{uuid.uuid4().hex[:8]}")
    langs = docs.select(F.col("lang").alias("wanted")).distinct()
    return spark.sql(
        f"SELECT concat('df_', wanted) AS view_name, count(*) AS n FROM {{langs}}, LATERAL {name}(wanted) d GROUP BY wanted",
        langs=langs,
    )


@query("SELECT 'df_' || lang AS view_name, count(*) AS n FROM documents WHERE lang IN ('de', 'en', 'xx') GROUP BY 1 UNION ALL SELECT 'df_xx', 0")
def ml20_named_views(spark, sf):
    names = writers.publish_views(table(spark, sf, "documents").select("doc_id", "lang"), "lang", ["en", "de", "xx"])
    counts = [
        spark.table(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("view_name"), "n") for n in names
    ]
    return R.union_by_name(*counts)


@query("SELECT true AS bounded, count(*) AS n_rows, count(DISTINCT lang) AS n_lang FROM documents")
def src11_files_by_value(spark, sf):
    """However many tasks write, there are about as many files as values."""
    path = f"{_folder(spark)}/by_lang"
    docs = table(spark, sf, "documents").select("doc_id", "lang").repartition(16)
    writers.write_by_value(docs, path, "lang")
    written = readers.read_partitioned(spark, path).withColumn("file", F.input_file_name())
    return written.agg(
        F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("lang").alias("n_lang")
    ).select((F.col("files") <= 2 * F.col("n_lang")).alias("bounded"), "n_rows", "n_lang")


@query("SELECT DISTINCT text, lang FROM documents")
def st02_growing_corpus(spark, sf):
    """Overlapping batches appended to one table, one of them twice."""
    path = f"{_folder(spark)}/grown"
    docs = table(spark, sf, "documents").select("text", "lang", "source")
    for batch, kept in (("first", "lang <> 'de'"), ("second", "lang <> 'en'"), ("third", "true"), ("second", "lang <> 'en'")):
        growing.append_new(docs.where(kept).select("text", "lang"), path, batch)
    return growing.read_grown(spark, path)
