"""Matching, sentiment, reports and model inference."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pressgrain.functions.lexicon import BOOST, Rules
from pressgrain.functions.text import clean_words
from pressgrain.operators import (
    evaluation as E,
    inference as I,
    lookups as L,
    matching as M,
    report as B,
    sentiment as S,
)
from pressgrain.operators.rows import keep_agreeing
from registry.base import (
    LABELLED_SQL,
    class_report_sql,
    clean_sql,
    labelled,
    query,
    r6,
    sql_in,
    sql_values,
    table,
    texts,
)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

REACH = [
    ("src0", 2.3), ("src1", 8.8), ("src2", 19.3), ("src4", 4.6), ("src7", 1.7),
    ("src8", 62.2), ("src11", 20.0), ("src13", 2.0), ("src17", 24.4),
]
REACH_SQL = sql_values(REACH, "publisher", "followers")
INFLUENCE_SQL = (
    f"SELECT publisher, followers / (SELECT sum(followers) FROM {REACH_SQL} r2) AS influence_score "
    f"FROM {REACH_SQL} r1"
)
COUNTS_SQL = f"""
    SELECT publisher, label_model AS label, count(*) AS n FROM ({LABELLED_SQL})
    WHERE label_model = label_lex GROUP BY 1, 2
"""
SHARES_SQL = f"""
    SELECT publisher, label, n, sum(n) OVER (PARTITION BY publisher) AS publisher_total,
           n / sum(n) OVER (PARTITION BY publisher) * 100 AS traditional_percentage
    FROM ({COUNTS_SQL})
"""
WEIGHTED_SQL = f"""
    SELECT s.*, i.influence_score,
           traditional_percentage * i.influence_score AS weighted_percentage_with_influence
    FROM ({SHARES_SQL}) s LEFT JOIN ({INFLUENCE_SQL}) i ON s.publisher = i.publisher
"""
REPORT_SQL = "SELECT publisher, " + ", ".join(
    f"round(coalesce(avg({m}) FILTER (label = '{c}'), 0), 6) AS {m}_{c}"
    for m in ("traditional_percentage", "weighted_percentage_with_influence")
    for c in ("negative", "positive")
) + f" FROM ({WEIGHTED_SQL}) GROUP BY publisher"


def _reach(spark):
    return B.reach_table(spark, dict(REACH))


def _agreeing(spark, sf):
    rows = labelled(spark, sf, "publisher", "label_model", "label_lex")
    return keep_agreeing(rows, "label_model", "label_lex")


def _counts(spark, sf):
    return B.category_counts(_agreeing(spark, sf), "publisher", "label_model")


@query("""
    SELECT publisher, round(followers / sum(followers) OVER (), 6) AS influence_score
    FROM (SELECT event_type AS publisher, count(DISTINCT user_id) AS followers FROM events GROUP BY 1)
""")
def ag06_influence_scores(spark, sf):
    """Audience share, the audience being the distinct users of each kind of event."""
    reach = (
        table(spark, sf, "events").groupBy(F.col("event_type").alias("publisher"))
        .agg(F.count_distinct("user_id").alias("followers"))
    )
    return B.influence_scores(reach).select("publisher", r6("influence_score").alias("influence_score"))


@query(COUNTS_SQL)
def ag01_category_counts(spark, sf):
    return _counts(spark, sf)


@query(SHARES_SQL.replace("n / sum(n) OVER (PARTITION BY publisher) * 100", "round(n / sum(n) OVER (PARTITION BY publisher) * 100, 6)").replace("sum(n) OVER (PARTITION BY publisher) AS publisher_total", "(sum(n) OVER (PARTITION BY publisher))::BIGINT AS publisher_total"))
def ag02_category_shares(spark, sf):
    shares = B.category_shares(_counts(spark, sf))
    return shares.withColumn("traditional_percentage", r6("traditional_percentage"))


@query("""
    SELECT event_type, user_id, n, (sum(n) OVER (PARTITION BY event_type))::BIGINT AS group_total
    FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2)
""")
def wn01_group_total(spark, sf):
    from pyspark.sql import Window

    counts = table(spark, sf, "events").groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("group_total", F.sum("n").over(Window.partitionBy("event_type")))


@query(f"""
    SELECT publisher, label, round(traditional_percentage, 6) AS traditional_percentage,
           round(influence_score, 6) AS influence_score,
           round(weighted_percentage_with_influence, 6) AS weighted_percentage_with_influence
    FROM ({WEIGHTED_SQL})
""")
def ag04_weighted_shares(spark, sf):
    weighted = B.weighted_shares(B.category_shares(_counts(spark, sf)), _reach(spark))
    measures = ["traditional_percentage", "influence_score", "weighted_percentage_with_influence"]
    return weighted.select("publisher", "label", *[r6(m).alias(m) for m in measures])


def _rounded_report(report):
    return report.select("publisher", *[r6(c).alias(c) for c in report.columns if c != "publisher"])


@query(REPORT_SQL)
def ag03_pivot_shares(spark, sf):
    weighted = B.weighted_shares(B.category_shares(_counts(spark, sf)), _reach(spark))
    return _rounded_report(B.pivot_shares(weighted))


@query(REPORT_SQL)
def ag05_bias_report(spark, sf):
    report = B.bias_and_impact(_agreeing(spark, sf), _reach(spark), label="label_model")
    return _rounded_report(report)


@query(REPORT_SQL)
def prj14_flat_headers(spark, sf):
    """All measure and category headers as one level of names."""
    weighted = B.weighted_shares(B.category_shares(_counts(spark, sf)), _reach(spark))
    flat = B.pivot_shares(weighted)
    return flat.select(
        "publisher",
        *[
            r6(f"{m}_{c}").alias(f"{m}_{c}")
            for m in ("traditional_percentage", "weighted_percentage_with_influence")
            for c in ("negative", "positive")
        ],
    )


@query(f"""
    SELECT d.doc_id, d.source AS publisher, r.followers FROM documents d
    LEFT JOIN {REACH_SQL} r ON d.source = r.publisher
""")
def jn02_audience_weights(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("source").alias("publisher"))
    return L.attach(docs, _reach(spark), "publisher").select("doc_id", "publisher", "followers")


CONFUSION_SQL = f"""
    SELECT label_model AS label, count(*) FILTER (label_lex = 'negative') AS predicted_negative,
           count(*) FILTER (label_lex = 'positive') AS predicted_positive
    FROM ({LABELLED_SQL}) GROUP BY 1
"""


@query(CONFUSION_SQL)
def ag15_confusion_matrix(spark, sf):
    rows = labelled(spark, sf, "label_model", "label_lex")
    return E.confusion_matrix(rows, ["positive", "negative"], "label_model", "label_lex")


@query(f"""
    SELECT l.lang AS label,
           count(*) FILTER (d.lang = l.lang AND d.source = 'src0') AS predicted_de, 0::BIGINT AS predicted_en,
           0::BIGINT AS predicted_es, count(*) FILTER (d.lang = l.lang AND d.source <> 'src0') AS predicted_fr
    FROM (SELECT unnest(['de', 'en', 'es', 'fr']) AS lang) l, (SELECT * FROM documents WHERE lang <> 'en') d GROUP BY 1
""")
def ag15_labels_without_rows(spark, sf):
    """A label that is never true and two that are never predicted keep their row and columns."""
    docs = table(spark, sf, "documents").where("lang <> 'en'")
    guess = F.when(F.col("source") == "src0", "de").otherwise("fr")
    return E.confusion_matrix(docs.withColumn("guess", guess), ["fr", "en", "de", "es"], "lang", "guess")


@query(f"WITH {class_report_sql(f'SELECT label_model AS l, label_lex AS p FROM ({LABELLED_SQL})')}")
def ag14_classification_report(spark, sf):
    report = E.classification_report(labelled(spark, sf, "label_model", "label_lex"), "label_model", "label_lex")
    return report.select("class", *[r6(m).alias(m) for m in ("precision", "recall", "f1")], "support")


# --- matching ---------------------------------------------------------------

# Entries cover exact, partial and repeated words; products with neither word
# fall back to the first entry.
STANCES = {
    "Hot Plate Daily": "Mainstream",
    "The Cold Ring": "Progressive",
    "Small Widget News": "Conservative",
    "Red Gizmo": "Agnostic",
    "Ring Ring Weekly": "MAGA",
    "Plate": "Progressive",
    "Old Bolt and Small Bolt": "Conservative",
}
STANCES_SQL = sql_values([(i, k, v) for i, (k, v) in enumerate(STANCES.items())], "pos", "entry", "stance")
MATCH_STOP = ["the", "and"]


def _tokens_sql(column: str, stop=()) -> str:
    keep = f" AND t NOT IN {sql_in(stop)}" if stop else ""
    return f"list_filter(regexp_extract_all(lower({column}), '\\w\\w+'), lambda t: true{keep})"


def match_sql(names: str, entries: str, stop=()) -> str:
    """All pairs of (name, copies) and (pos, entry), scored by brute force."""
    return f"""
        nm AS ({names}), ct AS ({entries}),
        lt AS (SELECT name, any_value(copies) AS copies, token, count(*) AS tf FROM
               (SELECT name, copies, unnest({_tokens_sql('name', stop)}) AS token FROM nm) GROUP BY name, token),
        rt AS (SELECT pos, token, count(*) AS tf FROM
               (SELECT pos, unnest({_tokens_sql('entry', stop)}) AS token FROM ct) GROUP BY pos, token),
        fr AS (SELECT token, sum(n) AS df FROM (SELECT token, copies AS n FROM lt UNION ALL SELECT token, 1 FROM rt) GROUP BY token),
        nn AS (SELECT (SELECT sum(copies) FROM nm) + (SELECT count(*) FROM ct) AS n),
        idf AS (SELECT token, ln((n + 1) / (df + 1)) + 1 AS idf FROM fr, nn),
        lw AS (SELECT name, token, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY name)) AS w FROM lt JOIN idf USING (token)),
        rw AS (SELECT pos, token, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY pos)) AS w FROM rt JOIN idf USING (token)),
        sc AS (SELECT nm.name, ct.pos, round(coalesce((SELECT sum(lw.w * rw.w) FROM lw JOIN rw USING (token)
                      WHERE lw.name = nm.name AND rw.pos = ct.pos), 0), 9) AS similarity FROM nm, ct),
        best AS (SELECT name, pos, similarity FROM
                 (SELECT *, row_number() OVER (PARTITION BY name ORDER BY similarity DESC, pos) AS r FROM sc) WHERE r = 1)
    """


@query(f"""
    WITH {match_sql("SELECT p_name AS name, count(*) AS copies FROM part GROUP BY 1", f"SELECT pos, entry FROM {STANCES_SQL}", MATCH_STOP)}
    SELECT p.p_partkey, p.p_name AS publisher, s.stance AS editorial_stance
    FROM part p JOIN best ON best.name = p.p_name JOIN {STANCES_SQL} s ON s.pos = best.pos
""")
def jn04_map_stance(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("publisher"))
    return M.map_stance(parts, M.stance_table(spark, STANCES), stop_words=MATCH_STOP)


@query(f"""
    WITH {match_sql("SELECT p_name AS name, count(*) AS copies FROM part GROUP BY 1", f"SELECT pos, entry FROM {STANCES_SQL}", MATCH_STOP)}
    SELECT name AS publisher, CASE WHEN similarity >= 0.6 THEN stance END AS editorial_stance,
           round(similarity, 6) AS similarity
    FROM best JOIN {STANCES_SQL} s USING (pos)
""")
def jn04_stance_threshold(spark, sf):
    parts = table(spark, sf, "part").select(F.col("p_name").alias("publisher"))
    found = M.stance_by_publisher(
        parts, M.stance_table(spark, STANCES), fallback="null", stop_words=MATCH_STOP
    )
    return found.withColumn("similarity", r6("similarity"))


# those of the English stop words that occur in the names below
ENGLISH_STOP = ["the", "of", "who", "was", "it", "and"]
STOP_PUBLISHERS = ["The Sun", "Plate of the Day", "Who was it", "Red and Small", "Cold Call"]
STOP_PUBLISHER_SQL = f"{STOP_PUBLISHERS!r}[1 + p_partkey % {len(STOP_PUBLISHERS)}]"


@query(f"""
    WITH {match_sql(f"SELECT {STOP_PUBLISHER_SQL} AS name, count(*) AS copies FROM part GROUP BY 1", f"SELECT pos, entry FROM {STANCES_SQL}", ENGLISH_STOP)}
    SELECT p_partkey, name AS publisher, stance AS editorial_stance
    FROM part JOIN best ON best.name = {STOP_PUBLISHER_SQL} JOIN {STANCES_SQL} s USING (pos)
""")
def jn04_map_stance_default(spark, sf):
    """With the default stop words, some names share nothing with any entry."""
    names = F.array(*[F.lit(n) for n in STOP_PUBLISHERS])
    publisher = F.get(names, (F.col("p_partkey") % len(STOP_PUBLISHERS)).cast("int"))
    parts = table(spark, sf, "part").select("p_partkey", publisher.alias("publisher"))
    return M.map_stance(parts, M.stance_table(spark, STANCES))


OUTLETS_SQL = "SELECT name, count(*) AS copies FROM (SELECT DISTINCT p_name || ' ' || lower(p_brand) AS name FROM part) GROUP BY 1"
CATALOGUE_SQL = "SELECT min(p_partkey) AS pos, p_name || ' ' || p_type AS entry FROM part GROUP BY 2"


def _outlets(spark, sf):
    parts = table(spark, sf, "part")
    outlets = parts.select(F.concat_ws(" ", "p_name", F.lower("p_brand")).alias("outlet")).distinct()
    catalogue = (
        parts.groupBy(F.concat_ws(" ", "p_name", "p_type").alias("name"))
        .agg(F.min("p_partkey").alias("pos"))
        .select("pos", "name", F.replace(F.lower("name"), F.lit(" "), F.lit("-")).alias("id"))
    )
    return outlets, catalogue


@query(f"""
    WITH {match_sql(OUTLETS_SQL, CATALOGUE_SQL)}
    SELECT name AS outlet, replace(lower(entry), ' ', '-') AS id, round(similarity, 6) AS similarity
    FROM best JOIN ct USING (pos) WHERE similarity >= 0.5
""")
def jn03_match_outlets(spark, sf):
    outlets, catalogue = _outlets(spark, sf)
    return M.match_outlets(outlets, catalogue, 0.50).withColumn("similarity", r6("similarity"))


@query(f"""
    WITH {match_sql(OUTLETS_SQL, CATALOGUE_SQL)}
    SELECT name, pos, round(similarity, 6) AS similarity FROM best WHERE similarity > 0
""")
def tk01_best_match(spark, sf):
    outlets, catalogue = _outlets(spark, sf)
    names = outlets.select(F.col("outlet").alias("name"), F.lit(1).cast("long").alias("copies"))
    left, right = M.name_vectors(names, catalogue.select("pos", F.col("name").alias("entry")))
    return M.best_matches(left, right).withColumn("similarity", r6("similarity"))


# --- lexicon ----------------------------------------------------------------

# The tables' words are invented; these lists give some of them the roles that
# the rules know.
LEXICON = {
    "worthless": -1.9, "best": 3.2, "thing": 1.1, "license": 0.6, "ing": 0.8, "ble": -1.2,
    "tion": 0.9, "ther": -0.7, "orre": 1.4, "ononst": -2.1, "inoran": 2.0, "hehely": 1.7,
    "rewh": -1.3, "thatin": 0.4, "orantion": -0.9, "und": 0.3, "les": 0.2, "que": -0.4,
    "para": 0.5, "del": -0.6, "than": 0.7, "thre": -1.1, "eaux": 1.2, "ier": -0.8,
}
RULES = Rules(
    boosters={"for": BOOST, "with": BOOST, "par": BOOST, "are": -BOOST, "from": -BOOST, "the thon": -BOOST},
    negations=frozenset(["this", "was", "nicht", "pas", "on"]),
    idioms={"the thing": 2.5, "thing of the": -1.5, "of the": 1.0, "and the ing": -2.0},
    contrast="that",
    kind="ing",
    least="than",
)
LEXICON_SQL = sql_values(list(LEXICON.items()), "token", "valence")


def vader_sql(source: str, rules: Rules = RULES) -> str:
    """Row-by-row form of the rules over (id, text)."""
    boost = sql_values(list(rules.boosters.items()), "phrase", "boost")
    idiom = sql_values(list(rules.idioms.items()), "phrase", "value")
    negs = sql_in(sorted(rules.negations))

    punct = r"""(?:\.|,|;|:|-|''|"|!\?!\?|\?!\?!|\?!\?|!\?!|!!!|!!|!|\?\?\?|\?\?|\?)"""
    plain = r"([^!-/:-@\[-`{-~]{2,})"
    strip = (
        f"regexp_replace(regexp_replace(w, '^{punct}{plain}$', '\\1'), '^{plain}{punct}$', '\\1')"
    )
    shout = lambda x: f"({x} = upper({x}) AND {x} <> lower({x}))"

    def neg(n):
        return f"(l{n} IN {negs} OR contains(l{n}, 'n''t'))"

    def boosted(value, n, fade):
        return f"""CASE WHEN b{n} IS NULL THEN {value} ELSE {value} + ((CASE WHEN {value} < 0 THEN -b{n} ELSE b{n} END)
            + CASE WHEN {shout(f'w{n}')} AND mixed THEN CASE WHEN {value} > 0 THEN 0.733 ELSE -0.733 END ELSE 0 END) * {fade} END"""

    def find(expr, what, tab):
        return f"(SELECT {what} FROM {tab} q WHERE q.phrase = {expr})"

    return f"""
    src AS ({source}),
    parts AS (SELECT id, list_transform(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: length(w) > 1),
                                        lambda w: {strip}) AS ws, text FROM src),
    flags AS (SELECT id, ws, text, list_transform(ws, lambda w: lower(w)) AS ls,
                     len(list_filter(ws, lambda w: {shout('w')})) AS caps FROM parts),
    doc AS (SELECT *, caps > 0 AND caps < len(ws) AS mixed, coalesce(list_position(ls, '{rules.contrast}'), 0) AS turn FROM flags),
    tok AS (SELECT id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM doc),
    fst AS (SELECT id, w, min(i) AS p FROM tok GROUP BY id, w),
    hit AS (SELECT fst.id, fst.w, p, lx.valence, ws, ls, mixed,
                   CASE WHEN p > 1 THEN ws[p-1] END AS w1, CASE WHEN p > 2 THEN ws[p-2] END AS w2, CASE WHEN p > 3 THEN ws[p-3] END AS w3
            FROM fst JOIN {LEXICON_SQL} lx ON lx.token = lower(fst.w) JOIN doc ON doc.id = fst.id),
    ctx AS (SELECT h.*, lower(w1) AS l1, lower(w2) AS l2, lower(w3) AS l3,
                   b1.boost AS b1, b2.boost AS b2, b3.boost AS b3,
                   x1.valence AS x1, x2.valence AS x2, x3.valence AS x3
            FROM hit h LEFT JOIN {boost} b1 ON b1.phrase = lower(h.w1) LEFT JOIN {boost} b2 ON b2.phrase = lower(h.w2)
                 LEFT JOIN {boost} b3 ON b3.phrase = lower(h.w3)
                 LEFT JOIN {LEXICON_SQL} x1 ON x1.token = lower(h.w1) LEFT JOIN {LEXICON_SQL} x2 ON x2.token = lower(h.w2)
                 LEFT JOIN {LEXICON_SQL} x3 ON x3.token = lower(h.w3)),
    s0 AS (SELECT *, CASE WHEN {shout('w')} AND mixed THEN CASE WHEN valence > 0 THEN valence + 0.733 ELSE valence - 0.733 END ELSE valence END AS v0 FROM ctx),
    s1a AS (SELECT *, {boosted('v0', 1, '1')} AS t1 FROM s0),
    s1 AS (SELECT *, CASE WHEN p > 1 AND x1 IS NULL THEN CASE WHEN {neg(1)} THEN t1 * -0.74 ELSE t1 END ELSE v0 END AS v1 FROM s1a),
    s2a AS (SELECT *, {boosted('v1', 2, '0.95')} AS t2 FROM s1),
    s2 AS (SELECT *, CASE WHEN p > 2 AND x2 IS NULL THEN CASE WHEN w2 = 'never' AND w1 IN ('so', 'this') THEN t2 * 1.5
                 WHEN {neg(2)} THEN t2 * -0.74 ELSE t2 END ELSE v1 END AS v2 FROM s2a),
    s3a AS (SELECT *, {boosted('v2', 3, '0.9')} AS t3 FROM s2),
    s3b AS (SELECT *, CASE WHEN (w3 = 'never' AND w2 IN ('so', 'this')) OR w1 IN ('so', 'this') THEN t3 * 1.25
                 WHEN {neg(3)} THEN t3 * -0.74 ELSE t3 END AS u3 FROM s3a),
    s3c AS (SELECT *, coalesce({find("w1 || ' ' || w", 'value', idiom)}, {find("w2 || ' ' || w1 || ' ' || w", 'value', idiom)},
                 {find("w2 || ' ' || w1", 'value', idiom)}, {find("w3 || ' ' || w2 || ' ' || w1", 'value', idiom)},
                 {find("w3 || ' ' || w2", 'value', idiom)}, u3) AS i3 FROM s3b),
    s3d AS (SELECT *, coalesce(CASE WHEN len(ws) > p + 1 THEN {find("ws[p] || ' ' || ws[p+1] || ' ' || ws[p+2]", 'value', idiom)} END,
                 CASE WHEN len(ws) > p THEN {find("ws[p] || ' ' || ws[p+1]", 'value', idiom)} END, i3) AS j3 FROM s3c),
    s3 AS (SELECT *, CASE WHEN p > 3 AND x3 IS NULL THEN
                 j3 - CASE WHEN {find("w3 || ' ' || w2", 'boost', boost)} IS NOT NULL OR {find("w2 || ' ' || w1", 'boost', boost)} IS NOT NULL THEN 0.293 ELSE 0 END
                 ELSE v2 END AS v3 FROM s3d),
    s4 AS (SELECT id, w, CASE WHEN lower(w) = '{rules.kind}' AND ls[p+1] = 'of' THEN 0
                 WHEN lower(w) IN {sql_in(sorted(rules.boosters))} THEN 0
                 WHEN l1 = '{rules.least}' AND x1 IS NULL AND NOT (p > 2 AND l2 IN ('at', 'very')) THEN v3 * -0.74 ELSE v3 END AS v FROM s3),
    sent AS (SELECT t.id, coalesce(s4.v, 0) * CASE WHEN d.turn = 0 OR t.i = d.turn THEN 1 WHEN t.i < d.turn THEN 0.5 ELSE 1.5 END AS s
             FROM tok t JOIN doc d ON d.id = t.id LEFT JOIN s4 ON s4.id = t.id AND s4.w = t.w),
    agg AS (SELECT id, sum(s) AS total, sum(CASE WHEN s > 0 THEN s + 1 ELSE 0 END) AS pos,
                   sum(CASE WHEN s < 0 THEN 1 - s ELSE 0 END) AS neg, sum(CASE WHEN s = 0 THEN 1 ELSE 0 END) AS neu FROM sent GROUP BY id),
    emph AS (SELECT id, least(length(text) - length(replace(text, '!', '')), 4) * 0.292
                   + CASE WHEN length(text) - length(replace(text, '?', '')) <= 1 THEN 0
                          WHEN length(text) - length(replace(text, '?', '')) <= 3 THEN (length(text) - length(replace(text, '?', ''))) * 0.18
                          ELSE 0.96 END AS e FROM src),
    fin AS (SELECT emph.id, coalesce(total, 0) + sign(coalesce(total, 0)) * e AS t,
                   coalesce(pos, 0) + CASE WHEN pos > neg THEN e ELSE 0 END AS p, coalesce(neg, 0) + CASE WHEN pos < neg THEN e ELSE 0 END AS n,
                   coalesce(neu, 0) AS u FROM emph LEFT JOIN agg ON agg.id = emph.id),
    scored AS (SELECT id, round(coalesce(n / nullif(p + n + u, 0), 0), 3) AS neg, round(coalesce(u / nullif(p + n + u, 0), 0), 3) AS neu,
                      round(coalesce(p / nullif(p + n + u, 0), 0), 3) AS pos, round(t / sqrt(t * t + 15), 4) AS compound FROM fin)
    """


SCORED_COLUMNS = """
    SELECT id AS doc_id, neg, neu, pos, compound + 0.0 AS emotion_intensity_vader,
           CASE WHEN compound > 0 THEN 'positive' ELSE 'negative' END AS overall_emotion_vader FROM scored
"""


def _flat_scores(scored):
    return scored.select(
        "doc_id",
        *[F.col(f"emotion_tone_scores_vader.{c}").alias(c) for c in ("neg", "neu", "pos")],
        (F.col("emotion_intensity_vader") + F.lit(0.0)).alias("emotion_intensity_vader"),
        "overall_emotion_vader",
    )


@query(f"WITH {vader_sql('SELECT doc_id AS id, text FROM documents')} {SCORED_COLUMNS}")
def ml13_lexicon_scores(spark, sf):
    return _flat_scores(S.score_lexicon(texts(spark, sf, "documents", "doc_id", "text"), "text", LEXICON, RULES))


@query(f"WITH {vader_sql('SELECT doc_id AS id, ' + clean_sql('text') + ' AS text FROM documents')} {SCORED_COLUMNS}")
def ml13_lexicon_scores_cleaned(spark, sf):
    """On cleaned text, with the lexicon read from a table."""
    docs = texts(spark, sf, "documents", "doc_id", "text").select("doc_id", clean_words(F.col("text")).alias("content"))
    lexicon = L.lookup_table(spark, list(LEXICON.items()), "token string, valence double")
    return _flat_scores(S.score_lexicon(docs, "content", lexicon, RULES))


@query(f"""
    SELECT doc_id, token, count(*) AS n, any_value(valence) AS valence FROM (
        SELECT doc_id, unnest(string_split(lower({clean_sql('text')}), ' ')) AS token FROM documents
    ) JOIN {LEXICON_SQL} USING (token) GROUP BY doc_id, token
""")
def jn06_token_valences(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "text").select("doc_id", clean_words(F.col("text")).alias("content"))
    lexicon = L.lookup_table(spark, list(LEXICON.items()), "token string, valence double")
    found = S.token_valences(docs, "doc_id", F.col("content"), lexicon)
    return found.withColumn("n", F.col("n").cast("long"))


# --- model inference --------------------------------------------------------


def letter_predictor():
    """Stand-in classifier: share of vowels against consonants in the text."""

    def predict(texts):
        rows = []
        for text in texts:
            vowels = sum(text.count(v) for v in "aeiou")
            p = vowels / (vowels + text.count("t") + text.count("n") + text.count("h") + 1)
            rows.append((1.0 - p, p))
        return np.array(rows)

    return predict


def _count_sql(text: str, letter: str) -> str:
    return f"(length({text}) - length(replace({text}, '{letter}', '')))"


FIRST_256_SQL = "array_to_string(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')[1:256], ' ')"
VOWELS_SQL = " + ".join(_count_sql("t", v) for v in "aeiou")
MODEL_SQL = f"""
    SELECT doc_id, round(2 * p - 1, 6) AS sentiment_score_bert,
           CASE WHEN 2 * p - 1 > 0 THEN 'positive' ELSE 'negative' END AS sentiment_category_bert
    FROM (SELECT doc_id, ({VOWELS_SQL}) / (({VOWELS_SQL}) + {_count_sql('t', 't')} + {_count_sql('t', 'n')} + {_count_sql('t', 'h')} + 1) AS p
          FROM (SELECT doc_id, {FIRST_256_SQL} AS t FROM documents))
"""


@query(MODEL_SQL)
def ml14_model_scores(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "text")
    scored = I.score_model(docs, "text", letter_predictor)
    return scored.select("doc_id", r6("sentiment_score_bert").alias("sentiment_score_bert"), "sentiment_category_bert")


def letter_embedder():
    """Stand-in encoder: shares of five letters."""

    def encode(texts):
        return np.array(
            [[t.count(c) / max(len(t), 1) for c in "aeiou"] for t in texts], dtype=np.float32
        )

    return encode


@query("""
    SELECT doc_id, unnest(range(5)) AS i, unnest([round(a, 4), round(e, 4), round(f, 4), round(o, 4), round(u, 4)]) AS x FROM (
        SELECT doc_id, """ + ", ".join(
    f"({_count_sql('t', c)} / greatest(length(t), 1))::FLOAT::DOUBLE AS {n}" for c, n in zip("aeiou", "aefou")
) + """ FROM (SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')[1:512], ' ') AS t FROM documents))
""")
def ml16_embeddings(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "text")
    vectors = I.embed(docs, "text", letter_embedder)
    return vectors.select("doc_id", F.posexplode("embedding").alias("i", "x")).select(
        "doc_id", F.col("i").cast("long").alias("i"), F.round(F.col("x").cast("double"), 4).alias("x")
    )


@query("""
    SELECT label, i, round(avg(x), 6) AS x FROM (
        SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(len(embedding))) AS i FROM embeddings)
    GROUP BY label, i
""")
def ag18_mean_pool(spark, sf):
    """Vectors of one label pooled as the token vectors of one text."""
    vectors = table(spark, sf, "embeddings").select("label", F.col("embedding").cast("array<double>").alias("v"))
    pooled = I.mean_pool(vectors, "label", "v")
    return pooled.select("label", F.posexplode("embedding").alias("i", "x")).select(
        "label", F.col("i").cast("long").alias("i"), r6("x").alias("x")
    )
