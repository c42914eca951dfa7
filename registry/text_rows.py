"""Sources, projections, filters, sets and column tidying."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressgrain.functions import text as T
from pressgrain.operators import columns as C, lookups as L, pages as P, rows as R, themes as TH
from pressgrain.sources import readers
from pressgrain.sources.stored import stored
from registry.base import (
    LABELLED_SQL,
    PUBLISHER_SQL,
    clean_list_sql,
    clean_sql,
    labelled,
    query,
    r6,
    sql_in,
    sql_values,
    table,
    texts,
)

TOPICS = ["license", ["this", "with"], "the AND thing AND from", "worthless", ["best", "and"]]
TERMS = [(L.topic_query(t), term) for t in TOPICS for term in L.topic_terms(L.topic_query(t))]
TERMS_SQL = sql_values(TERMS, "query", "term")


def topic_sql(body: str, text: str) -> str:
    """Rows of ``body`` (with id) per topic whose terms all occur in ``text``."""
    return f"""
        SELECT a.id, t.query FROM {body} a JOIN {TERMS_SQL} t
          ON contains(lower(a.{text}), lower(t.term))
        GROUP BY a.id, t.query
        HAVING count(DISTINCT t.term) = (SELECT count(*) FROM {TERMS_SQL} q WHERE q.query = t.query)
    """


EVENT_TOPICS = ["click", ["err", "or"], "view AND nothing"]
EVENT_START, EVENT_END = "2024-01-02", "2024-01-10"
EVENT_SOURCES = list(range(0, 200))


@query(f"""
    SELECT event_id, user_id, search_keyword FROM (
        SELECT event_id, user_id, ts, 'click' AS search_keyword FROM events WHERE contains(lower(event_type), 'click')
        UNION ALL
        SELECT event_id, user_id, ts, 'err AND or' FROM events
        WHERE contains(lower(event_type), 'err') AND contains(lower(event_type), 'or')
    ) WHERE user_id < 200
      AND ts >= TIMESTAMP '{EVENT_START}' AND ts < TIMESTAMP '{EVENT_END}' + INTERVAL 1 DAY
""")
def src01_topic_articles(spark, sf):
    events = table(spark, sf, "events")
    return L.topic_articles(
        events, EVENT_TOPICS, ["event_type"],
        source_column="user_id", sources=EVENT_SOURCES,
        date_column="ts", start=EVENT_START, end=EVENT_END,
    ).select("event_id", "user_id", "search_keyword")


@query(f"""
    SELECT t.query, t.term, count(*) AS n_articles
    FROM documents d JOIN {TERMS_SQL} t ON contains(lower(d.text), lower(t.term))
    GROUP BY t.query, t.term
""")
def src02_topic_terms(spark, sf):
    single = [term for _, term in TERMS]
    hits = L.topic_counts(table(spark, sf, "documents"), sorted(set(single)), ["text"])
    terms = L.topics_table(spark, TOPICS)
    return terms.join(hits.withColumnRenamed("search_keyword", "term"), "term").select(
        "query", "term", "n_articles"
    )


@query(f"""
    SELECT query AS search_keyword, count(*) AS n_articles
    FROM ({topic_sql("(SELECT doc_id AS id, text FROM documents)", "text")}) GROUP BY query
""")
def src03_tagged_articles(spark, sf):
    return L.topic_counts(table(spark, sf, "documents"), TOPICS, ["text"])


@query("""
    SELECT DISTINCT query, replace(trim(regexp_replace(replace(query, 'AND', ' '), ' +', ' ', 'g')), ' ', '_') AS topic_slug
    FROM (SELECT source || ' AND  ' || upper(lang) || ' BRAND ' AS query FROM documents)
""")
def src05_topic_slug(spark, sf):
    topics = table(spark, sf, "documents").select(
        F.concat("source", F.lit(" AND  "), F.upper("lang"), F.lit(" BRAND ")).alias("query")
    )
    return topics.distinct().withColumn("topic_slug", T.topic_slug(F.col("query")))


@query("SELECT 'documents' AS table_name, count(*) AS n_rows FROM documents")
def src08_load_table(spark, sf):
    return readers.load_report(readers.read_table(spark, f"{sf}/documents.parquet"), "documents")


@query("""
    SELECT 'labels' AS table_key, doc_id, quality, toxic FROM labels
""")
def src09_keyed_folder(spark, sf):
    return readers.read_keyed_folder(spark, sf, "labels.parquet").select(
        "table_key", "doc_id", "quality", "toxic"
    )


@query(f"SELECT page_id, {PUBLISHER_SQL} AS publisher FROM pages")
def prj01_publisher_from_url(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", T.publisher_from_url(F.col("url")).alias("publisher")
    )


TITLE_SQL = "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"
# The pages cut some titles inside an entity: &amp without its semicolon.
DECODED_TITLE_SQL = (
    f"regexp_replace(replace(replace(replace({TITLE_SQL}, '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), "
    "'&amp;?', '&', 'g')"
)


@query(f"""
    SELECT page_id, CASE WHEN contains(t, ' - ') THEN string_split(t, ' - ')[-1]
                         WHEN contains(t, ' | ') THEN string_split(t, ' | ')[-1]
                         ELSE 'Unknown' END AS publisher
    FROM (SELECT page_id, replace({TITLE_SQL}, ' the ', ' - ') || CASE WHEN url LIKE 'https%' THEN '' ELSE ' | ' || url END AS t
          FROM pages)
""")
def prj02_publisher_from_title(spark, sf):
    title = F.concat(
        F.replace(P.page_title(F.col("html")), F.lit(" the "), F.lit(" - ")),
        F.when(F.col("url").like("https%"), "").otherwise(F.concat(F.lit(" | "), F.col("url"))),
    )
    return table(spark, sf, "pages").select(
        "page_id", T.publisher_from_title(title).alias("publisher")
    )


@query(f"SELECT doc_id, {clean_sql('text')} AS content FROM documents")
def prj03_clean_words(spark, sf):
    return texts(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", T.clean_words(F.col("text")).alias("content")
    )


# Whole texts of the paragraphs by pattern: script and style removed, an open
# paragraph ends at the next paragraph tag, tags removed, the entities of the
# pages decoded (&amp; last).
PARAGRAPHS_SQL = r"""
    array_to_string(list_transform(
        regexp_extract_all(
            regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>', '', 'g'),
                           '(?i)<p>', '</p><p>', 'g'),
            '(?is)<p>(.*?)(?:</p>|</article>|$)', 1),
        lambda b: replace(replace(replace(replace(regexp_replace(b, '(?s)<!--.*?-->|<[^>]*>', '', 'g'),
                  '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')), ' ')
"""


# The first paragraph or block that holds one string, a by-line of at most three words.
AUTHOR_SQL = r"""
    list_transform(list_filter(list_transform(
        regexp_extract_all(html, '(?is)<(?:p|div)(?:\s[^>]*)?>([^<]*)</(?:p|div)>', 1),
        lambda x: regexp_split_to_array(trim(replace(x, '&amp;', '&')), '\s+')),
        lambda ws: lower(ws[1]) = 'by' AND len(ws) BETWEEN 2 AND 4), lambda ws: array_to_string(ws[2:], ' '))[1]
"""


# The pages with what they lack: a third has two author tags (the second without
# content), a fifth a publish date, some a status other than 200 or no title.
EDITED_PAGES_SQL = r"""
    (SELECT page_id, url, CASE WHEN page_id % 7 = 2 THEN 404 ELSE 200 END AS status,
            CASE WHEN page_id % 11 = 3 THEN regexp_replace(h, '(?is)<title[^>]*>.*?</title>', '') ELSE h END AS html
     FROM (SELECT page_id, url, replace(html, '<head>', '<head>'
                  || CASE WHEN page_id % 3 = 0 THEN '<meta name="author" content="Ann ' || page_id || '"><meta name="author">' ELSE '' END
                  || CASE WHEN page_id % 5 = 0 THEN '<meta name="publish-date" content="2024-01-0' || (page_id % 9 + 1) || '">' ELSE '' END) AS h
           FROM pages))
"""
KEPT_PAGES_SQL = f"(SELECT * FROM {EDITED_PAGES_SQL} WHERE status = 200 AND page_id % 11 <> 3)"
EDITED_AUTHOR_SQL = f"CASE WHEN page_id % 3 = 0 THEN 'Ann ' || page_id ELSE {AUTHOR_SQL} END"
EDITED_DATE_SQL = "CASE WHEN page_id % 5 = 0 THEN '2024-01-0' || (page_id % 9 + 1) END"


def tagged_pages(spark, sf):
    """All pages; some get an author and a date, which the given ones lack."""
    number = F.col("page_id")
    author = F.concat(F.lit('<meta name="author" content="Ann '), number.cast("string"), F.lit('"><meta name="author">'))
    date = F.concat(F.lit('<meta name="publish-date" content="2024-01-0'), (number % 9 + 1).cast("string"), F.lit('">'))
    head = F.concat(
        F.lit("<head>"), F.when(number % 3 == 0, author).otherwise(""), F.when(number % 5 == 0, date).otherwise("")
    )
    return texts(spark, sf, "pages").select(
        "page_id", "url", F.lit(200).alias("status"), F.replace("html", F.lit("<head>"), head).alias("html")
    )


def edited_pages(spark, sf):
    """All pages, some of them as if they had not been found or had no title."""
    bare = F.regexp_replace("html", "(?is)<title[^>]*>.*?</title>", "")
    return tagged_pages(spark, sf).select(
        "page_id", "url", F.when(F.col("page_id") % 7 == 2, 404).otherwise(200).alias("status"),
        F.when(F.col("page_id") % 11 == 3, bare).otherwise(F.col("html")).alias("html"),
    )


@query(f"""
    SELECT page_id, {DECODED_TITLE_SQL} AS title, {EDITED_AUTHOR_SQL} AS author,
           {EDITED_DATE_SQL} AS publish_date, {PARAGRAPHS_SQL} AS content,
           NULL::VARCHAR AS theme, url, {PUBLISHER_SQL} AS publisher
    FROM pages
""")
def prj04_page_fields(spark, sf):
    return P.extract_articles(tagged_pages(spark, sf), status="status", keep=("page_id",))


def all_and_kept(spark, sf):
    """Articles of all pages, and those that stay of the edited ones by status and title: ``pages`` tells which."""
    def parsed(pages, name):
        articles = P.extract_articles(pages, status="status", keep=("page_id",))
        return articles.select(F.lit(name).alias("pages"), "page_id", "author", "publish_date", "publisher")

    return parsed(tagged_pages(spark, sf), "all").unionByName(parsed(edited_pages(spark, sf), "kept"))


@query(f"""
    SELECT 'all' AS pages, page_id, {EDITED_DATE_SQL} AS publish_date FROM pages
    UNION ALL SELECT 'kept', page_id, {EDITED_DATE_SQL} FROM {KEPT_PAGES_SQL}
""")
def prj04c_publish_date(spark, sf):
    """Every page's date, null without a tag; also of the pages left by status and title."""
    return all_and_kept(spark, sf).select("pages", "page_id", "publish_date")


# A paragraph runs to the paragraph tag that takes the nesting below its own
# level, or to the end of the article.
REPEATED_SQL = r"""
    body AS (SELECT page_id, regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS b FROM pages),
    parts AS (SELECT page_id, regexp_extract_all(b, '</?p>') AS evs,
                     string_split(regexp_replace(b, '</?p>', chr(1), 'g'), chr(1)) AS segs FROM body),
    ev AS (SELECT page_id, unnest(evs) AS e, unnest(range(1, len(evs) + 1)) AS i, unnest(segs[2:]) AS seg FROM parts),
    dep AS (SELECT *, sum(CASE e WHEN '<p>' THEN 1 ELSE -1 END) OVER (PARTITION BY page_id ORDER BY i) AS d FROM ev),
    cov AS (SELECT a.page_id, a.i AS k, b.i AS j, b.seg FROM dep a JOIN dep b ON b.page_id = a.page_id AND b.i >= a.i
            WHERE a.e = '<p>' AND NOT EXISTS (SELECT 1 FROM dep c WHERE c.page_id = a.page_id AND c.i > a.i AND c.i <= b.i AND c.d < a.d)),
    par AS (SELECT page_id, k, replace(replace(replace(replace(regexp_replace(string_agg(seg, '' ORDER BY j), '(?s)<!--.*?-->|<[^>]*>', '', 'g'),
                   '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS t FROM cov GROUP BY ALL),
    txt AS (SELECT page_id, string_agg(t, ' ' ORDER BY k) AS content FROM par GROUP BY page_id)
"""


@query(f"""
    WITH {REPEATED_SQL}
    SELECT page_id, {DECODED_TITLE_SQL} AS title, {AUTHOR_SQL} AS author,
           NULL::VARCHAR AS publish_date, coalesce(content, '') AS content,
           NULL::VARCHAR AS theme, url, {PUBLISHER_SQL} AS publisher
    FROM pages LEFT JOIN txt USING (page_id)
""")
def prj04_page_fields_repeat(spark, sf):
    """Nested paragraphs counted in each paragraph that holds them."""
    return P.extract_articles(texts(spark, sf, "pages"), keep=("page_id",), nested="repeat")


@query(f"SELECT page_id, {TITLE_SQL} AS title FROM pages WHERE regexp_matches(html, '(?is)<title[\\s>]')")
def prj04a_page_title(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", P.page_title(F.col("html")).alias("title")).where(
        F.col("title").isNotNull()
    )


@query(f"""
    WITH art AS (
        SELECT 'all' AS pages, page_id, {EDITED_AUTHOR_SQL} AS author, {EDITED_DATE_SQL} AS publish_date, {PUBLISHER_SQL} AS publisher
        FROM pages
        UNION ALL SELECT 'kept', page_id, {EDITED_AUTHOR_SQL}, {EDITED_DATE_SQL}, {PUBLISHER_SQL} FROM {KEPT_PAGES_SQL}
    )
    SELECT pages, page_id, author, publisher, count(*) OVER w AS n_pages, count(author) OVER w AS n_authors, count(publish_date) OVER w AS n_dates
    FROM art WINDOW w AS (PARTITION BY pages, publisher)
""")
def prj04b_page_authors(spark, sf):
    """From the first author tag, else from a by-line; with the publisher's pages that have an author and a date."""
    articles = stored(all_and_kept(spark, sf))  # parsed once
    counts = articles.groupBy(F.struct("pages", "publisher").alias("of")).agg(
        F.count(F.lit(1)).alias("n_pages"), F.count("author").alias("n_authors"), F.count("publish_date").alias("n_dates")
    )
    return articles.join(counts, F.struct("pages", "publisher").eqNullSafe(F.col("of"))).select(
        "pages", "page_id", "author", "publisher", "n_pages", "n_authors", "n_dates"
    )


@query(f"""
    SELECT count(*) AS pages, count(*) FILTER (status <> 200) AS bad_status,
           count(*) FILTER (status = 200 AND page_id % 11 = 3) AS not_parsed,
           count(*) FILTER (status = 200 AND page_id % 11 <> 3) AS kept
    FROM {EDITED_PAGES_SQL}
""")
def flt11_page_report(spark, sf):
    return P.extract_report(edited_pages(spark, sf), status="status")


@query("SELECT doc_id, 'licensing' AS theme FROM documents WHERE contains(lower(text), 'license')")
def prj05_constant_theme(spark, sf):
    docs = table(spark, sf, "documents")
    return L.tag_topics(docs, ["license"], ["text"], "hit").select(
        "doc_id", F.lit("licensing").alias("theme")
    )


@query("""
    SELECT sha256(coalesce(length(text) || ':' || text, '~') || coalesce(length(lang) || ':' || lang, '~')
                  || coalesce(length(source) || ':' || source, '~')) AS unique_id,
           text, lang, source
    FROM (SELECT DISTINCT text, lang, source FROM documents)
""")
def prj06_row_id(spark, sf):
    rows = R.drop_repeated_rows(table(spark, sf, "documents").select("text", "lang", "source"))
    return R.with_row_id(rows)


@query("""
    SELECT source, NULL::VARCHAR AS author, doc_id, NULL::VARCHAR AS editorial_stance, lang FROM documents
""")
def prj07_column_order(spark, sf):
    order = ["source", "author", "doc_id", "editorial_stance", "lang"]
    return R.in_column_order(table(spark, sf, "documents"), order)


@query("SELECT d.doc_id, coalesce(CASE WHEN l.toxic = 1 THEN d.lang END, '') AS flagged, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def prj08_fill_text(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    joined = L.attach(docs, table(spark, sf, "labels"), "doc_id")
    return R.fill_text(
        joined.select("doc_id", F.when(F.col("toxic") == 1, F.col("lang")).alias("flagged"), "quality")
    )


@query("SELECT event_id, CASE WHEN value - 20 > 0 THEN 'positive' ELSE 'negative' END AS category FROM events")
def prj09_sentiment_category(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", T.sentiment_category(F.col("value") - 20).alias("category")
    )


KEYWORD_ROWS_SQL = (
    f"SELECT doc_id, array_to_string({clean_list_sql('text')}, ', ') AS keywords FROM documents"
)


def _keyword_rows(spark, sf):
    """Each document's cleaned words as a comma-joined list."""
    cleaned = T.words(T.clean_words(F.col("text")))
    return texts(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", F.array_join(cleaned, ", ").alias("keywords")
    )


@query(f"""
    SELECT doc_id, unnest(string_split(keywords, ', ')) AS token,
           unnest(range(len(string_split(keywords, ', ')))) AS pos FROM ({KEYWORD_ROWS_SQL})
""")
def prj11_split_keywords(spark, sf):
    split = TH.split_keywords(_keyword_rows(spark, sf), "keywords", "doc_id")
    return split.withColumn("pos", F.col("pos").cast("long"))


@query("""
    SELECT lang, string_agg(source, ', ' ORDER BY source) AS sources
    FROM (SELECT DISTINCT lang, source FROM documents) GROUP BY lang
""")
def prj12_join_strings(spark, sf):
    pairs = table(spark, sf, "documents").select("lang", "source").distinct()
    return pairs.groupBy("lang").agg(
        F.array_join(F.sort_array(F.collect_list("source")), ", ").alias("sources")
    )


@query("SELECT vec_id, 'Cluster ' || (label + 1) AS cluster, 'Topic ' || label AS topic FROM embeddings")
def prj13_display_names(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id",
        F.concat(F.lit("Cluster "), (F.col("label") + 1).cast("string")).alias("cluster"),
        F.concat(F.lit("Topic "), F.col("label").cast("string")).alias("topic"),
    )


KEYWORD_STOP = ["the", "and", "that", "les", "und", "que"]
KEYWORD_TOKENS_SQL = (
    "list_filter(string_split(lower(" + clean_sql("text") + "), ' '), "
    f"lambda w: length(w) > 2 AND w NOT IN {sql_in(KEYWORD_STOP)})"
)


@query(f"SELECT doc_id, array_to_string({KEYWORD_TOKENS_SQL}, ' ') AS keyword_text FROM documents")
def prj16_keyword_words(spark, sf):
    cleaned = T.clean_words(F.col("text"))
    return texts(spark, sf, "documents", "doc_id", "text").select(
        "doc_id", F.array_join(T.keyword_tokens(cleaned, KEYWORD_STOP), " ").alias("keyword_text")
    )


EXCLUDED = ["worthless", "licen.e", "TOKEN"]
EXCLUDED_SQL = "regexp_matches(text, '(?i)(?:" + "|".join(EXCLUDED) + ")')"


@query(f"SELECT doc_id, lang FROM documents WHERE NOT coalesce({EXCLUDED_SQL}, false)")
def flt01_exclude_keywords(spark, sf):
    return R.exclude_by_keywords(table(spark, sf, "documents"), "text", EXCLUDED).select("doc_id", "lang")


@query(f"SELECT doc_id, {clean_sql('text')} AS content FROM documents WHERE length(trim({clean_sql('text')})) >= 1")
def flt02_drop_blank(spark, sf):
    docs = texts(spark, sf, "documents", "doc_id", "text")
    return R.drop_blank(docs.select("doc_id", T.clean_words(F.col("text")).alias("content")))


@query(f"SELECT doc_id, publisher, label_lex, label_model FROM ({LABELLED_SQL}) WHERE label_lex = label_model")
def flt03_keep_agreeing(spark, sf):
    rows = labelled(spark, sf, "doc_id", "publisher", "label_lex", "label_model")
    return R.keep_agreeing(rows, "label_lex", "label_model")


@query("SELECT doc_id, source FROM documents WHERE lang = 'de'")
def flt04_where_equals(spark, sf):
    return R.where_equals(table(spark, sf, "documents"), "lang", "de").select("doc_id", "source")


@query("SELECT doc_id, lang, n_chars FROM documents")
def flt05_drop_empty_columns(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", "lang", "n_chars",
        F.when(F.col("n_chars") < 0, F.col("source")).alias("never_set"),
        (F.col("n_chars") * 0).alias("always_zero"),
    )
    return C.drop_empty_columns(docs)


def _messy(spark, sf):
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels").withColumnRenamed("quality", "score_y")
    return docs.join(labels, "doc_id", "left").select(
        F.col("n_chars").alias("Unnamed: nothing"),
        F.col("doc_id").alias("chars9"),
        F.col("doc_id").alias("article"),
        F.col("source").alias("publication_outlet_name"),
        F.col("lang").alias("publication_outlet_names"),
        F.col("n_chars").alias("score_x"),
        "score_y",
        "toxic",
        F.col("lang").alias("language_x"),
    )


@query("""
    SELECT d.doc_id AS article, d.source AS publication_outlet_name, l.quality AS score, l.toxic, d.lang AS language
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def flt09_consolidate_columns(spark, sf):
    return C.consolidate_columns(_messy(spark, sf))


@query("SELECT d.doc_id AS article, d.source AS publication_outlet_name, d.lang AS publication_outlet_names, d.n_chars AS score_x, l.quality AS score_y, l.toxic, d.lang AS language_x FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def flt06_drop_unwanted_names(spark, sf):
    return C.drop_unwanted_names(_messy(spark, sf))


@query("SELECT d.doc_id AS article, d.source AS publication_outlet_name, d.n_chars AS score_x, l.quality AS score_y, l.toxic, d.lang AS language_x FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def flt07_drop_similar_names(spark, sf):
    return C.drop_near_duplicate_names(C.drop_unwanted_names(_messy(spark, sf)))


@query("SELECT d.doc_id AS article, d.source AS publication_outlet_name, l.quality AS score, l.toxic, d.lang AS language FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def flt08_keep_last_name(spark, sf):
    tidy = C.drop_near_duplicate_names(C.drop_unwanted_names(_messy(spark, sf)))
    return C.keep_last_of_repeated_names(C.strip_merge_suffix(tidy))


@query("SELECT event_id, value FROM events WHERE value >= 25.5")
def flt10_similarity_threshold(spark, sf):
    return R.at_least(table(spark, sf, "events"), "value", 25.5).select("event_id", "value")


@query("SELECT page_id, url FROM pages WHERE url LIKE 'https%'")
def flt12_empty_input(spark, sf):
    """Articles of one source whose pages were fetched, and of one with none: an empty input adds no row."""
    pages = table(spark, sf, "pages").withColumn("status", F.when(F.col("url").like("https%"), 200))
    parts = [
        P.extract_articles(pages.where(part), status="status", keep=("page_id",))
        for part in (F.col("url").like("https%"), ~F.col("url").like("https%"))
    ]
    return R.union_by_name(*parts).select("page_id", "url")


@query("""
    SELECT count(doc_id) AS doc_id, count(lang) AS lang, count(quality) AS quality, count(toxic) AS toxic
    FROM (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
""")
def ag07_non_null_counts(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return C.non_null_counts(L.attach(docs, table(spark, sf, "labels"), "doc_id"))


@query("SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def tk04_order_columns_by_fill(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    joined = L.attach(docs, table(spark, sf, "labels"), "doc_id")
    return C.order_by_fill(joined.select("quality", "toxic", "doc_id"))


@query(f"""
    SELECT count(*) AS rows_before, count(*) FILTER (label_lex = label_model) AS rows_after,
           count(*) - count(*) FILTER (label_lex = label_model) AS rows_dropped,
           round((count(*) - count(*) FILTER (label_lex = label_model)) / count(*) * 100, 6) AS percent_dropped
    FROM ({LABELLED_SQL})
""")
def ag08_filter_report(spark, sf):
    rows = labelled(spark, sf, "label_lex", "label_model")
    report = R.filter_report(rows, F.col("label_lex") == F.col("label_model"))
    return report.withColumn("percent_dropped", r6("percent_dropped"))


@query("SELECT DISTINCT source FROM documents")
def ag09_distinct_values(spark, sf):
    return R.distinct_values(table(spark, sf, "documents"), "source")


@query("SELECT DISTINCT text, lang FROM documents")
def ag10_drop_repeated_rows(spark, sf):
    return R.drop_repeated_rows(table(spark, sf, "documents").select("text", "lang"))


@query("SELECT DISTINCT text, lang FROM documents")
def ag10_rarely_repeated_rows(spark, sf):
    """Only rows that may be repeated are shuffled whole."""
    return R.drop_repeated_rows(table(spark, sf, "documents").select("text", "lang"), rare=True)


@query("""
    SELECT (SELECT count(*) FROM documents) AS rows_before,
           (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS rows_after,
           (SELECT count(*) FROM documents) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS rows_removed
""")
def ag10_repeated_rows_report(spark, sf):
    return R.repeated_rows_report(table(spark, sf, "documents").select("text", "lang"))


@query("SELECT count(DISTINCT text) AS n_texts FROM documents")
def ag16_distinct_texts(spark, sf):
    return R.distinct_count(table(spark, sf, "documents"), "text").toDF("n_texts")


@query("""
    SELECT doc_id AS id, text, lang, NULL::VARCHAR AS role FROM documents
    UNION ALL SELECT item_id, text, NULL, NULL FROM benchmark
    UNION ALL SELECT conv_id, text, NULL, role FROM conversations
""")
def st01_union_by_name(spark, sf):
    return R.union_by_name(
        table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text", "lang"),
        table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text"),
        table(spark, sf, "conversations").select("role", F.col("conv_id").alias("id"), "text"),
    ).select("id", "text", "lang", "role")


@query(f"""
    SELECT id AS doc_id, query AS theme
    FROM ({topic_sql("(SELECT doc_id AS id, text FROM documents)", "text")})
""")
def st02_append_per_topic(spark, sf):
    """All topics in one plan: the theme is a column."""
    return L.tag_topics(table(spark, sf, "documents"), TOPICS, ["text"], "theme").select("doc_id", "theme")


@query("SELECT DISTINCT source, lang FROM documents")
def st03_distinct_rows(spark, sf):
    return R.drop_repeated_rows(table(spark, sf, "documents").select("source", "lang"))


@query(f"""
    SELECT id AS doc_id, query AS search_keyword
    FROM ({topic_sql("(SELECT doc_id AS id, text FROM documents)", "text")})
""")
def jn05_topic_articles(spark, sf):
    return L.tag_topics(table(spark, sf, "documents"), TOPICS, ["text"]).select("doc_id", "search_keyword")


SYLLABLES = [a + b for a in "bcdfglmnprst" for b in ("a", "e", "i", "o", "an", "er", "is", "on", "th", "st")]
# single syllables, pairs of them that must both occur, and phrases over a word border
MANY_TOPICS = SYLLABLES + [f"{a} AND {b}x" for a in SYLLABLES[::3] for b in SYLLABLES[::40]] + [f"{a} {b}" for a in SYLLABLES[::6] for b in SYLLABLES[1::11]]
MANY_TERMS_SQL = sql_values([(q, t) for q in MANY_TOPICS for t in L.topic_terms(q)], "query", "term")


@query(f"""
    WITH t AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY query) AS needed FROM {MANY_TERMS_SQL}),
    hit AS (SELECT doc_id, t.query, needed FROM documents d JOIN t ON contains(lower(d.text), t.term))
    SELECT query AS search_keyword, count(*) AS n_articles FROM
    (SELECT doc_id, query FROM hit GROUP BY doc_id, query, needed HAVING count(*) = needed) GROUP BY query
""")
def jn05_many_topics(spark, sf):
    """Several hundred topics, all searched for in one pass over each text."""
    docs = texts(spark, sf, "documents", "doc_id", "text")
    return L.topic_counts(docs, MANY_TOPICS, ["text"])


@query("""
    SELECT d.doc_id, d.source, l.quality, l.toxic, l2.quality AS quality_bert
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN labels l2 ON d.doc_id = l2.doc_id
""")
def jn01_merge_scores(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source")
    labels = table(spark, sf, "labels")
    return L.merge_scores(
        docs, labels, labels.select("doc_id", "quality"), key="doc_id", suffixes=["", "_bert"]
    )


@query("SELECT d.doc_id AS article, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def prj10_strip_merge_suffix(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("lang_x"))
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("quality_y"))
    return C.strip_merge_suffix(L.attach(docs, labels, "doc_id").withColumnRenamed("doc_id", "article_x"))


@query(f"SELECT page_id, {PARAGRAPHS_SQL} AS content FROM pages")
def prj04d_body_text(spark, sf):
    return P.extract_articles(texts(spark, sf, "pages"), keep=("page_id",)).select("page_id", "content")
