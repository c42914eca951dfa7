"""Document fingerprints: a Merkle tree over leaves, paragraphs and sections.

A text is cut into leaves where its content says so: at sentence ends, and in longer
stretches, from 40 characters on, after a word that ends with one of some letters or
at one of some rarer characters (after 160 characters in any case).  So an insertion
moves the cuts near it only, also in code, lists and text without punctuation.  A leaf
with a line end closes a paragraph; a paragraph whose last
leaf's hash begins with 0 to 3 closes a section, so that sections follow the content
and an insertion moves no later border.  Each node is the MD5 of its children; equal
roots mean equal texts.  The fingerprint is the root followed by eight digits of
each leaf, with ``-``, ``,`` and ``.`` after leaves, paragraphs and sections: where
two fingerprints differ shows what was edited.

Everything is column expressions over Spark's own functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pressgrain.llm.common import keyed_texts

# Up to 40 characters, then to the next place to cut or sentence end; sentence ends alone.
LEAF = r"[^.!?\n]{1,40}(?:[^.!?\n]{0,118}?(?:[aehlosAEHLOS,;:][ \t]|[qxzQXZ79])|[^.!?\n]{0,120})[.!?\n]*|[.!?\n]+"


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the fingerprint of a text column; a null text counts as empty.

    The steps are separate projections, so that hashes are computed once.
    """
    leaves, hashes, marked = f"{out}_leaves", f"{out}_hashes", f"{out}_marked"

    def mark(leaf: Column, digest: Column) -> Column:
        closes = F.contains(leaf, F.lit("\n"))
        return F.concat(
            digest,
            F.when(closes & (F.substring(digest, 1, 1) <= "3"), ".").when(closes, ",").otherwise("-"),
        )

    df = df.withColumn(leaves, F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(LEAF), F.lit(0)))
    df = df.withColumn(hashes, F.transform(leaves, F.md5))
    df = df.withColumn(marked, F.zip_with(leaves, hashes, mark)).drop(leaves, hashes)
    paragraphs = lambda section: F.array_join(F.transform(F.split(section, ","), F.md5), ",")
    sections = F.transform(
        F.split(F.array_join(marked, ""), "[.]"), lambda section: F.md5(paragraphs(section))
    )
    short = F.array_join(F.transform(marked, lambda m: F.concat(F.substring(m, 1, 8), F.substring(m, 33, 1))), "")
    return df.withColumn(out, F.concat(F.md5(F.array_join(sections, ".")), F.lit(":"), short)).drop(marked)


def root(fingerprint: Column) -> Column:
    return F.substring_index(fingerprint, ":", 1)


def leaf_ids(fingerprint: Column) -> Column:
    """The distinct leaves of a fingerprint."""
    return F.array_distinct(F.array_remove(F.split(F.substring_index(fingerprint, ":", -1), "[-,.]"), ""))


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: one for equal roots, else twice the shared leaves by all distinct leaves of both."""
    x, y = leaf_ids(a), leaf_ids(b)
    shared = F.size(F.array_intersect(x, y)).cast("double")
    return F.when(root(a) == root(b), 1.0).otherwise(2 * shared / (F.size(x) + F.size(y)))


def changed_sections(a: Column, b: Column) -> Column:
    """Places, from 0, of the sections of ``a`` that ``b`` does not have: where the edits are."""
    cut = lambda f: F.split(F.substring_index(f, ":", -1), "[.]")
    places = F.transform(cut(a), lambda s, i: F.when(F.array_contains(cut(b), s), F.lit(-1)).otherwise(i))
    return F.when(root(a) == root(b), F.array().cast("array<int>")).otherwise(F.array_remove(places, -1))


def _numbers(values: list[int]) -> Column:
    """Numbers held by the driver as one array: one literal, however many they are."""
    empty = F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else empty


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are below the key, by blocks of about the root of their number."""
    step = max(1, int(len(bounds) ** 0.5))
    below = lambda values: F.size(F.filter(values, lambda v: v < key))
    # the block that the key falls in is the last whose first bound lies below it
    block = below(_numbers(bounds[::step]))
    inner = below(F.slice(_numbers(bounds), (F.greatest(block, F.lit(1)) - 1) * step + 1, F.lit(step)))
    return F.when(block == 0, F.lit(0)).otherwise((block - 1) * step + inner)


def with_next(docs: DataFrame, columns: list[str], key: str = "doc_id", parts: int | None = None) -> DataFrame:
    """Adds ``next_<column>`` of the row that follows by descending key; the last is followed by the first.

    Keys are cut into ``parts`` ranges of about equal numbers of rows (four for each
    shuffle partition by default).  Each range is ordered alone; its first row is also
    dealt to the range above, whose last row it follows.  So rows are shuffled once
    and no task orders more than a range.  Equal keys follow each other by the hash of
    their columns, a null key counts as the smallest.  Only the ranges' bounds and
    largest keys come to the driver; the plan has them as arrays and does not grow with
    their number.  Runs two jobs over the key column.
    """
    spark = docs.sparkSession
    if parts is None:
        parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    low = -(1 << 63)
    k = F.coalesce(F.col(key), F.lit(low).cast("long"))
    at = [i / parts for i in range(1, parts)]
    bounds = docs.agg(F.percentile_approx(k, at, 10 * parts)).first()[0] if at else []
    bounds = sorted(set(bounds or []))
    own = _bucket(k, bounds)
    heads = {r["b"]: r["m"] for r in docs.select(own.alias("b"), k.alias("k")).groupBy("b").agg(F.max("k").alias("m")).collect()}
    order = sorted(heads)
    above = dict(zip(order, order[1:] + order[:1]))
    every = range(len(bounds) + 1)
    head = F.get(_numbers([heads.get(b, low) for b in every]), F.col("_own"))
    receiver = F.get(_numbers([above.get(b, 0) for b in every]), F.col("_own")).cast("int")
    place = lambda b, extra: F.struct(b.alias("b"), F.lit(extra).alias("extra"))
    dealt = (
        docs.withColumn("_k", k)
        .withColumn("_own", own)
        .withColumn("_receiver", F.when(F.col("_k") == head, receiver))
        .withColumn("_at", F.explode(
            F.when(F.col("_receiver").isNull(), F.array(place(F.col("_own"), 0)))
            .otherwise(F.array(place(F.col("_own"), 0), place(F.col("_receiver"), 1)))
        ))
        .select("*", F.col("_at.b").alias("_b"), F.col("_at.extra").alias("_extra"), F.xxhash64(*columns).alias("_tie"))
    )
    window = Window.partitionBy("_b").orderBy("_extra", F.col("_k").desc(), "_tie")
    return (
        dealt.select(*docs.columns, "_b", "_extra", "_k", "_tie")
        .select("*", *(F.lead(c).over(window).alias(f"next_{c}") for c in columns))
        .where(F.col("_extra") == 0)
        .drop("_b", "_extra", "_k", "_tie")
    )


def edited(text: Column, next_text: Column) -> Column:
    """The text with the last third of its code points replaced by the first as many of the next text."""
    third = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - third), F.substring(next_text, F.lit(1), third))


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    One for each input row: fingerprints of each text, of the text with its last third
    replaced from the next document by descending doc_id, and their likeness to that
    and to the next document.  Null texts are empty; see ``with_next`` for null and
    repeated ids.  Runs the two small jobs of ``with_next``.
    """
    texts = with_fingerprint(keyed_texts(docs, id_col, text_col), "text", "fingerprint")
    follow = with_next(texts, ["text", "fingerprint"])
    changed = with_fingerprint(
        follow.withColumn("edited_text", edited(F.col("text"), F.col("next_text"))), "edited_text", "edited_fingerprint"
    )
    own = F.col("fingerprint")
    return changed.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited_text", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", likeness(own, F.col("edited_fingerprint")).alias("near_edited"),
        likeness(own, F.col("next_fingerprint")).alias("near_next"),
    )


def _sql_print(text: str, out: str, source: str) -> str:
    """The same fingerprint in SQL: the source's columns, ``out`` and its leaves."""
    return f"""
        SELECT * EXCLUDE (marks, hashes, leaves),
               md5(array_to_string(list_transform(string_split(array_to_string(marks, ''), '.'), lambda s:
                   md5(array_to_string(list_transform(string_split(s, ','), lambda p: md5(p)), ','))), '.'))
               || ':' || array_to_string(list_transform(marks, lambda m: m[1:8] || m[33:33]), '') AS {out},
               list_distinct(list_transform(hashes, lambda h: h[1:8])) AS {out}_ids
        FROM (SELECT *, list_transform(list_zip(leaves, hashes), lambda z:
                     z[2] || CASE WHEN contains(z[1], chr(10)) AND z[2][1:1] <= '3' THEN '.'
                                  WHEN contains(z[1], chr(10)) THEN ',' ELSE '-' END) AS marks
              FROM (SELECT *, list_transform(leaves, lambda x: md5(x)) AS hashes
                    FROM (SELECT *, regexp_extract_all({text}, '{LEAF}') AS leaves FROM {source})))
    """


def _sql_likeness(a: str, b: str) -> str:
    return (
        f"CASE WHEN split_part({a}, ':', 1) = split_part({b}, ':', 1) THEN 1.0::DOUBLE "
        f"ELSE 2 * len(list_intersect({a}_ids, {b}_ids))::DOUBLE / (len({a}_ids) + len({b}_ids)) END"
    )


COMPARE_SQL = f"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    own AS ({_sql_print("text", "fingerprint", "t")}),
    follow AS (
        SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text,
               coalesce(lead(fingerprint) OVER w, first_value(fingerprint) OVER w) AS next_print,
               coalesce(lead(fingerprint_ids) OVER w, first_value(fingerprint_ids) OVER w) AS next_print_ids
        FROM own WINDOW w AS (ORDER BY doc_id DESC)),
    cut AS (SELECT *, substring(text, 1, length(text) - length(text) // 3)
                      || substring(next_text, 1, length(text) // 3) AS edited_text FROM follow),
    changed AS ({_sql_print("edited_text", "edited_fingerprint", "cut")})
    SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited_text) AS edited_sha256,
           fingerprint, edited_fingerprint,
           {_sql_likeness("fingerprint", "edited_fingerprint")} AS near_edited,
           {_sql_likeness("fingerprint", "next_print")} AS near_next
    FROM changed
"""
