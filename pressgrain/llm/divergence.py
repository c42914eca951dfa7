"""How the sources of a language differ in their words, by ranking cells of equal counts.

Terms are runs of ASCII letters and all other non-ASCII characters, A to Z lower-cased.
Each language keeps the terms that occur in at least ``min_docs`` of its documents.
A group is a (language, source) that occurs.  A term's share in a group, or in the
whole language, is ``p = 1 + floor(10**9 * (count + 2) / (N + 2 * V))``: N counts all
kept terms there, V is the number of kept terms.  The divergence of two shares is
``f = floor((p - q)**2 / (p + q))``.  All of it is integer arithmetic.

Nothing is evaluated term by term where counts are equal:

* ``distinctive_terms`` groups a group's terms by (count there, count in the language),
  evaluates f once for each such cell, merges cells of equal value, keeps the values
  that the ranks asked for can reach by their cumulative multiplicity, and only expands
  the terms of those, in UTF-8 order.
* ``source_distances`` sums f over all kept terms of two sources.  Terms that only one
  of them has come from cells of equal counts; a join on the term serves the terms that
  both have; the rest is one product.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pressgrain.llm.common import stored

SCALE = 1_000_000_000
MAX_ENTRIES = 600_000  # counts that a task holds; beyond it they are handed on

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# In UTF-8 a character is ASCII or made of bytes from 0x80 on.
_TERM = re.compile(rb"[a-z\x80-\xff]+")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's rows of each (lang, term): documents that hold it and its count in each source."""
    counts: dict[tuple, Counter] = {}
    holders: dict[str, Counter] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for lang, held in holders.items():
            number = dict(zip(held, range(len(held))))
            groups = [(source, terms) for (of, source), terms in counts.items() if of == lang]
            term = np.concatenate([np.fromiter(map(number.__getitem__, t), np.int64, len(t)) for _, t in groups])
            times = np.concatenate([np.fromiter(t.values(), np.int64, len(t)) for _, t in groups])
            source = np.repeat(np.arange(len(groups)), [len(t) for _, t in groups])
            order = np.argsort(term, kind="stable")  # a term's sources one after the other
            names, docs = list(held), np.fromiter(held.values(), np.int64, len(held))
            sources = pa.array([s for s, _ in groups], pa.string()).take(pa.array(source[order]))
            times, stop = pa.array(times[order]), np.cumsum(np.bincount(term, minlength=len(names)))
            for at in range(0, len(names), 1 << 15):
                end = min(len(names), at + (1 << 15))
                low = int(stop[at - 1]) if at else 0
                offsets = pa.array(np.concatenate([[low], stop[at:end]]) - low, pa.int32())
                size = int(stop[end - 1]) - low
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * (end - at), pa.string()),
                        pa.array(names[at:end], pa.binary()).cast(pa.string()),
                        pa.array(docs[at:end]),
                        pa.ListArray.from_arrays(offsets, sources.slice(low, size)),
                        pa.ListArray.from_arrays(offsets, times.slice(low, size)),
                    ],
                    names=["lang", "term", "docs", "sources", "times"],
                )
        counts.clear()
        holders.clear()

    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, batch.column(2).to_pylist()):
            terms = _TERM.findall(text.translate(_LOWER))
            counts.setdefault((lang, source), Counter()).update(terms)
            holders.setdefault(lang, Counter()).update(set(terms))
        if sum(map(len, counts.values())) > MAX_ENTRIES:
            yield from out()
    yield from out()


def term_counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """Rows (lang, term, source, n, lang_n) of the terms that at least ``min_docs`` documents of a language hold.

    ``n`` counts a term in a source, ``lang_n`` in its whole language.  Reads ``text``,
    ``lang`` and ``source``; nulls are empty strings.  One shuffle: a task hands on one
    row for each of its terms, and everything about a term meets in one place.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(empty("lang").alias("lang"), empty("source").alias("source"), empty("text").cast("binary").alias("text"))
    schema = "lang string, term string, docs long, sources array<string>, times array<long>"
    at = Window.partitionBy("lang", "term")
    kept = rows.mapInArrow(_counted, schema).withColumn("held", F.sum("docs").over(at)).where(F.col("held") >= min_docs)
    own = (
        kept.select("lang", "term", F.inline(F.arrays_zip("sources", "times")))
        .groupBy("lang", "term", F.col("sources").alias("source")).agg(F.sum("times").alias("n"))
    )
    return own.withColumn("lang_n", F.sum("n").over(at))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10**9 * (count + 2) / (total + 2 * terms)), exact at any count."""
    whole = lambda c: c.cast("decimal(19,0)")
    above = whole(count + 2) * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", above, whole(total + 2 * terms)) + 1


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / (p + q)) of shares, which lie below 2**31."""
    return F.call_function("div", (p - q) * (p - q), p + q)


class Audit:
    """The counts of a corpus, written once: ``counts``, ``groups`` and ``langs``.  Runs jobs.

    ``counts``: lang, source, term, n, lang_n, p, q of kept terms with n > 0;
    ``groups``: lang, source, total, terms (V), own (kept terms with n > 0), zero (the
    share of a kept term that does not occur), one row for each group.
    """

    def __init__(self, docs: DataFrame, min_docs: int = 10):
        own = stored(term_counts(docs, min_docs))
        empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
        totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
        terms = own.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
        langs = terms.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("terms"))
        groups = (
            docs.select(empty("lang"), empty("source")).distinct()
            .join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
        )
        # without kept terms there is nothing to divide by
        zero = F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms")))
        self.groups = stored(groups.withColumn("zero", zero))
        with_totals = own.join(self.groups, ["lang", "source"])
        self.counts = stored(
            with_totals.select(
                "lang", "source", "term", "n", "lang_n",
                share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
                share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q"),
            )
        )

    def distinctive_terms(self, ranks: int = 10) -> DataFrame:
        """Rows (lang, source, item, value, rank): terms more frequent in a group than in its language.

        From the most divergent on, ties in UTF-8 order, at most ``ranks`` of a group.
        """
        group = ["lang", "source"]
        more = self.counts.where(F.col("p") > F.col("q"))
        cells = (
            more.groupBy(*group, "n", "lang_n", "p", "q").agg(F.count("*").alias("times"))
            .withColumn("value", divergence(F.col("p"), F.col("q")))
        )
        values = cells.groupBy(*group, "value").agg(F.sum("times").alias("times"))
        down = Window.partitionBy(*group).orderBy(F.col("value").desc())
        # every value holds a term, so the first `ranks` values are enough
        first = values.withColumn("place", F.row_number().over(down)).where(F.col("place") <= ranks)
        before = F.sum("times").over(down) - F.col("times")
        reached = first.withColumn("before", before).where(F.col("before") < ranks).select(*group, "value", "before")
        terms = more.withColumn("value", divergence(F.col("p"), F.col("q"))).join(reached, [*group, "value"])
        order = Window.partitionBy(*group).orderBy(F.col("value").desc(), F.col("term"))
        return (
            terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
            .select(*group, F.col("term").alias("item"), "value", "rank")
        )

    def source_distances(self) -> DataFrame:
        """Rows (lang, source, item, value, rank): every other source of the language by its distance.

        The sum of f over all kept terms, the same in both directions.
        """
        f = divergence
        g = self.groups
        left = g.select("lang", F.col("source").alias("a"), F.col("own").alias("own_a"), F.col("zero").alias("zero_a"), "terms")
        right = g.select("lang", F.col("source").alias("b"), F.col("own").alias("own_b"), F.col("zero").alias("zero_b"))
        pairs = left.join(right, "lang").where(F.col("a") != F.col("b"))

        zeros = g.select("lang", "source", "zero")
        rows = self.counts.join(zeros, ["lang", "source"])
        x = rows.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("zero").alias("za"))
        y = rows.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("zero").alias("zb"))
        pa_, pb, za, zb = (F.col(c) for c in ("pa", "pb", "za", "zb"))
        both = (
            x.join(y, ["lang", "term"]).where(F.col("a") < F.col("b"))
            .groupBy("lang", "a", "b")
            .agg(F.sum(f(pa_, pb) - f(pa_, zb) - f(za, pb) + f(za, zb)).alias("both"))
        )
        both = both.unionByName(both.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "both"))

        cells = self.counts.groupBy("lang", "source", "n", "p").agg(F.count("*").alias("times"))
        alone = (
            cells.select("lang", F.col("source").alias("a"), "p", "times").join(right, "lang").where(F.col("a") != F.col("b"))
            .groupBy("lang", "a", "b").agg(F.sum(F.col("times") * f(F.col("p"), F.col("zero_b"))).alias("alone_a"))
        )
        turned = alone.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("alone_a").alias("alone_b"))
        at = ["lang", "a", "b"]
        rest = (F.col("terms") - F.col("own_a") - F.col("own_b")) * f(F.col("zero_a"), F.col("zero_b"))
        none = lambda c: F.coalesce(c, F.lit(0).cast("long"))
        value = none(F.col("both")) + none(F.col("alone_a")) + none(F.col("alone_b")) + none(rest)
        sums = pairs.join(both, at, "left").join(alone, at, "left").join(turned, at, "left")
        order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
        return (
            sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), value.alias("value"))
            .withColumn("rank", F.row_number().over(order))
        )


def audit(docs: DataFrame, min_docs: int = 10, ranks: int = 10) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): ``pair`` of ``source_distances``, ``term`` of ``distinctive_terms``.

    Null texts, languages and sources are empty strings; repeated rows count as often
    as they occur; a language without kept terms has pairs of value 0 and no terms; an
    empty table gives no rows; other columns are not read.  Runs jobs.
    """
    made = Audit(docs, min_docs)
    part = lambda df, name: df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
    return part(made.source_distances(), "pair").unionByName(part(made.distinctive_terms(ranks), "term"))


AUDIT_SQL = r"""
    WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
               FROM documents),
    w AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    k AS (SELECT lang, term, count(*)::HUGEINT AS ln FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
    l AS (SELECT lang, sum(ln)::HUGEINT AS total, count(*)::HUGEINT AS v FROM k GROUP BY lang),
    g AS (SELECT DISTINCT lang, source FROM d),
    c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
    t AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY ALL),
    s AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(t.total, 0) + 2 * l.v) AS p,
                 1 + 1000000000::HUGEINT * (k.ln + 2) // (l.total + 2 * l.v) AS q
          FROM g JOIN k USING (lang) JOIN l USING (lang)
          LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
          LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
          FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
              FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
    terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
              FROM s WHERE n > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
               FROM (FROM pairs UNION ALL FROM terms))
    SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
