import random
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from pressgrain.llm import divergence as D
from tests.conftest import rows

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n long, p double, term string"


def by_hand(docs, min_docs, ranks):
    """Every term of every group, one by one."""
    docs = [(t or "", l or "", s or "") for t, l, s in docs]
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    found = [(TERM.findall(lower(t)), l, s) for t, l, s in docs]
    out = []
    for lang in {l for _, l, _ in found}:
        mine = [(w, s) for w, l, s in found if l == lang]
        holders = Counter(x for w, _ in mine for x in set(w))
        kept = {x for x, n in holders.items() if n >= min_docs}
        v = len(kept)
        whole = Counter(x for w, _ in mine for x in w if x in kept)
        by = {s: Counter() for _, s in mine}
        for w, s in mine:
            by[s].update(x for x in w if x in kept)

        def share(counts, x):
            return 1 + 10**9 * (counts[x] + 2) // (sum(counts.values()) + 2 * v)

        f = lambda p, q: (p - q) ** 2 // (p + q)
        for s, counts in by.items():
            pairs = [(o, sum(f(share(counts, x), share(c, x)) for x in kept)) for o, c in by.items() if o != s]
            terms = [(x, f(share(counts, x), share(whole, x))) for x in kept if counts[x] and share(counts, x) > share(whole, x)]
            for part, items, most in (("pair", pairs, None), ("term", terms, ranks)):
                items.sort(key=lambda i: (-i[1], i[0].encode()))
                out += [(lang, s, part, i, value, k + 1) for k, (i, value) in enumerate(items[:most])]
    return sorted(out, key=str)


def made_up(n=300):
    rng = random.Random(3)
    words = [f"{a}{b}" for a in ("ab", "É", "zz", "ß", "𝒳", "Q") for b in "abcdefgh"] + ["und", "the"] * 8
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 12, 60]))) for _ in range(n)]
    groups = [("en", "a"), ("en", "a"), ("en", "b"), ("en", ""), ("de", "a"), ("de", "é"), ("", "x"), ("xx", "y")]
    rows = [(t, *rng.choice(groups)) for t in texts]
    rows += [(None, "en", "empty"), ("", None, None), ("the " * 20000, "en", "b"), ("1 2 _ @[`{", "en", "a"), ("once", "yy", "lone"), ("once", "yy", "two")]
    return rows + rows[:40]


def frame(spark, docs):
    # further columns, some with names that the operator uses itself
    return spark.createDataFrame([(i, t, l, s, 7, 0.5, "x") for i, (t, l, s) in enumerate(docs)], SCHEMA)


def test_rows_match_brute_force(spark):
    docs = made_up()
    got = rows(D.audit(frame(spark, docs).repartition(7), min_docs=10, ranks=10))
    assert got == by_hand(docs, 10, 10)
    values = Counter((r[0], r[1], r[4]) for r in got if r[2] == "term")
    assert max(values.values()) > 1  # equal values were ordered by their terms


def test_ranks_reach_into_ties(spark):
    docs = [("a b c d e f g h i j k l m n o p", "en", s) for s in ("x", "y") for _ in range(6)] + [("q r s", "en", "z")] * 10
    for ranks in (1, 3, 12):
        assert rows(D.audit(frame(spark, docs), min_docs=10, ranks=ranks)) == by_hand(docs, 10, ranks)


def test_sql_says_the_same(spark):
    docs = made_up(150)
    con = duckdb.connect()
    con.register("documents", frame(spark, docs).toArrow())
    assert sorted(con.sql(D.AUDIT_SQL).fetchall(), key=str) == rows(D.audit(frame(spark, docs)))


def test_counts_handed_on_in_parts(spark, monkeypatch):
    docs = made_up(60)
    monkeypatch.setattr(D, "MAX_ENTRIES", 5)
    batches = frame(spark, docs).select("lang", "source", F.col("text").cast("binary")).na.fill("").toArrow().to_batches(10)
    total = Counter()
    for b in D._counted(iter([b.set_column(2, "text", b.column(2).fill_null(b"")) for b in batches])):
        for r in b.to_pylist():
            assert len(r["sources"]) == len(set(r["sources"])) == len(r["times"]) and r["docs"] > 0
            total.update({(r["lang"], s, r["term"]): n for s, n in zip(r["sources"], r["times"])})
    assert sum(total.values()) == sum(len(TERM.findall(t or "")) for t, _, _ in docs)


def test_empty_and_without_kept_terms(spark):
    assert rows(D.audit(frame(spark, []))) == []
    assert rows(D.audit(frame(spark, [("a b", "en", "x"), (None, "en", "y")]))) == [
        ("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)
    ]


def test_shares_are_exact_at_any_count(spark):
    big = 9_000_000_000_000_000
    got = spark.createDataFrame([(big, big + 5, 3)], "c long, n long, v long").select(D.share(F.col("c"), F.col("n"), F.col("v"))).first()[0]
    assert got == 1 + 10**9 * (big + 2) // (big + 5 + 6)
