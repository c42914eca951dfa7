import hashlib
import random
import re

from pyspark.sql import functions as F

from pressgrain.llm import merkle as M


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def by_hand(text):
    """The tree built node by node; the fingerprint and the leaves."""
    leaves, text, at = [], text or "", 0
    while at < len(text):
        end = at
        stops = lambda e: e >= len(text) or text[e] in ".!?\n"
        if not stops(at):
            while not stops(end) and end - at < 40:
                end += 1
            for e in range(end, min(len(text), end + 119)):  # where the content says so, or else 120 characters on
                if any(stops(x) for x in range(end, e)):
                    break
                if text[e] in "qxzQXZ79":
                    end = e + 1
                    break
                if text[e] in "aehlosAEHLOS,;:" and text[e + 1 : e + 2] in (" ", "\t"):
                    end = e + 2
                    break
            else:
                e = None
            if e is None or not (end - at > 40 and (text[end - 1] in "qxzQXZ79 \t")):
                end = at
                while not stops(end) and end - at < 160:
                    end += 1
        while end < len(text) and text[end] in ".!?\n":
            end += 1
        leaves.append(text[at:end])
        at = end
    sections, short = [[[]]], ""
    for leaf in leaves:
        h = md5(leaf)
        sections[-1][-1].append(h)
        if "\n" in leaf:
            closes = h[0] in "0123"
            short += h[:8] + ("." if closes else ",")
            sections.append([[]]) if closes else sections[-1].append([])
        else:
            short += h[:8] + "-"
    paragraph = lambda p: md5("".join(h + "-" for h in p[:-1]) + (p[-1] if p else ""))
    parts = []
    for s in sections:
        # a leaf that ends its paragraph has no mark of its own there
        rows = []
        for k, p in enumerate(s):
            closed = k < len(s) - 1 or s is not sections[-1]
            rows.append(paragraph(p) if closed and p else md5("".join(h + "-" for h in p)))
        parts.append(md5(",".join(rows)))
    return md5(".".join(parts)) + ":" + short, [md5(x)[:8] for x in leaves]


def dice(a, b):
    if by_hand(a)[0] == by_hand(b)[0]:
        return 1.0
    x, y = set(by_hand(a)[1]), set(by_hand(b)[1])
    return 2 * len(x & y) / (len(x) + len(y))


def test_rows_match_brute_force(spark):
    rng = random.Random(4)
    bits = ["word ", "é", "𝒳", ". ", "!", "\n", "\n\n", "long " * 30, "x", "?", "\r", " "]
    rows = [(i * 7, "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))) for i in range(80)]
    rows += [(10_000, None), (10_001, ""), (10_002, ". " * 5000), (-3, rows[5][1]), (None, "no id at all.\n")]
    docs = spark.createDataFrame([(d, t, "f", 3) for d, t in rows], "doc_id long, text string, fingerprint string, _k int")
    got = {r["doc_id"]: r for r in M.compare_with_edits(docs.repartition(6)).collect()}
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for (d, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        third = len(t) // 3
        edited = t[: len(t) - third] + after[:third]
        r = got[d]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == by_hand(t)[0]
        assert r["edited_fingerprint"] == by_hand(edited)[0]
        assert abs(r["near_edited"] - dice(t, edited)) < 1e-12 and abs(r["near_next"] - dice(t, after)) < 1e-12


def test_one_empty_and_repeated(spark):
    docs = spark.createDataFrame([(1, "abc def. ghi")], "doc_id long, text string")
    (one,) = M.compare_with_edits(docs).collect()
    assert one["near_next"] == 1.0
    assert M.compare_with_edits(docs.limit(0)).count() == 0
    again = M.compare_with_edits(docs.union(docs)).collect()
    assert len(again) == 2 and again[0] == again[1] == one


def test_next_row_over_uneven_keys(spark):
    rng = random.Random(5)
    keys = [rng.choice([k, k * k * k, -k]) for k in range(300)]
    df = spark.createDataFrame([(k, str(k)) for k in keys], "doc_id long, v string")
    for parts in (1, 2, 50, 1000):
        got = sorted((int(r["v"]), int(r["next_v"])) for r in M.with_next(df, ["v"], parts=parts).collect())
        down = sorted(keys, reverse=True)
        assert got == sorted(zip(down, down[1:] + down[:1]))


def test_edits_are_located(spark):
    parts = [f"Section {i} begins here.\nIt has a second line {i}.\n" for i in range(40)]
    changed = list(parts)
    changed[20] = "Something else stands here.\n"
    df = spark.createDataFrame([("".join(parts), "".join(changed))], "a string, b string")
    df = M.with_fingerprint(M.with_fingerprint(df, "a", "x"), "b", "y")
    found = df.select(M.changed_sections(F.col("x"), F.col("y")), F.size(F.split("x", "[.]")), M.changed_sections(F.col("x"), F.col("x"))).first()
    assert 1 <= len(found[0]) <= 2 and found[1] > 8 and found[2] == []


def test_only_spark_functions(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = M.compare_with_edits(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_leaves_follow_the_content():
    """One character put before a text without sentence ends changes the leaves near it only."""
    rng = random.Random(8)
    words = ["value", "index", "then", "items", "of", "list", "code", "data", "zone", "8", "x7", "next"]
    pattern = re.compile(M.LEAF)
    for sign in (" ", "_", ""):
        text = sign.join(rng.choice(words) for _ in range(900))
        one, two = pattern.findall(text), pattern.findall("#" + text)
        assert "".join(one) == text and len(one) > 20
        assert len(set(one) & set(two)) >= 0.9 * len(set(one))


def test_the_plan_does_not_grow_with_the_ranges(spark):
    df = spark.createDataFrame([(i * 7919 % 20_011, str(i)) for i in range(20_000)], "doc_id long, v string")
    size = lambda parts: M.with_next(df, ["v"], parts=parts)._jdf.queryExecution().analyzed().toString().count("#")
    assert size(8000) == size(10)
    import time

    start = time.time()
    assert M.with_next(df, ["v"], parts=10_000).count() == 20_000
    assert time.time() - start < 60
