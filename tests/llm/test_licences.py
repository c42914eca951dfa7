import random
import re

import pytest

from pressgrain.llm import licences as L


def by_hand(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in L.BASE.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_matches_a_plain_scan(spark):
    rng = random.Random(5)
    bits = ["MIT", "license", "License", "apache", "General", "public", "é", "X", "-", ".", "\n", " ", "mit license", "ſ", "0"]
    rows = [(i, "".join(rng.choice(bits) + rng.choice(["", " ", ", "]) for _ in range(rng.randint(0, 40)))) for i in range(300)]
    rows += [(900, None), (901, ""), (None, "MIT License"), (902, "w " * 100_000 + "apache-license"), (5, "mit license mit license")]
    docs = spark.createDataFrame([(d, t, "q") for d, t in rows], "doc_id long, text string, labels string")
    got = [tuple(r)[:6] for r in L.scan(docs).collect()]
    assert sorted(got, key=str) == sorted(((d, *by_hand(t)) for d, t in rows), key=str)
    assert any(r[2] for r in got)
    assert L.scan(docs.limit(0)).count() == 0


def test_base_labels_stay_in_labels(spark, sf):
    for r in L.scan(spark.read.parquet(f"{sf}/documents.parquet")).collect():
        assert set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}
        assert 0 <= r["score"] <= 1


@pytest.mark.parametrize("expression, order", [
    ("A or B and C", "A B C and or"),
    ("(A or B) and C", "A B or C and"),
    ("A with E and B or C", "A E with B and C or"),
    ("((A))", "A"),
])
def test_shunting_yard(expression, order):
    assert L.postfix(L._PART.findall(expression)) == order.split()


@pytest.mark.parametrize("expression", ["", "and", "A B", "A or", "(A", "A)", "or A", "A and and B", "()"])
def test_no_expression(expression):
    with pytest.raises(ValueError):
        L.postfix(L._PART.findall(expression))


def brute(tree):
    """Value of an expression given as nested tuples."""
    if isinstance(tree, str):
        return {L.label_of(tree)}, L.BURDEN.get(L.label_of(tree), L.UNKNOWN_BURDEN)
    op, a, b = tree
    x = brute(a)
    if op == "with":
        return x[0], x[1] / 2
    y = brute(b)
    return x[0] | y[0], (min if op == "or" else max)(x[1], y[1])


def test_evaluation_matches_a_tree():
    rng = random.Random(6)

    def tree(depth):
        if depth == 0 or rng.random() < 0.3:
            one = rng.choice(["MIT", "Apache-2.0", "GPL-3.0-only", "BSD-3-Clause", "LGPL-2.1+", "CC-BY-NC-4.0", "X-1"])
            return ("with", one, "Some-exception") if rng.random() < 0.3 else one
        return (rng.choice(["and", "or"]), tree(depth - 1), tree(depth - 1))

    def text(t):
        if isinstance(t, str):
            return t
        if t[0] == "with":
            return f"{t[1]} WITH {t[2]}"
        return f"({text(t[1])}) {t[0].upper()} ({text(t[2])})"

    for _ in range(200):
        t = tree(4)
        value = L.evaluate(text(t))
        assert (set(value.labels), value.burden) == brute(t)


def test_tags_and_notices():
    got = L.scan_text("// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0 as it says\n# spdx-license-identifier: ISC")
    assert (got["labels"], got["n_tags"], got["n_base"]) == ("apache,gpl,isc,mit", 2, 0)
    assert got["score"] == 0.15
    assert L.scan_text("Licensed under CC BY-NC 4.0.")["labels"] == "cc-by,cc-by-nc"
    assert L.scan_text("GNU Lesser General Public License")["labels"] == "gpl,lgpl"
    assert L.scan_text("SPDX-License-Identifier: )(")["labels"] == ""


def test_very_many_places_take_linear_time():
    import time

    def seconds(n):
        start = time.process_time()
        found = L.scan_text("under the mit license and the apache license or the gnu general public license " * n)
        assert (found["n_base"], found["first_word"], found["last_word"]) == (3 * n, 2, 14 * n - 3)
        return time.process_time() - start

    seconds(100)
    assert seconds(40_000) < 30 * max(seconds(4_000), 0.01)
