import random
from collections import defaultdict

import numpy as np
import pytest

from pressgrain.llm import paragraphs as P


def windows_by_hand(words):
    """Places of the windows: the lowest run of five words among every 24 places."""
    runs = P.run_hashes(np.array([P._SEEN[w.encode()] for w in words], dtype=np.uint64), 5).tolist()
    places = {i + k for i in range(len(runs) - 23) for k in range(24) if runs[i + k] == min(runs[i : i + 24])}
    return [p for p in sorted(places) if p + 26 <= len(words) and (p == 0 or runs[p] != runs[p - 1])]


def units_by_hand(text):
    """(start, end, words, whether a paragraph) of units of five or more words."""
    out, at = [], 0
    whole = (text or "").lower().split()
    for line in (text or "").lower().split("\n"):
        words = line.split()
        if not words:
            continue
        cuts, begin, sentence = [], 0, 0
        for i, w in enumerate(words, 1):
            if w.endswith((".", "!", "?")) or i == len(words):
                if i - sentence >= 5 or i == len(words):
                    cuts.append((begin, i))
                    begin = i
                sentence = i
        out.append((at, at + len(words), tuple(words), True))
        if len(cuts) > 1:
            out += [(at + a, at + b, tuple(words[a:b]), False) for a, b in cuts]
        at += len(words)
    out = [u for u in out if u[1] - u[0] >= 5]
    taken = {u[:2] for u in out}
    return out + [(p, p + 26, tuple(whole[p : p + 26]), False) for p in windows_by_hand(whole) if (p, p + 26) not in taken]


def grams(words):
    return {words[i : i + 5] for i in range(max(1, len(words) - 4))}


def brute(rows, least, gap):
    occurrences = {(d, *u) for d, t in rows if d is not None for u in units_by_hand(t)}
    paragraphs = sorted({u[3] for u in occurrences if u[4]})
    root = {u[3]: u[3] for u in occurrences}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(paragraphs):
        for b in paragraphs[i + 1 :]:
            x, y = grams(a), grams(b)
            if len(x & y) >= 0.8 * len(x | y):
                root[find(a)] = find(b)
    holders = defaultdict(set)
    for d, _, _, words, _ in occurrences:
        holders[find(words)].add(d)
    by_doc = defaultdict(list)
    for d, lo, hi, words, _ in occurrences:
        if len(holders[find(words)]) > 1:
            by_doc[d].append((lo, hi, min(holders[find(words)])))
    out = []
    for d, found in by_doc.items():
        covered = sorted({w for lo, hi, _ in found for w in range(lo, hi)})
        removed = {w for lo, hi, f in found if f < d for w in range(lo, hi)}
        runs = []
        for w in covered:
            if runs and w <= runs[-1][-1] + 1 + gap:
                runs[-1].append(w)
            else:
                runs.append([w])
        for r in runs:
            lo, hi = r[0], r[-1] + 1
            if hi - lo >= least:
                first = min(f for a, _, f in found if lo <= a < hi)
                out.append((d, lo, hi - lo, sum(lo <= w < hi for w in removed), first))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)]

    def sentence():
        return " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 14))) + rng.choice([".", "!", "", '?'])

    def line():
        return " ".join(sentence() for _ in range(rng.randint(1, 5)))

    shared = [line() for _ in range(8)]
    rows = []
    for d in range(50):
        parts = [line() for _ in range(rng.randint(0, 4))]
        for _ in range(rng.randint(0, 2)):
            words = rng.choice(shared).split(" ")
            if rng.random() < 0.6:  # a near copy
                words[rng.choice([0, -1, rng.randrange(len(words))])] = rng.choice(vocabulary)
            words = " ".join(words).upper() if rng.random() < 0.2 else " ".join(words)
            parts.insert(rng.randint(0, len(parts)), rng.choice([words, sentence() + " " + words + " " + sentence()]))
        rows.append((d, rng.choice(["\n", "\n\n", "\n \t"]).join(parts)))
    rows += [(100 + k, rows[3][1]) for k in range(5)] + [(200, None), (201, ""), (None, rows[3][1]), (3, rows[3][1])]
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, key int, unit int").repartition(5)
    got = sorted(tuple(r) for r in P.repeated_passages(docs, least_words=12).collect())
    assert got == brute(rows, 12, 4)
    assert got


def test_passages_with_any_borders_are_found(spark):
    """Against all windows of 50 words in plain Python, not against the operator's own units."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(3000)]

    def prose(n):
        out = [rng.choice(vocabulary) + rng.choice(["", "", "", "", "", "", "", ".", ",", "!"]) for _ in range(n)]
        return [w + rng.choice(["", "", "", "", "", "", "", "", "\n"]) for w in out]

    shared = [prose(rng.choice([50, 51, 60, 90, 300])) for _ in range(25)]
    texts = []
    for d in range(120):
        parts = [prose(rng.randint(0, 150))]
        for s in rng.sample(shared, rng.randint(0, 2)):
            parts += [s, prose(rng.randint(0, 150))]
        texts.append(" ".join(w for p in parts for w in p))
    found = {}
    for r in P.repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        found.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["start_word"] + r["n_words"]))
    holders = defaultdict(set)
    split = [t.lower().split() for t in texts]
    for d, words in enumerate(split):
        for i in range(len(words) - 49):
            holders[tuple(words[i : i + 50])].add(d)
    wanted, covered = 0, 0
    for d, words in enumerate(split):
        for i in range(len(words) - 49):
            if len(holders[tuple(words[i : i + 50])]) > 1:
                wanted += 1
                covered += len(found.get(d, set()) & set(range(i, i + 50))) >= 25
    assert wanted > 1000 and covered >= 0.95 * wanted


def test_long_lines_and_one_repeated_word(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, long), (2, "x y " + long), (3, "same " * 20_000), (4, "same " * 5_000 + "end")]
    got = sorted(tuple(r) for r in P.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    by = {d: sum(r[2] for r in got if r[0] == d) for d in (1, 2, 3, 4)}
    assert by[1] > 29_900 and by[2] > 29_900 and by[3] >= 26 and by[4] >= 26


def test_large_buckets_are_compared_in_blocks(spark):
    rng = random.Random(7)
    base = [f"w{i}" for i in range(80)]
    texts = []
    for k in range(60):
        words = list(base)
        words[rng.randrange(80)] = f"x{k}"
        texts.append((k, " ".join(words)))
    texts += [(100 + k, " ".join(f"y{k}_{i}" for i in range(30))) for k in range(10)]
    bands = spark.createDataFrame([(1, u) for u, _ in texts], "key long, unit long")
    words = spark.createDataFrame(texts, "unit long, words string")
    from pressgrain.llm.components import connected_components

    for block in (7, 1000):
        links = P.similar_paragraphs(bands, words, 0.8, block)
        rows = links.collect()
        sets = {u: P.shingle_set(w) for u, w in texts}
        assert all(P.similar(sets[a], sets[b], 0.8) for a, b in rows)
        got = {r[0]: r[1] for r in connected_components(links).collect()}
        want = {}
        group = {u: u for u in sets}
        for _ in range(60):
            for a in sets:
                for b in sets:
                    if P.similar(sets[a], sets[b], 0.8):
                        group[a] = group[b] = min(group[a], group[b])
        want = {u: g for u, g in group.items() if list(group.values()).count(g) > 1}
        assert got == want
        assert len(rows) < 60 * (1 + 60 // block)


def test_empty(spark):
    docs = spark.createDataFrame([(1, "only one short text here")], "doc_id long, text string")
    assert P.repeated_passages(docs).count() == 0
    assert P.repeated_passages(docs.limit(0)).count() == 0
