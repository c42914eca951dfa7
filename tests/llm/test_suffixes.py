import random
from collections import defaultdict

import numpy as np
import pytest

from pressgrain.llm import suffixes as S


def brute(rows, size):
    docs = defaultdict(set)
    texts = [(d, (t or "").encode().split()) for d, t in rows if d is not None]
    for d, words in texts:
        for i in range(len(words) - size + 1):
            docs[tuple(words[i : i + size])].add(d)
    starts = {
        (d, i, min(docs[w]))
        for d, words in texts for i in range(len(words) - size + 1)
        if len(docs[w := tuple(words[i : i + size])]) > 1
    }
    out = set()
    for d, i, f in starts:
        if (d, i - 1, f) not in starts:
            n = 0
            while (d, i + n, f) in starts:
                n += 1
            out.add((d, i, n + size - 1, f))
    return sorted(out)


@pytest.mark.parametrize("size, head", [(12, 4), (50, 16)])
def test_matches_all_windows(spark, size, head):
    rng = random.Random(size)
    vocabulary = [f"w{i}" for i in range(300)]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    shared = [make(rng.randint(size, 3 * size)) for _ in range(6)]
    rows = []
    for d in range(60):
        words = make(rng.randint(0, 3 * size))
        for _ in range(rng.randint(0, 2)):
            at = rng.randint(0, len(words))
            part = shared[rng.randrange(6)]
            lo = rng.randint(0, len(part) - size)
            words[at:at] = part[lo : lo + rng.randint(size - 3, len(part))]
        rows.append((d, rng.choice([" ", "\n", "\t "]).join(words)))
    rows += [(100 + d, rows[7][1]) for d in range(30)]  # copies
    rows += [(200, "a " * 300), (201, "b a " * 200), (202, "a " * 250), (203, None), (204, ""), (None, rows[7][1])]
    rows += [(300, " ".join(make(200)))] * 2  # one document in two rows
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, place int")
    docs = docs.repartition(7)
    got = sorted(tuple(r) for r in S.repeated_spans(docs, size, head).collect())
    # the order of several spans that begin at one place is their first document's
    assert [g for g in got] == [(d, i, n, f) for d, i, n, f in brute(rows, size)]
    assert not [g for g in got if g[0] == 300]


def test_empty(spark):
    docs = spark.createDataFrame([(1, "short")], "doc_id long, text string")
    assert S.repeated_spans(docs).count() == 0
    assert S.repeated_spans(docs.limit(0)).count() == 0


def test_minimisers_cover_every_window():
    rng = np.random.default_rng(1)
    for n in (0, 3, 34, 35, 36, 400):
        heads = rng.integers(0, 50, n).astype(np.uint64)
        at = set(S.minimisers(heads, 35).tolist())
        want = {
            s + j for s in range(n - 34) for j in range(35) if heads[s + j] == heads[s : s + 35].min()
        }
        assert at == want
        assert S.sliding(heads, 35).tolist() == [heads[s : s + 35].min() for s in range(n - 34)]


def test_neighbours_over_batches():
    import pyarrow as pa

    rng = random.Random(3)
    for _ in range(200):
        keys = sorted(rng.randint(0, 8) for _ in range(rng.randint(1, 12)))
        batches, i = [], 0
        while i < len(keys):
            j = min(len(keys), i + rng.randint(1, 4))
            part = keys[i:j]
            batches.append(pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int64()), pa.array([*range(i, j)], pa.int64()), pa.array([0] * len(part), pa.int32())],
                names=["key", "doc_id", "place"]))
            i = j
        rows = [tuple(r.values()) for b in S._neighbours(iter(batches)) for r in b.to_pylist()]
        assert {r[1] for r in rows if r[3]} == {i for i, k in enumerate(keys) if keys.count(k) > 1}
        assert {r[1] for r in rows if r[4]} == {0, len(keys) - 1}
