import random

import pytest
import xxhash
from pyspark.sql import functions as F

from pressgrain.llm import simhash
from pressgrain.llm.components import connected_components


def brute(rows, size, distance):
    def fp(text):
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words, word = [], ""
        for c in text + " ":
            if c in " \t\n\x0b\x0c\r":
                words += [word] if word else []
                word = ""
            else:
                word += c
        grams = [words[i : i + size] for i in range(len(words) - size + 1)] or ([words] if words else [])
        hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))

    prints = [fp(t) for _, t in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= distance:
                    group[i] = group[j] = min(group[i], group[j])
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        out.append((d, f"{prints[i]:016x}", min(ids, default=None)))
    return sorted(out, key=str)


def test_groups_match_brute_force(spark):
    rng = random.Random(3)
    words = ["alpha", "Beta", "ünder", "x", "y2", "THE", "of", "and,"]
    rows = []
    for i in range(60):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))
        rows.append((i, text))
        if i % 4 == 0:
            copy = text.split(" ")
            copy[rng.randrange(len(copy))] = "changed"
            rows.append((100 + i, "\t".join(copy)))
    rows += [(7, rows[7][1]), (900, None), (901, ""), (None, "a b"), (None, rows[3][1]), (902, " \n ")]
    docs = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], "doc_id long, text string, bits string, a string")
    got = simhash.near_copies(docs, 4, 4).select("doc_id", simhash.hex16(), "component_id")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 4, 4)


@pytest.mark.parametrize("distance", [1, 3, 4, 7])
def test_pairs_lose_no_link(spark, distance):
    rng = random.Random(distance)
    values = [rng.getrandbits(64) for _ in range(40)]
    for v in list(values):
        for _ in range(3):
            x = v
            for b in rng.sample(range(64), rng.randint(1, distance + 2)):
                x ^= 1 << b
            values.append(x)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    got = simhash.near_pairs(spark.createDataFrame([(v,) for v in signed], "bits long"), distance)
    want = {
        (a, b) for a in signed for b in signed
        if a < b and 0 < ((a ^ b) & ((1 << 64) - 1)).bit_count() <= distance
    }
    assert {tuple(r) for r in got.collect()} == want


def test_spark_hash_agrees(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("ab cé d e"))).first()[0]
    assert got & ((1 << 64) - 1) == xxhash.xxh64_intdigest("ab cé d e", 42)


def test_keep_one(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e"), (2, "a b c d e"), (3, "z y x w v u"), (None, "a b c d e"), (1, "a b c d e")],
        "doc_id long, text string",
    )
    assert sorted((r[0] or 0) for r in simhash.keep_one(docs).collect()) == [0, 1, 1, 3]
    assert simhash.keep_one(docs.limit(0)).count() == 0


def test_components(spark):
    chain = [(i + 1, i) for i in range(50)] + [(100, 101), (101, 100), (5, 5), (None, 3)]
    hub = [(200, x) for x in range(201, 260)]
    got = connected_components(spark.createDataFrame(chain + hub, "a long, b long"))
    want = {i: 0 for i in range(51)} | {100: 100, 101: 100} | {x: 200 for x in range(200, 260)}
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.items())
    empty = spark.createDataFrame([], "a long, b long")
    assert connected_components(empty).count() == 0


def test_links_connect_what_pairs_connect(spark):
    rng = random.Random(12)
    values = set()
    for _ in range(25):  # chains of values, each near the one before
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            values.add(v)
            for b in rng.sample(range(64), rng.randint(1, 4)):
                v ^= 1 << b
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "bits long")
    links = simhash.near_links(df, 4)
    assert all((((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4) for a, b in links.collect())
    roots = lambda x: sorted(map(tuple, connected_components(x).collect()))
    assert roots(links) == roots(simhash.near_pairs(df, 4))


def test_a_dense_group_gives_few_links(spark):
    rng = random.Random(13)
    base = rng.getrandbits(62)
    values = {base} | {base ^ 1 << i ^ 1 << j for i in range(62) for j in range(i)}
    df = spark.createDataFrame([(v,) for v in values], "bits long")
    links = simhash.near_links(df, 4)
    assert links.count() < 1.2 * len(values)  # all pairs: over a million
    assert {r["root"] for r in connected_components(links).collect()} == {min(values)}
