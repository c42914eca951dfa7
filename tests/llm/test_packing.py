import random
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pressgrain.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, got, window):
    """Exact round trip: the pieces, put together, are the documents' ids; sequences have no gaps."""
    import numpy as np

    tok = Tokenizer.from_file(PATH)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    want = defaultdict(list)
    for d, t in rows:
        want[d].append(tok.encode(t or "", add_special_tokens=False).ids + [1])
    assert set(by_doc) == set(want)
    for d, copies in want.items():
        expected = sorted(
            (s, len(ids[s : s + window]), zlib.crc32(np.array(ids[s : s + window], dtype="<u4").tobytes()), len(ids))
            for ids in copies for s in range(0, len(ids), window)
        )
        assert sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in by_doc[d]) == expected
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window
    return sum(r["length"] for r in got) / (len(by_seq) * window)


def test_round_trip(spark):
    rng = random.Random(1)
    words = ["The", "thʼs", "don't", "42", "É", "é", "a###", "ﬁne", "x y", "<|endoftext|>", "日本", "!!", "\x1c"]
    rows = [(i, " \n\t".join(rng.choice(words) for _ in range(rng.randint(0, 400)))) for i in range(80)]
    rows += [(3, "again"), (5, rows[5][1]), (5, rows[5][1]), (None, "no id"), (900, None), (901, ""), (902, "  ")]
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, rank int, length int")
    for window in (64, 2048):
        got = packing.pack(docs, PATH, window).collect()
        assert check(rows, got, window) > 0.8 or window == 2048
    assert packing.pack(docs.limit(0), PATH).count() == 0


def test_whole_table_has_little_padding(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert check(rows, packing.pack(docs, PATH).collect(), 2048) > 0.98


@pytest.mark.parametrize("seed", range(5))
def test_plan_uses_every_piece_once(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 2048): rng.randint(1, 10 ** rng.randint(0, 5)) for _ in range(rng.choice([1, 30, 900]))}
    made = packing.plan(dict(counts))
    ends = {}
    total = 0
    for i, (length, first) in enumerate(zip(made.length.tolist(), made.first_rank.tolist())):
        nxt = made.first_rank[i + 1] if i + 1 < len(made.length) and made.length[i + 1] == length else counts[length]
        assert first == ends.get(length, 0) and nxt > first
        ends[length] = int(nxt)
        total += (int(nxt) - first) * length
    assert ends == counts
    assert total <= made.sequences * 2048


def test_least_squares_finds_counts():
    import numpy as np

    combos = [(6, 2), (5, 3), (4, 4), (4, 2, 2)]
    truth = np.array([10.0, 4.0, 7.0, 3.0])
    h = np.zeros(9)
    for c, x in zip(combos, truth):
        for length in c:
            h[length] += x
    found = packing.least_squares(h, combos, rounds=3000)
    assert np.allclose(found, truth, atol=0.05)
