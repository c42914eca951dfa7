import hashlib
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pyarrow.compute as pc
import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from pressgrain.llm import alignment as A
from tests.conftest import rows

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
BITS = [
    "word", "Hello", " ", "  ", "\n", "\n\n", "\t", "\r\n", "é", "é", "𝒳", "中文", "'s", "don't", "123", "!?", "...", "<|endoftext|>",
    "<s>", "<unk>", "\xa0", " ", "\x1c", "\x0b", "ｆｕｌｌ", "ﬁ", "_", "=>", "https://x.y/z", "naïve", "Straße", "　", "\x85", "   ",
]


def made_up(n, seed=1, odd=("▁", "\x00")):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(1, 25))) for _ in range(n)]
    return texts + [t + rng.choice(odd) + "x" for t in texts[: n // 20]] + [" ", "\n", "   ", " a", "a ", "a  ", "\ta", "x" * 5000]


class Plain:
    """Whole texts through both tokenizers, groups from the sets of ends."""

    def __init__(self):
        self.a = Tokenizer.from_file(A_PATH)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
        chars = {c: b for b, c in A.byte_characters().items()}
        self.a_bytes = {i: bytes(chars[c] for c in t) for t, i in self.a.get_vocab().items() if t != "<|endoftext|>"}

    def tokens(self, text):
        if not text:
            return None
        a = [(i, self.a_bytes[i]) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()))
        data = (" " + text).encode()
        if any(b"".join(x for _, x in side) != data for side in (a, b)):
            return None

        def spans(side):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at + len(x)))
                at += len(x)
            return out

        return spans(a), spans(b)

    def groups(self, text):
        found = self.tokens(text)
        if found is None:
            return [], [], 0
        a, b = found
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, start = [], 0
        for cut in cuts:
            groups.append(([i for i, s, e in a if start <= s and e <= cut], [i for i, s, e in b if start <= s and e <= cut]))
            start = cut
        ends = {e: i for i, _, e in b}
        links = [(i, ends[e]) for i, _, e in a if e in ends]
        return groups, links, sum(s < f and t < e for _, s, e in a for _, t, f in b)


def by_hand(docs):
    plain = Plain()
    each = [(d, *plain.groups(t)) for d, t in docs]
    counts = Counter(x for _, _, links, _ in each for x in links)
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for d, groups, links, shared in each:
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append((
            d, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(text.encode()).hexdigest() if groups else "", shared,
        ))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pair():
    return A.Pair(A_PATH, B_PATH)


def test_units_give_the_tokens_of_whole_texts(pair):
    assert pair.by_units
    w = A.Worker(pair)
    texts = made_up(4000, odd=("▁", "\x00", "�", "​"))
    for text, made in zip(texts, w.documents(texts)):
        (whole,) = A.align(pair, pair.whole([text]), w.number)
        assert made == whole, repr(text)


def test_ids_are_the_tokenizers_own(pair):
    plain = Plain()
    assert pair.a.__name__ == "encode_ordinary"
    for text in made_up(6000, seed=8, odd=("▁", "\x00", "�", "​")):
        assert pair.a(" " + text) == plain.a.encode(" " + text, add_special_tokens=False).ids, repr(text)
        (found,) = A.align(pair, pair.whole([text]), {})
        groups, links, shared = plain.groups(text)
        assert (found.a, found.b, found.overlaps) == (sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), shared)
        assert found.groups.decode() == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def test_rows_match_brute_force(spark):
    docs = list(enumerate(made_up(300))) + [(7, "a word"), (7, "a word"), (None, "a word"), (9000, None), (9001, ""), (9002, "long text " * 3000)]
    schema = "doc_id long, text string, block string, n_a int"
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], schema).repartition(6)
    assert rows(A.agreement(df, A_PATH, B_PATH)) == by_hand(docs)
    assert rows(A.agreement(df.limit(0), A_PATH, B_PATH)) == []


def test_small_blocks_give_the_same(spark, monkeypatch):
    docs = list(enumerate(made_up(600, seed=2)))
    parts = [docs[i : i + 20] for i in range(0, len(docs), 20)]
    batches = [pa.RecordBatch.from_arrays([pa.array([d for d, _ in p]), pa.array([t for _, t in p])], ["doc_id", "text"]) for p in parts]
    monkeypatch.setattr(A, "MAX_PAIRS", 40)
    monkeypatch.setattr(A.TaskContext, "get", lambda: type("T", (), {"partitionId": lambda self: 3})())
    found = pa.Table.from_batches(A._blocks(A_PATH, B_PATH)(iter(batches)))
    is_pair = pc.is_valid(found.column("number"))
    pairs, out = found.filter(is_pair).to_pylist(), found.filter(pc.invert(is_pair))
    assert len({p["block"] for p in pairs}) > 5
    total, highest = Counter(), Counter()
    for p in pairs:
        total[p["pair"]] += p["n"]
    for k, n in total.items():
        highest[k & 0xFFFFFFFF] = max(highest[k & 0xFFFFFFFF], n)
    got = []
    for block in set(out.column("block").to_pylist()):
        mine = [p for p in pairs if p["block"] == block]
        table = pa.table({
            "number": pa.array([p["number"] for p in mine], pa.int32()), "total": pa.array([total[p["pair"]] for p in mine], pa.int64()),
            "best": pa.array([int(total[p["pair"]] == highest[p["pair"] & 0xFFFFFFFF]) for p in mine], pa.int32()),
        })
        got += [tuple(r.values()) for r in A._of_block(out.filter(pc.equal(out.column("block"), block)), table).to_pylist()]
    assert sorted(got, key=str) == by_hand(docs)


def test_groups_lie_end_to_end(spark):
    docs = [(i, t) for i, t in enumerate(made_up(60, seed=5))]
    found = defaultdict(list)
    for r in A.token_groups(spark.createDataFrame(docs, "doc_id long, text string"), A_PATH, B_PATH).collect():
        found[r["doc_id"]].append(r)
    plain = Plain()
    for d, t in docs:
        got = sorted(found[d], key=lambda r: r["place"])
        assert [(r["a_ids"], r["b_ids"]) for r in got] == plain.groups(t)[0]
        if got:
            assert got[0]["start"] == 0 and got[-1]["end"] == len((" " + t).encode())
            assert all(x["end"] == y["start"] for x, y in zip(got, got[1:]))
