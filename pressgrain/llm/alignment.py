"""Alignment of two tokenizers' tokens over the same bytes, by coalescing intervals.

Both tokenizers' tokens are intervals of the text's bytes.  All intervals of A and B are
sorted by start and the running maximum of their ends is taken: a group breaks where a
start reaches it, that is where both tokenizers end a token.  Inside a group the tokens
of A and B that overlap are expanded to pairs; the pairs that also end together are
links.  An id pair's count over the corpus tells how steady that link is.

Tokenizers part a text at white space, so a text is cut into units (white space and the
word after it) that no token of either spans.  Units recur, so a worker aligns each
unseen one once, all of a batch together, and looks the others up.  A text whose units
are not all rebuilt by both tokenizers is aligned whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from pressgrain.llm.common import keyed_texts, map_batches, stored
from pressgrain.llm.packing import _byte_characters as byte_characters

MAX_UNITS = 300_000  # units that a worker keeps; beyond it starts anew
MAX_PAIRS = 400_000  # distinct id pairs of a block of documents
LONG_UNIT = 200  # characters; longer ones are not kept

# A text is cut after a word before these; before other white space it is not.
_PLAIN = " \t\n"
_OTHER = rf"[^\S{_PLAIN}]"
_UNIT = re.compile(rf"\s*\S+(?:{_OTHER}\s*\S+)*(?:\s+\Z)?|\s+\Z")


@dataclass
class Tokens:
    """Ids of texts laid end to end, and how many each text has; none where it is not rebuilt (``ok``)."""

    a: np.ndarray
    a_n: np.ndarray
    b: np.ndarray
    b_n: np.ndarray
    ok: np.ndarray


class Pair:
    """The two tokenizers and the bytes of their ids."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(a_path)
        self.tokenizer.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        spec = json.loads(self.tokenizer.to_str())
        byte_of = {c: b for b, c in byte_characters().items()}
        size = max(self.tokenizer.get_vocab().values()) + 1
        self.a_bytes = [b""] * size
        for token, i in self.tokenizer.get_vocab().items():
            known = all(c in byte_of for c in token)
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        self.a_name, self.b_name = [str(i) for i in range(size)], [str(i) for i in range(len(self.b_bytes))]
        self.a = self._coder(spec)
        # units may be coded alone if no piece of B goes on over white space after a word
        pieces = [self.b.id_to_piece(i).replace("▁", " ") for i in range(self.b.get_piece_size())]
        crossing = re.compile(rf"\S[{_PLAIN}]|[\t\n]")
        parts = spec["pre_tokenizer"] or {}
        self.by_units = parts.get("type") == "ByteLevel" and parts.get("use_regex", False) and not any(
            crossing.search(p) for p in pieces
        )

    def _coder(self, spec: dict):
        """A's ids of one text.

        Byte-level merges in the order of their ids are what a rank coder does, many times
        faster; any other tokenizer codes for itself.
        """
        model, parts = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and parts == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True
        } and spec["normalizer"] is None and spec["post_processor"] is None
        vocabulary, special = model["vocab"], {t["content"] for t in spec["added_tokens"]}
        merged = [("".join(m) if isinstance(m, list) else m.replace(" ", "", 1)) for m in model.get("merges", [])]
        ordered = plain and [vocabulary[m] for m in merged] == list(range(256, 256 + len(merged)))
        if ordered and len(vocabulary) - len(special & set(vocabulary)) == 256 + len(merged):
            ranks = {self.a_bytes[i]: i for t, i in vocabulary.items() if t not in special}
            return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        return lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def whole(self, texts: list[str]) -> Tokens:
        """Tokens of a space and each text; an empty text has none."""
        a, b = [self.a(" " + t) if t else [] for t in texts], self.b.encode(texts, num_threads=1)
        return self._tokens([" " + t if t else "" for t in texts], a, b)

    def units(self, units: list[str]) -> Tokens:
        # B puts a space in front: it stands for the unit's own, or is taken off again
        b = self.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        return self._tokens(units, list(map(self.a, units)), [y if u[0] == " " else y[1:] for u, y in zip(units, b)])

    def _tokens(self, texts: list[str], a: list[list[int]], b: list[list[int]]) -> Tokens:
        data = [t.encode() for t in texts]
        a_n, b_n = (np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (a, b))
        a_flat, b_flat = (np.fromiter(chain.from_iterable(x), dtype=np.int64, count=n.sum()) for x, n in ((a, a_n), (b, b_n)))
        length = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        ok = length > 0
        together = b"".join(data)
        for flat, n, size, name in ((a_flat, a_n, self.a_size, self.a_bytes), (b_flat, b_n, self.b_size, self.b_bytes)):
            at = np.concatenate([[0], np.cumsum(size[flat])])
            stop = np.cumsum(n)
            ok &= at[stop] - at[stop - n] == length
            rebuilt = b"".join(map(name.__getitem__, flat.tolist()))
            if rebuilt != together:  # some text is not rebuilt: look at each
                ok &= [rebuilt[at[e - k] : at[e]] == d for d, e, k in zip(data, stop.tolist(), n.tolist())]
        if not ok.all():
            a_flat, b_flat = a_flat[np.repeat(ok, a_n)], b_flat[np.repeat(ok, b_n)]
            a_n, b_n = a_n * ok, b_n * ok
        return Tokens(a_flat, a_n, b_flat, b_n, ok)


def coalesce(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """The group of each token, first A's, then B's, from 0: intervals that touch the same run of bytes.

    Each tokenizer's intervals follow each other without gaps, from byte 0.
    """
    end = np.concatenate([a_end, b_end])
    start = np.concatenate([a_end, b_end])
    start[1 : len(a_end)], start[len(a_end) + 1 :] = a_end[:-1], b_end[:-1]
    start[[0, len(a_end)]] = 0
    side = np.repeat([0, 1], [len(a_end), len(b_end)])
    order = np.lexsort((side, start))
    reach = np.maximum.accumulate(end[order])
    first = np.ones(len(order), dtype=bool)
    first[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(first) - 1
    return group


def overlaps(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in A and B of all tokens that share a byte, expanded from each A token's first and last B token."""
    a_start = np.concatenate([[0], a_end[:-1]])
    b_start = np.concatenate([[0], b_end[:-1]])
    low, high = np.searchsorted(b_end, a_start, side="right"), np.searchsorted(b_start, a_end, side="left")
    n = high - low
    a = np.repeat(np.arange(len(a_end)), n)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


class Aligned(NamedTuple):
    """One unit or text: tokens of A and B, overlapping pairs, groups as text, and its links."""

    a: int = 0
    b: int = 0
    overlaps: int = 0
    groups: bytes = b""  # a1,a2|b1;a3|b2
    links: bytes = b""  # the numbers of their id pairs, 32 bits each


_MISS = Aligned()


def align(pair: Pair, tokens: Tokens, number: dict[int, int]) -> list[Aligned]:
    """Aligns texts or units, all of them in one pass over their bytes laid end to end.

    ``number`` has a number for each id pair (A's id in the upper 32 bits) and gets new ones.
    """
    a, b = tokens.a, tokens.b
    if not len(a):
        return [_MISS] * len(tokens.ok)
    a_end, b_end = np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b])
    group = coalesce(a_end, b_end)
    a_group, b_group = group[: len(a)], group[len(a) :]
    n_groups = int(group.max()) + 1
    x, y = overlaps(a_end, b_end)
    together = a_end[x] == b_end[y]
    pairs = ((a[x[together]] << 32) | b[y[together]]).tolist()
    links = np.array([number.setdefault(p, len(number)) for p in pairs], dtype=np.int32).tobytes()
    starts = lambda of: np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n_groups))])
    link_at, over_at = (4 * starts(a_group[x[together]])).tolist(), starts(a_group[x]).tolist()
    a_at, b_at = starts(a_group).tolist(), starts(b_group).tolist()
    names_a, names_b = [pair.a_name[i] for i in a.tolist()], [pair.b_name[i] for i in b.tolist()]
    texts = [
        f"{names_a[i]}|{names_b[k]}" if j - i == m - k == 1 else f"{','.join(names_a[i:j])}|{','.join(names_b[k:m])}"
        for i, j, k, m in zip(a_at, a_at[1:], b_at, b_at[1:])
    ]
    # a text is a run of whole groups: both tokenizers end where it ends
    last = np.cumsum(tokens.a_n) - 1
    group_at = [0, *np.where(last >= 0, a_group[np.maximum(last, 0)] + 1, 0).tolist()]
    return [
        Aligned(n, m, over_at[h] - over_at[g], ";".join(texts[g:h]).encode(), links[link_at[g] : link_at[h]]) if n else _MISS
        for n, m, g, h in zip(tokens.a_n.tolist(), tokens.b_n.tolist(), group_at, group_at[1:])
    ]


class Worker:
    """What a Python worker keeps between documents: aligned units and the numbers of id pairs."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.forget()

    def forget(self) -> None:
        self.units: dict[str, Aligned] = {}
        self.number: dict[int, int] = {}  # id pair -> number

    def documents(self, texts: list[str]) -> list[Aligned]:
        if not self.pair.by_units:
            return align(self.pair, self.pair.whole(texts), self.number)
        cut = [_UNIT.findall(" " + t) if t else [] for t in texts]
        known = self.units
        new = list({u for units in cut for u in units if u not in known})
        passing = {}
        for at in range(0, len(new), 1 << 14):
            part = new[at : at + (1 << 14)]
            for unit, made in zip(part, align(self.pair, self.pair.units(part), self.number)):
                (known if len(unit) <= LONG_UNIT else passing)[unit] = made
        return [self._joined(t, [known.get(u) or passing[u] for u in units]) for t, units in zip(texts, cut)]

    def _joined(self, text: str, units: list[Aligned]) -> Aligned:
        if not units:
            return _MISS
        a, b, shared, groups, links = zip(*units)
        if not all(a):
            return align(self.pair, self.pair.whole([text]), self.number)[0]
        return Aligned(sum(a), sum(b), sum(shared), b";".join(groups), b"".join(links))


_WORKERS: dict[tuple[str, str], Worker] = {}  # one of each pair of paths


def worker(a_path: str, b_path: str) -> Worker:
    key = (a_path, b_path)
    if key not in _WORKERS:
        _WORKERS[key] = Worker(Pair(a_path, b_path))
    return _WORKERS[key]


def token_groups(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (doc_id, place, start, end, a_ids, b_ids): every group, in bytes of a space and the text.

    Texts that are null, empty or not rebuilt by both tokenizers have no groups.
    """

    def of(batch: pa.RecordBatch) -> dict:
        w = worker(a_path, b_path)
        if len(w.units) > MAX_UNITS:
            w.forget()
        out = {k: [] for k in ("doc_id", "place", "start", "end", "a_ids", "b_ids")}
        for doc_id, made in zip(batch.column(0).to_pylist(), w.documents(batch.column(1).to_pylist())):
            end = 0
            for place, group in enumerate(made.groups.decode().split(";") if made.a else []):
                a, b = ([int(i) for i in side.split(",")] for side in group.split("|"))
                start, end = end, end + int(w.pair.a_size[a].sum())
                for k, v in zip(out, (doc_id, place, start, end, a, b)):
                    out[k].append(v)
        return out

    schema = "doc_id long, place int, start long, end long, a_ids array<int>, b_ids array<int>"
    return map_batches(keyed_texts(docs, id_col, text_col), of, schema)


_BLOCK_SCHEMA = (
    "block string, doc_id long, n_a long, n_b long, n_overlaps long, n_links long, groups_sha256 string, "
    "at array<int>, times array<int>, number int, pair long, n long"
)
_OUT_SCHEMA = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string, n_overlaps long"
)


def _blocks(a_path: str, b_path: str):
    """Documents as counts of numbered id pairs, and for each block of them the pairs of the numbers."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(_BLOCK_SCHEMA))

    def rows(size: int, **columns) -> pa.RecordBatch:
        arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in schema]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, task, block = worker(a_path, b_path), TaskContext.get().partitionId(), 0
        counts, entries = np.zeros(1 << 16, dtype=np.int64), 0

        def pairs() -> Iterator[pa.RecordBatch]:
            """The numbers of the block that ends."""
            names = np.fromiter(w.number, dtype=np.int64, count=len(w.number))
            used = np.flatnonzero(counts[: len(names)])
            for at in range(0, len(used), 1 << 16):
                part = used[at : at + (1 << 16)]
                yield rows(len(part), block=[f"{task}-{block}"] * len(part), number=part, pair=names[part], n=counts[part])

        for batch in batches:
            full = len(w.number) > MAX_PAIRS or len(w.units) > MAX_UNITS
            if entries and (full or entries > 10 * MAX_PAIRS):
                yield from pairs()
                counts[:], entries, block = 0, 0, block + 1
            if full:
                w.forget()
            made = w.documents(batch.column(1).to_pylist())
            if len(w.number) > len(counts):
                counts = np.concatenate([counts, np.zeros(2 * len(w.number) - len(counts), dtype=np.int64)])
            each = [np.unique(np.frombuffer(m.links, dtype=np.int32), return_counts=True) for m in made]
            for at, times in each:
                counts[at] += times
            entries += 1 + sum(len(at) for at, _ in each)
            yield rows(
                len(made), block=[f"{task}-{block}"] * len(made), doc_id=batch.column(0),
                n_a=[m.a for m in made], n_b=[m.b for m in made], n_overlaps=[m.overlaps for m in made],
                n_links=[len(m.links) // 4 for m in made],
                groups_sha256=[hashlib.sha256(m.groups).hexdigest() if m.a else "" for m in made],
                at=[at for at, _ in each], times=[times for _, times in each],
            )
        yield from pairs()

    return run


def _of_block(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """Looks the pairs of a block's documents up among the block's corpus-wide counts."""
    number = pairs.column("number").to_numpy()
    total = np.zeros(int(number.max()) + 1 if len(number) else 1, dtype=np.int64)
    best = np.zeros_like(total)
    total[number], best[number] = pairs.column("total").to_numpy(), pairs.column("best").to_numpy()
    lists = docs.column("at").combine_chunks()
    at, times = lists.flatten().to_numpy(), docs.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
    stop = np.cumsum(lists.value_lengths().to_numpy().astype(np.int64))

    def sums(values: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(values)])
        return run[stop] - run[np.concatenate([[0], stop[:-1]])]

    return docs.select(["doc_id", "n_a", "n_b", "n_links"]).append_column(
        "n_groups", docs.column("n_links")  # both tokenizers end where a group ends, and nowhere else
    ).append_column("n_best", pa.array(sums(times * best[at]))).append_column(
        "count_sum", pa.array(sums(times * total[at]))
    ).append_column("groups_sha256", docs.column("groups_sha256")).append_column(
        "n_overlaps", docs.column("n_overlaps")
    ).select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"])


def agreement(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps).

    One for each input row.  ``n_links`` counts pairs of an A and a B token that end
    together, ``n_overlaps`` all pairs that share a byte.  A link's count is how many
    links of the corpus join its two ids; ``count_sum`` adds them up, ``n_best`` counts
    links whose count is the highest of their B id.  ``groups_sha256`` is of the groups
    ``a1,a2|b1;a3|b2``.  Null, empty and not rebuilt texts: zeros and an empty string;
    repeated rows count as often as they occur; an empty table gives no rows.

    Documents are tokenized once and written as counts of pairs, numbered within
    blocks of bounded size; only each block's distinct pairs are shuffled to be summed
    over the corpus, and come back to the block.  Runs jobs.
    """
    found = stored(keyed_texts(docs, id_col, text_col).mapInArrow(_blocks(a_path, b_path), _BLOCK_SCHEMA))
    pairs = found.where(F.col("number").isNotNull()).select(F.col("block").alias("of_block"), "number", "pair", "n")
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    totals = stored(totals.withColumn("b_id", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))))
    highest = totals.groupBy("b_id").agg(F.max("total").alias("highest"))
    marked = totals.join(highest, "b_id").select("pair", "total", (F.col("total") == F.col("highest")).cast("int").alias("best"))
    back = pairs.drop("n").join(marked, "pair").select("of_block", "number", "total", "best")
    rows = found.where(F.col("number").isNull()).select(
        "block", "doc_id", "n_a", "n_b", "n_overlaps", "n_links", "groups_sha256", "at", "times"
    )
    return rows.groupBy("block").cogroup(back.groupBy("of_block")).applyInArrow(_of_block, _OUT_SCHEMA)
