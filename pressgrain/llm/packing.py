"""Packing token sequences into windows, planned by non-negative least squares.

Documents are cut into whole windows and one rest.  The histogram of rest lengths
has at most ``window - 1`` bins, whatever the corpus; the plan is made from it
alone.  Shallow combinations of lengths that fill a window exactly are enumerated,
non-negative least squares finds how often each should be used, the counts are
rounded down to what the histogram holds, and what is left is packed greedily, the
longest first, a combination as often as its lengths allow.  Pieces find their
place by their rank within their length.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from pressgrain.llm.common import keyed_texts, map_batches, stored

MAX_KNOWN = 400_000  # pieces whose ids a worker keeps; beyond it starts anew

# Characters whose case, class and normal form are the same everywhere: ASCII, Latin
# letters with marks, and general punctuation.  Special tokens begin with "<|".
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u012f\u0131-\u017f"
_SIGNS = "\u2010-\u2027\u2030-\u205e"
_ODD = re.compile(f"[^\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f{_SIGNS}]")
_WORD = re.compile(r"[^ \t\n\r\x0b\x0c]+")
# How the tokenizer normalises and parts a text, and the same parting of
# a text in lower case for those characters.
_STEPS = ["NFC", "Replace", "Lowercase"]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^ \\t\\n\\r\\x0b\\x0c{_LETTERS}0-9]+")


def _byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTES = _byte_characters()


class _Known(dict):
    """Ids of the parts seen so far, as bytes; an unseen part is coded and kept."""

    def __init__(self, code):
        super().__init__()
        self.code = code

    def __missing__(self, part: str) -> bytes:
        value = self[part] = array("I", self.code(part)).tobytes()
        return value


class WordTokenizer:
    """Ids of texts by a tokenizer that parts them by ``_PATTERN``, in lower case.

    A text of plain characters is parted into pieces here and only the pieces go to the
    tokenizer's model; any other text is parted at ASCII white space and its words go
    through the whole tokenizer.  The ids of a part seen before are looked up.
    """

    def __init__(self, path: str):
        # Spark gives each task a core; the library's own threads would take others'
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        steps = [s["type"] for s in (spec["normalizer"] or {}).get("normalizers", [])]
        parting = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        if (steps, parting) != (_STEPS, _PATTERN):
            raise ValueError("this tokenizer parts texts in another way")
        tokenize, encode = self.tokenizer.model.tokenize, self.tokenizer.encode
        self.pieces = _Known(lambda p: [t.id for t in tokenize(p.encode().decode("latin-1").translate(_BYTES))])
        self.words = _Known(lambda w: encode(w, add_special_tokens=False).ids)

    def ids(self, text: str) -> np.ndarray:
        if "<|" in text or _ODD.search(text):
            known, parts = self.words, _WORD.findall(text)
        else:
            known, parts = self.pieces, _PIECE.findall(text.lower())
        if len(known) > MAX_KNOWN:
            known.clear()
        return np.frombuffer(b"".join(map(known.__getitem__, parts)), dtype="<u4")


_TOKENIZERS: dict[str, WordTokenizer] = {}  # one of each path in a worker


def tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def pieces(
    docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens): each document in whole windows and a rest.

    Every document ends with ``end_id``, so an empty or null text is one token.
    """

    def of(batch):
        tok = tokenizer(tokenizer_path)
        out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
        end = np.array([end_id], dtype="<u4")
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = np.concatenate([tok.ids(text), end])
            for start in range(0, len(ids), window):
                part = ids[start : start + window]
                for k, v in zip(out, (doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids))):
                    out[k].append(v)
        return out

    return map_batches(
        keyed_texts(docs, id_col, text_col), of,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long",
    )


def combinations(histogram: np.ndarray, window: int, depth: int = 4, per_length: int = 6) -> list[tuple[int, ...]]:
    """Combinations of at most ``depth`` lengths, longest first, that fill the window exactly.

    All pairs that occur, and for each longest length the triples and fours that use
    the most frequent lengths; so their number is bounded by the window, not the corpus.
    """
    have = histogram > 0
    found = {(window,)} if have[window] else set()
    for a in range((window + 1) // 2, window):
        if have[a] and have[window - a]:
            found.add((a, window - a))
    if depth < 3:
        return sorted(found, reverse=True)
    common = [int(x) for x in np.argsort(-histogram, kind="stable")[:64] if histogram[x] > 0 and x < window]
    for a in (int(x) for x in np.flatnonzero(have) if x < window):
        kept = 0
        for b in common:
            c = window - a - b
            if 0 < c <= window and have[c]:
                found.add(tuple(sorted((a, b, c), reverse=True)))
                kept += 1
            if kept >= per_length:
                break
        if depth < 4:
            continue
        kept = 0
        for b, b2 in zip(common, common[1:]):
            c = window - a - b - b2
            if 0 < c <= window and have[c]:
                found.add(tuple(sorted((a, b, b2, c), reverse=True)))
                kept += 1
            if kept >= per_length:
                break
    return sorted(found, reverse=True)


def least_squares(histogram: np.ndarray, combos: list[tuple[int, ...]], rounds: int = 300) -> np.ndarray:
    """Repeat counts x >= 0 of the combinations minimising |A x - histogram|, by multiplicative updates."""
    rows = np.concatenate([np.array(c) for c in combos])
    cols = np.repeat(np.arange(len(combos)), [len(c) for c in combos])
    target = histogram.astype(np.float64)
    up = np.bincount(cols, target[rows], len(combos))
    x = np.bincount(cols, target[rows] / np.maximum(1, np.bincount(rows, minlength=len(target)))[rows], len(combos))
    x /= np.bincount(cols, minlength=len(combos))
    for _ in range(rounds):
        used = np.bincount(rows, x[cols], len(target))
        x *= up / np.maximum(np.bincount(cols, used[rows], len(combos)), 1e-12)
    return x


@dataclass
class Plan:
    """Slots sorted by length, then first rank: pieces of a length and the sequences they go to."""

    length: np.ndarray
    first_rank: np.ndarray
    first_sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def plan(counts: dict[int, int], window: int = 2048, depth: int = 4) -> Plan:
    """Which sequence and offset each piece gets, from the number of pieces of each length."""
    left = np.zeros(window + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] += n
    used = np.zeros(window + 1, dtype=np.int64)
    slots, sequences = [], 0

    def use(combo: tuple[int, ...], times: int) -> None:
        nonlocal sequences
        for length, offset in zip(combo, accumulate((0, *combo))):
            slots.append((length, used[length], sequences, offset))
            used[length] += times
            left[length] -= times
        sequences += times

    combos = combinations(left, window, depth)
    if combos:
        wanted = np.floor(least_squares(left, combos) + 1e-6).astype(np.int64)
        for k in np.argsort(-wanted, kind="stable"):
            need = {length: combos[k].count(length) for length in combos[k]}
            times = min(int(wanted[k]), *(int(left[x]) // m for x, m in need.items()))
            if times > 0:
                use(combos[k], times)
    while left.any():
        lengths = np.flatnonzero(left)
        combo, room, taken = [], window, {}
        for at in lengths[::-1]:
            at = int(at)
            fit = min(room // at, int(left[at]))
            if fit:
                combo += [at] * fit
                taken[at] = fit
                room -= at * fit
            if room < lengths[0]:
                break
        use(tuple(combo), min(int(left[x]) // m for x, m in taken.items()))
    slots.sort()
    columns = np.array(slots, dtype=np.int64).reshape(-1, 4).T
    return Plan(*columns, sequences)


def ranked(df: DataFrame, group: str, order: list[str], parts: int = 256) -> DataFrame:
    """Adds ``rank``, from 0 without gaps within each group, in no promised order.

    Each group is dealt over ``parts`` parts by a hash of its order columns; parts are
    ranked alone and the sizes of the parts before added.
    """
    dealt = df.withColumn("part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    sizes = dealt.groupBy(group, "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(group, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy(group, "part").orderBy(*order)
    return (
        dealt.withColumn("inside", F.row_number().over(inside) - 1)
        .join(starts, [group, "part"])
        .withColumn("rank", F.col("before") + F.col("inside"))
        .drop("part", "inside", "before")
    )


def pack(
    docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one for each piece.

    Sequences hold at most ``window`` tokens and are filled from 0 without gaps.
    ``start`` counts the document's ids before the piece, ``ids_crc32`` is of its ids
    as little-endian unsigned 32-bit numbers.  Repeated rows and doc_ids are packed as
    often as they occur; an empty table gives no rows.

    Runs jobs: pieces are written once; only the count of each length, at most
    ``window`` numbers, comes to the driver.
    """
    cut = stored(pieces(docs, tokenizer_path, window, end_id, id_col, text_col))
    counts = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}
    made = plan(counts, window)
    key = made.length * (1 << 44) + made.first_rank
    parts = max(256, int(sum(counts.values())) >> 20)  # of each length: a million pieces at most, if they are dealt evenly

    def place(batch):
        columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        length = columns["length"].to_numpy(zero_copy_only=False)
        rank = columns["rank"].to_numpy(zero_copy_only=False)
        at = np.searchsorted(key, length * (1 << 44) + rank, side="right") - 1
        del columns["rank"]
        return columns | {
            "sequence_id": made.first_sequence[at] + rank - made.first_rank[at], "offset": made.offset[at]
        }

    return map_batches(
        ranked(cut, "length", ["doc_id", "start", "ids_crc32"], parts), place,
        "length long, doc_id long, start long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    ).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
