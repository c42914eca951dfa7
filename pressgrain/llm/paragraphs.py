"""Repeated passages by MinHash over paragraphs.

Lines are paragraphs; a paragraph of several sentences is also taken in its sentences,
so that a passage inside longer paragraphs is met by its own sentences.  A passage may
begin and end anywhere, so windows of 26 words are units too, wherever the content
places them: at the run of five words that hashes lowest among 24 places.  Any 49 equal
words hold the same such window.  Equal units meet by a hash of their words.  Paragraphs also meet by bands of MinHash values over
shingles of five words, tuned for high recall; those that collide are verified by the
exact Jaccard similarity of their shingles, and components of verified links are the
classes of paragraphs.  Of each class the document with the smallest id keeps its
copy, the others' are removals; removals next to each other are one passage.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from pressgrain.llm.common import keyed_texts, map_batches, presence_bits, present, stored
from pressgrain.llm.components import connected_components
from pressgrain.llm.suffixes import minimisers, run_hashes

SHINGLE = 5
BANDS, ROWS = 12, 4  # 99.8 % of pairs at similarity 0.8 share a band
BLOCK = 1000  # members of a bucket compared in one place
WINDOW, PLACES = 26, 24  # words of a window; one of so many places in a row holds one

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_rng = np.random.default_rng(20240101)
_TIMES = _rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


class _Words(dict):
    """Hash of each word seen, its lowest bit set if the word ends a sentence."""

    limit = 100_000

    def __missing__(self, word: bytes) -> int:
        ends = word.rstrip(b"\"')]").endswith((b".", b"!", b"?"))
        value = self[word] = xxhash.xxh64_intdigest(word) >> 1 << 1 | ends
        return value


_SEEN = _Words()
_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse modulo 2**64."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, np.uint64(base))
            steps[0] = 1
            _POWERS[k] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


@dataclass
class Units:
    """Paragraphs, sentences and windows of a batch of texts; words are counted through the whole batch."""

    words: np.ndarray
    text_start: np.ndarray  # first word of each text
    lo: np.ndarray  # of each unit
    hi: np.ndarray
    text: np.ndarray  # which text a unit is from
    paragraph: np.ndarray  # whether a unit is a paragraph
    key: np.ndarray  # hash of a unit's words
    runs: np.ndarray  # hash of every run of ``SHINGLE`` words


def windows(runs: np.ndarray, text_start: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and text of the windows that the content places.

    Where one run of words follows itself, only the first of them counts.
    """
    at = minimisers(runs, PLACES)
    at = at[(at == 0) | (runs[at] != runs[at - 1])]
    text = np.searchsorted(text_start, at, side="right") - 1
    stop = np.append(text_start[1:], n_words)
    inside = at + WINDOW <= stop[text] if len(at) else np.empty(0, dtype=bool)
    return at[inside], text[inside]


def cut(texts: list[str], least: int = SHINGLE) -> Units:
    """Units of at least ``least`` words.  A sentence shorter than that does not end its unit."""
    if len(_SEEN) > _SEEN.limit:
        _SEEN.clear()
    hashes, line_n, line_text, sizes = [], [], [], []
    for t, text in enumerate(texts):
        before = len(hashes)
        for line in text.encode("utf-8", "replace").lower().split(b"\n"):
            found = line.split()
            if found:
                hashes += map(_SEEN.__getitem__, found)
                line_n.append(len(found))
                line_text.append(t)
        sizes.append(len(hashes) - before)
    words = np.array(hashes, dtype=np.uint64)
    text_start = np.concatenate([[0], np.cumsum(sizes)])[:-1].astype(np.int64)
    line_hi = np.cumsum(line_n, dtype=np.int64) if line_n else np.empty(0, dtype=np.int64)
    line_lo = line_hi - np.array(line_n, dtype=np.int64)
    line_text = np.array(line_text, dtype=np.int64)
    # sentence ends, line ends among them
    ends = (words & np.uint64(1)).astype(bool)
    line_end = np.zeros(len(words), dtype=bool)
    line_end[line_hi - 1] = True
    at = np.flatnonzero(ends | line_end) + 1
    length = np.diff(at, prepend=0)
    closes = at[(length >= least) | line_end[at - 1]] if len(at) else at
    piece_lo = np.concatenate([[0], closes[:-1]]).astype(np.int64) if len(closes) else closes
    line_of = np.searchsorted(line_hi, piece_lo, side="right")
    alone = (line_lo[line_of] == piece_lo) & (line_hi[line_of] == closes) if len(closes) else np.empty(0, dtype=bool)
    lo = np.concatenate([line_lo, piece_lo[~alone]])
    hi = np.concatenate([line_hi, closes[~alone]])
    text = np.concatenate([line_text, line_text[line_of[~alone]]]) if len(closes) else line_text
    paragraph = np.arange(len(lo)) < len(line_lo)
    keep = hi - lo >= least
    lo, hi, text, paragraph = lo[keep], hi[keep], text[keep], paragraph[keep]
    runs = run_hashes(words, SHINGLE)
    at, of = windows(runs, text_start, len(words))
    new = ~np.isin(at, lo[hi - lo == WINDOW])
    lo, hi = np.concatenate([lo, at[new]]), np.concatenate([hi, at[new] + WINDOW])
    text, paragraph = np.concatenate([text, of[new]]), np.concatenate([paragraph, np.zeros(new.sum(), dtype=bool)])
    up, down = _powers(len(words) + 1)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(words * up[: len(words)], dtype=np.uint64)])
    key = ((sums[hi] - sums[lo]) * down[lo] ^ (hi - lo).astype(np.uint64)) * _MIX
    return Units(words, text_start, lo, hi, text, paragraph, key ^ (key >> np.uint64(32)), runs)


def band_keys(units: Units) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the paragraphs that can have a near copy, and their band keys, a row for each.

    With fewer than four shingles no other set of shingles reaches similarity 0.8, so
    shorter paragraphs only meet as equal ones.
    """
    able = np.flatnonzero(units.paragraph & (units.hi - units.lo >= SHINGLE + 3))
    if not len(able):
        return able, np.empty((0, BANDS), dtype=np.uint64)
    n = units.hi[able] - units.lo[able] - SHINGLE + 1
    first = np.cumsum(n) - n
    at = np.arange(n.sum()) - np.repeat(first, n) + np.repeat(units.lo[able], n)
    values = units.runs[at]
    keys = np.empty((len(able), BANDS), dtype=np.uint64)
    for band in range(BANDS):
        key = np.full(len(able), np.uint64(band + 1))
        for k in range(band * ROWS, (band + 1) * ROWS):
            low = np.minimum.reduceat(values * _TIMES[k] + _PLUS[k], first)
            key = (key ^ low) * _MIX
            key ^= key >> np.uint64(31)
        keys[:, band] = key
    return able, keys


def key_counts(docs: DataFrame) -> DataFrame:
    """Rows (key, n): how often each unit key and band key occurs, summed within each batch."""

    def of(batch):
        units = cut(batch.column(0).to_pylist())
        keys, n = np.unique(np.concatenate([units.key, band_keys(units)[1].ravel()]), return_counts=True)
        return {"key": keys.view(np.int64), "n": n}

    return map_batches(docs.select("text"), of, "key long, n long")


_FOUND = "kind int, key long, unit long, doc_id long, lo int, hi int, words string"
UNIT, BAND, TEXT = range(3)


def candidates(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """Units that may be repeated (kind UNIT), the bands of paragraphs (BAND) and their words (TEXT)."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def of(batch):
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        units = cut(texts)
        able, keys = band_keys(units)
        hits = present(keys, shared.value)
        near = np.zeros(len(units.key), dtype=bool)
        near[able] = hits.any(axis=1)
        take = np.flatnonzero(near | present(units.key, shared.value))
        signed = units.key.view(np.int64)
        out = {k: [] for k in ("kind", "key", "unit", "doc_id", "lo", "hi", "words")}

        def put(kind, key, unit, doc_id=None, lo=None, hi=None, words=None):
            for k, v in zip(out, ([kind] * len(key), key, unit, doc_id, lo, hi, words)):
                out[k] += v if v is not None else [None] * len(key)

        start = units.text_start[units.text[take]]
        put(UNIT, signed[take].tolist(), signed[take].tolist(), [ids[t] for t in units.text[take].tolist()],
            (units.lo[take] - start).tolist(), (units.hi[take] - start).tolist())
        row, band = np.nonzero(hits)
        pairs = np.unique(np.stack([keys[row, band].view(np.int64), signed[able[row]]]), axis=1)
        put(BAND, pairs[0].tolist(), pairs[1].tolist())
        _, one = np.unique(signed[np.flatnonzero(near)], return_index=True)
        one = np.flatnonzero(near)[one]
        split: dict[int, list[str]] = {}
        words = []
        for u in one.tolist():
            t = int(units.text[u])
            if t not in split:
                split[t] = texts[t].encode("utf-8", "replace").lower().split()
            at = int(units.text_start[t])
            words.append(b" ".join(split[t][int(units.lo[u]) - at : int(units.hi[u]) - at]).decode())
        put(TEXT, signed[one].tolist(), signed[one].tolist(), words=words)
        return out

    return map_batches(docs, of, _FOUND)


def shingle_set(words: str, size: int = SHINGLE) -> frozenset:
    parts = words.split(" ")
    return frozenset(zip(*(parts[i:] for i in range(size)))) if len(parts) > size else frozenset([tuple(parts)])


def similar(a: frozenset, b: frozenset, threshold: float) -> bool:
    small, large = sorted((len(a), len(b)))
    if small < threshold * large:
        return False
    both = len(a & b)
    return both >= threshold * (len(a) + len(b) - both)


def _forest(members: list[tuple[int, int, str]], lo: int, hi: int, threshold: float) -> list[tuple[int, int]]:
    """Links that join what is similar among the members (unit, block, words): no more than members."""
    parent = {unit: unit for unit, _, _ in members}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    left = [(u, shingle_set(w)) for u, block, w in members if block == lo]
    right = [(u, shingle_set(w)) for u, block, w in members if block == hi] if hi != lo else left
    out = []
    for i, (u, s) in enumerate(left):
        for v, t in right[i + 1 :] if hi == lo else right:
            a, b = find(u), find(v)
            if a != b and similar(s, t, threshold):
                parent[a] = b
                out.append((u, v))
    return out


def similar_paragraphs(bands: DataFrame, texts: DataFrame, threshold: float = 0.8, block: int = BLOCK) -> DataFrame:
    """Rows (a, b): links that connect all paragraphs of a bucket that are similar to each other.

    ``bands`` has (key, unit), ``texts`` (unit, words).  A bucket of more than ``block``
    members is cut into blocks by a hash, and every two blocks are compared in a place
    of their own, so no task holds more than two blocks; of what it finds similar it
    gives only the links that connect, never all pairs.
    """
    sizes = bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    members = (
        bands.join(sizes, "key")
        .select("key", "unit", F.pmod(F.xxhash64("unit"), blocks).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
        .select("key", "unit", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    )
    place = ["key", "lo", "hi"]
    dealt = (
        members.join(texts, "unit").select(*place, "unit", "own", "words")
        .repartition(*place).sortWithinPartitions(*place, "unit")
    )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []

        def links():
            found = _forest(held, group[1], group[2], threshold)
            return pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], type=pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

        for batch in batches:
            for key, lo, hi, unit, own, words in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if (key, lo, hi) != group:
                    if len(held) > 1:
                        yield links()
                    group, held = (key, lo, hi), []
                held.append((unit, own, words))
        if len(held) > 1:
            yield links()

    return dealt.mapInArrow(of, "a long, b long").distinct()


def repeated_passages(
    docs: DataFrame, threshold: float = 0.8, least_words: int = 20, gap: int = SHINGLE - 1,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Rows (doc_id, start_word, n_words, n_removed, first_doc_id): passages repeated across documents.

    A passage is a run of units whose class lies in two or more documents, with at most
    ``gap`` other words between units, and at least ``least_words`` words, so that a
    common line alone is left in place.  ``first_doc_id`` is the smallest document that
    holds one of its units; ``n_removed`` counts the words of units that a smaller
    document holds too: these are the removals, the first document keeps its copy.

    Words are parted by white space and lower-cased from A to Z; units of fewer than
    five words take no part.  Units are equal by a 64-bit hash of their words.  Null
    texts are empty; rows without a doc_id take no part; rows that repeat a doc_id are
    one document.  Runs jobs.
    """
    texts = keyed_texts(docs, id_col, text_col).where("doc_id is not null")
    repeated = stored(key_counts(texts).groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key"))
    found = stored(candidates(texts, presence_bits(repeated, "key")))
    bands = found.where(F.col("kind") == BAND).select("key", "unit").distinct()
    words = found.where(F.col("kind") == TEXT).groupBy("unit").agg(F.min("words").alias("words"))
    roots = connected_components(similar_paragraphs(bands, words, threshold))
    units = found.where(F.col("kind") == UNIT).select("unit", "doc_id", "lo", "hi").distinct()
    classed = stored(
        units.join(roots, units["unit"] == roots["node"], "left")
        .select(F.coalesce("root", "unit").alias("class"), "doc_id", "lo", "hi")
    )
    classes = (
        classed.groupBy("class").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where(F.col("first") < F.col("last")).drop("last")
    )
    return _passages(classed.join(classes, "class").select("doc_id", "lo", "hi", "first"), least_words, gap)


def _passages(units: DataFrame, least_words: int, gap: int) -> DataFrame:
    """Joins the units of each document to runs."""
    item: Column = F.struct("lo", "hi", "first")
    together = units.groupBy("doc_id").agg(F.sort_array(F.collect_set(item)).alias("units"))

    def of(batch):
        out = {k: [] for k in ("doc_id", "start_word", "n_words", "n_removed", "first_doc_id")}
        for doc_id, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            runs = []  # start, end, words removed, end of what is removed, first document
            for u in found:
                lo, hi, first = u["lo"], u["hi"], u["first"]
                if not runs or lo > runs[-1][1] + gap:
                    runs.append([lo, lo, 0, lo, first])
                run = runs[-1]
                run[1], run[4] = max(run[1], hi), min(run[4], first)
                if first < doc_id and hi > run[3]:
                    run[2] += hi - max(lo, run[3])
                    run[3] = hi
            for lo, hi, removed, _, first in runs:
                if hi - lo >= least_words:
                    for k, v in zip(out, (doc_id, lo, hi - lo, removed, first)):
                        out[k].append(v)
        return out

    return map_batches(together, of, "doc_id long, start_word long, n_words long, n_removed long, first_doc_id long")
