"""Text quality by a generalised additive model with pairwise interactions.

Shallow trees are boosted one feature at a time, round after round; the trees of a
feature add up to one lookup table over its bins, those of a pair of features to a
table over pairs of bins.  Scoring adds table entries for whole batches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from pressgrain.llm.common import keyed_texts, map_batches

FEATURES = (
    "log_words", "mean_word", "upper", "digits", "symbols", "stops", "distinct", "repeats",
    "short_words", "long_words", "line_words", "repeated_lines", "non_ascii",
)
_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_STOP = b".,;:?'\"-"
_SYMBOL = bytes(set(range(33, 127)) - set(_UPPER) - set(range(97, 123)) - set(_DIGIT) - set(_STOP))
_HIGH = bytes(range(128, 256))


def text_features(text: str) -> tuple[float, ...]:
    """Shares and means over the whole text, in the order of ``FEATURES``; all zero for a blank one."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    if not n:
        return (0.0,) * len(FEATURES)
    size = sum(map(len, words))

    def share(chars: bytes) -> float:
        return (len(raw) - len(raw.translate(None, chars))) / size

    lengths = [*map(len, words)]
    lines = raw.split(b"\n")
    return (
        math.log1p(n), size / n, share(_UPPER), share(_DIGIT), share(_SYMBOL), share(_STOP),
        len(set(words)) / n, sum(map(eq, words, words[1:])) / n,
        lengths.count(1) / n, sum(x > 15 for x in lengths) / n,
        n / len(lines), 1 - len(set(lines)) / len(lines), share(_HIGH),
    )


def feature_matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([text_features(t or "") for t in texts], dtype=np.float64).reshape(len(texts), len(FEATURES))


@dataclass
class AdditiveModel:
    bias: float
    edges: list[np.ndarray]  # of each feature
    tables: list[np.ndarray]  # of each feature, by bin
    coarse: list[np.ndarray]  # of each feature, its coarser edges for pairs
    pairs: dict[tuple[int, int], np.ndarray]  # by pair of coarse bins

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        for (a, b), table in self.pairs.items():
            total += table[
                np.searchsorted(self.coarse[a], x[:, a], side="right"),
                np.searchsorted(self.coarse[b], x[:, b], side="right"),
            ]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(g, h, smooth):
    return g / (h + smooth)


def _best_cut(g: np.ndarray, h: np.ndarray, lo: int, hi: int, smooth: float) -> tuple[float, int]:
    """Gain and place of the best cut of the bins lo..hi-1 in two."""
    if hi - lo < 2:
        return 0.0, lo
    gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
    gs, hs = g[lo:hi].sum(), h[lo:hi].sum()
    gain = gl * _leaf(gl, hl, smooth) + (gs - gl) * _leaf(gs - gl, hs - hl, smooth) - gs * _leaf(gs, hs, smooth)
    at = int(np.argmax(gain))
    return float(gain[at]), lo + at + 1


def _tree(g: np.ndarray, h: np.ndarray, smooth: float, leaves: int = 4) -> np.ndarray:
    """A tree of a few leaves over ordered bins, as its value in each bin."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        gain, at, k = max((*_best_cut(g, h, lo, hi, smooth), k) for k, (lo, hi) in enumerate(parts))
        if gain <= 1e-9:
            break
        lo, hi = parts[k]
        parts[k : k + 1] = [(lo, at), (at, hi)]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = _leaf(g[lo:hi].sum(), h[lo:hi].sum(), smooth)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, smooth: float) -> np.ndarray:
    """A tree cutting both features of a pair once, as its value in each pair of bins."""
    best, out = 1e-9, np.zeros(g.shape)
    for i in range(1, g.shape[0]):
        for j in range(1, g.shape[1]):
            parts = [(s, t) for s in (slice(0, i), slice(i, None)) for t in (slice(0, j), slice(j, None))]
            sums = [(g[p].sum(), h[p].sum()) for p in parts]
            gain = sum(a * _leaf(a, b, smooth) for a, b in sums)
            if gain > best:
                best, out = gain, np.zeros(g.shape)
                for p, (a, b) in zip(parts, sums):
                    out[p] = _leaf(a, b, smooth)
    return out


def train(
    x: np.ndarray, y: np.ndarray, rounds: int = 120, pair_rounds: int = 25, n_pairs: int = 6,
    rate: float = 0.1, bins: int = 48, coarse_bins: int = 8, smooth: float = 2.0,
) -> AdditiveModel:
    """Fit the tables.  Without rows every score is 0.5; with one class it is near that class."""
    share = (y.sum() + 1) / (len(y) + 2)
    bias = math.log(share / (1 - share))
    if not len(y):
        n = len(FEATURES) if x.ndim < 2 or not x.shape[1] else x.shape[1]
        return AdditiveModel(bias, [np.array([])] * n, [np.zeros(1)] * n, [np.array([])] * n, {})
    width = x.shape[1]
    edges = [_cuts(x[:, j], bins) for j in range(width)]
    binned = [np.searchsorted(edges[j], x[:, j], side="right") for j in range(width)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(y), bias)

    def slopes():
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(width):
            g, h = slopes()
            step = rate * _tree(
                np.bincount(binned[j], g, len(tables[j])), np.bincount(binned[j], h, len(tables[j])), smooth
            )
            tables[j] += step
            total += step[binned[j]]
    coarse = [_cuts(x[:, j], coarse_bins) for j in range(width)]
    cells = [np.searchsorted(coarse[j], x[:, j], side="right") for j in range(width)]

    def grids(a: int, b: int):
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        at = cells[a] * shape[1] + cells[b]
        g, h = slopes()
        n = shape[0] * shape[1]
        return np.bincount(at, g, n).reshape(shape), np.bincount(at, h, n).reshape(shape)

    def strength(pair):
        g, h = grids(*pair)
        return float((g * _leaf(g, h, smooth)).sum())

    chosen = sorted(combinations(range(width), 2), key=lambda p: (-strength(p), p))[:n_pairs]
    pairs = {p: np.zeros((len(coarse[p[0]]) + 1, len(coarse[p[1]]) + 1)) for p in chosen}
    for _ in range(pair_rounds):
        for p in chosen:
            step = rate * _quadrants(*grids(*p), smooth)
            pairs[p] += step
            total += step[cells[p[0]], cells[p[1]]]
    return AdditiveModel(bias, edges, tables, coarse, pairs)


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: a quarter, by a checksum of the id; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 20_000) -> DataFrame:
    """Rows (doc_id, y, x) to learn from: at most ``max_rows`` labelled documents.

    The sample is the first ``max_rows`` labels by a hash of doc_id, so it is the same
    on every run.  Labels other than 0 and 1 and null ids are left out; a document
    with both labels counts as 0; of documents with the same id one is taken.
    """
    ids = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("y"))
        .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("y").cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    # at most max_rows rows of 12 bytes
    texts = keyed_texts(docs, "doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "y", "text")

    def of(batch):
        return {"doc_id": batch.column(0), "y": batch.column(1), "x": [*map(list, feature_matrix(batch.column(2).to_pylist()))]}

    return (
        map_batches(texts, of, "doc_id long, y int, x array<double>")
        .groupBy("doc_id", "y").agg(F.min("x").alias("x"))
    )


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 20_000) -> AdditiveModel:
    """Learn from the bounded sample of ``training_rows``, which comes to the driver.  Runs jobs."""
    rows = training_rows(docs, labels, label, max_rows).orderBy("doc_id").collect()
    x = np.array([r["x"] for r in rows], dtype=np.float64).reshape(len(rows), len(FEATURES))
    return train(x, np.array([r["y"] for r in rows], dtype=np.float64))


def quality_score(model: AdditiveModel, text: Column) -> Column:
    """Score from 0 to 1 of each whole text; a null text counts as empty."""

    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(feature_matrix(texts.tolist())))

    return F.pandas_udf(of, "double")(text.cast("string"))


def score_documents(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_rows: int = 20_000
) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one for each input row.  Runs jobs to learn.

    Only the text is an input of the score.  Null texts score as empty ones; a null
    doc_id is not held out.
    """
    model = fit(docs, labels, max_rows=max_rows)
    scored = keyed_texts(docs, "doc_id", "text").select("doc_id", quality_score(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_rows: int = 20_000) -> DataFrame:
    """The rows that score at least ``threshold``, all columns kept.  Runs jobs to learn."""
    model = fit(docs, labels, max_rows=max_rows)
    return docs.where(quality_score(model, docs["text"]) >= threshold)
