"""Repeated passages by sparse suffix arrays.

Only suffixes that begin at minimisers are kept: of every window of ``min_words``
words, the position whose run of ``head`` words hashes lowest.  The choice depends on
the content alone, so equal windows keep equal positions.  The kept suffixes are
sorted over the cluster by their first ``head`` words and each is compared with its
neighbours; where two agree, the match is extended left and right: the windows around
the suffix are compared by hash, whole windows of ``min_words`` words at a time, and
windows that follow each other are joined to spans.  Every window that occurs in two
documents is found, whatever stands around it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from pressgrain.llm.common import keyed_texts, map_batches, may_be_in, presence_bits, stored

_MUL = np.uint64(0x9E3779B97F4A7C15)
_STIR = np.uint64(0xD6E8FEB86659FD93)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


class _WordHashes(dict):
    """Hash of each word seen; forgets everything when it is full."""

    limit = 100_000

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_SEEN = _WordHashes()


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word; words are parted by ASCII white space."""
    if len(_SEEN) > _SEEN.limit:
        _SEEN.clear()
    words = text.encode("utf-8", "replace").split()
    return np.fromiter(map(_SEEN.__getitem__, words), dtype=np.uint64, count=len(words))


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` words, in order."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        total = (total ^ words[i : i + n]) * _MUL
        total ^= total >> np.uint64(29)
    total *= _STIR
    return total ^ (total >> np.uint64(32))


def sliding(values: np.ndarray, size: int, pick=np.minimum) -> np.ndarray:
    """The least (or by ``pick`` the greatest) of every run of ``size`` values, in linear time."""
    n = len(values) - size + 1
    if n <= 0:
        return values[:0]
    blocks = -(-len(values) // size)
    padded = np.full(blocks * size, _TOP if pick is np.minimum else np.uint64(0), dtype=np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, size)
    left = pick.accumulate(grid, axis=1).ravel()
    right = pick.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(right[:n], left[size - 1 : size - 1 + n])


def minimisers(heads: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the lowest hash of some run of ``width`` positions; equal lowest ones all count."""
    lowest = sliding(heads, width)
    if not len(lowest):
        return np.empty(0, dtype=np.int64)
    pad = np.zeros(width - 1, dtype=np.uint64)
    return np.flatnonzero(sliding(np.concatenate([pad, lowest, pad]), width, np.maximum) == heads)


def window_hashes(heads: np.ndarray, head: int, size: int) -> np.ndarray:
    """A hash of every window of ``size`` words, from the hashes of its runs of ``head`` words."""
    n = len(heads) - (size - head)
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.full(n, np.uint64(size), dtype=np.uint64)
    for at in [*range(0, size - head, head), size - head]:
        total = (total ^ heads[at : at + n]) * _MUL
        total ^= total >> np.uint64(31)
    return total


def sparse_suffixes(docs: DataFrame, min_words: int, head: int) -> DataFrame:
    """Rows (key, doc_id, place): the kept suffixes of (doc_id, text) and the hash of their first words."""

    def of(batch):
        keys, ids, places = [], [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            heads = run_hashes(word_hashes(text), head)
            at = minimisers(heads, min_words - head + 1)
            keys.append(heads[at])
            places.append(at)
            ids.append(np.full(len(at), doc_id, dtype=np.int64))
        return {
            "key": np.concatenate(keys).view(np.int64), "doc_id": np.concatenate(ids),
            "place": np.concatenate(places).astype(np.int32),
        }

    return map_batches(docs, of, "key long, doc_id long, place int")


_SORTED = "key long, doc_id long, place int, same boolean, edge boolean"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted partition: rows whose key a neighbour shares, and its first and last row."""
    held = None  # the last row so far, whose next neighbour is not known yet

    def make(keys, ids, places, same, edge):
        return pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(ids), pa.array(places, type=pa.int32()), pa.array(same), pa.array(edge)],
            names=["key", "doc_id", "place", "same", "edge"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        keys, ids, places = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        first = held is None
        before = np.zeros(len(keys), dtype=bool)
        before[1:] = keys[1:] == keys[:-1]
        if not first:
            before[0] = keys[0] == held[0]
            yield make([held[0]], [held[1]], [held[2]], [bool(held[3] or before[0])], [held[4]])
        after = np.zeros(len(keys), dtype=bool)
        after[:-1] = before[1:]
        same = (before | after)[:-1]
        edge = np.zeros(len(keys) - 1, dtype=bool)
        if first and len(edge):
            edge[0] = True
        take = same | edge
        yield make(keys[:-1][take], ids[:-1][take], places[:-1][take], same[take], edge[take])
        held = (keys[-1], ids[-1], places[-1], bool(before[-1]), first and len(keys) == 1)
    if held is not None:
        yield make([held[0]], [held[1]], [held[2]], [bool(held[3])], [True])


def repeated_suffixes(suffixes: DataFrame) -> DataFrame:
    """Rows (doc_id, place) of the suffixes whose first words a neighbour in the sorted order shares.

    The order is dealt out in ranges of (key, doc_id, place), so that a key of very
    many suffixes lies in several ranges.  Neighbours in different ranges meet by the
    first and last rows of the ranges, two for each.
    """
    parts = int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "doc_id", "place"]
    compared = stored(
        suffixes.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(_neighbours, _SORTED)
    )
    edges = compared.where("edge")
    shared = edges.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    across = edges.where("not same").join(shared, "key", "left_semi")
    return compared.where("same").select("doc_id", "place").unionByName(across.select("doc_id", "place"))


def candidate_windows(docs: DataFrame, suffixes: DataFrame, min_words: int, head: int) -> DataFrame:
    """Rows (hash, doc_id, place) of the windows that the repeated suffixes extend to on both sides."""
    places = suffixes.groupBy("doc_id").agg(F.collect_set("place").alias("places"))  # of one document
    # texts without a repeated suffix are not shuffled
    bits = presence_bits(suffixes.select(F.xxhash64("doc_id").alias("key")).distinct(), "key")
    some = docs.where(may_be_in(F.xxhash64("doc_id"), bits, docs.sparkSession))
    joined = some.join(places, "doc_id").select("doc_id", "text", "places")
    width = min_words - head + 1

    def of(batch):
        hashes, ids, starts = [], [], []
        for doc_id, text, found in zip(*(batch.column(i).to_pylist() for i in range(3))):
            heads = run_hashes(word_hashes(text), head)
            lowest = sliding(heads, width)
            repeated = np.full(len(heads), _TOP, dtype=np.uint64)
            at = np.array(found, dtype=np.int64)
            at = at[at < len(heads)]
            repeated[at] = heads[at]
            at = np.flatnonzero(sliding(repeated, width) == lowest)
            hashes.append(window_hashes(heads, head, min_words)[at])
            starts.append(at)
            ids.append(np.full(len(at), doc_id, dtype=np.int64))
        return {
            "hash": np.concatenate(hashes).view(np.int64), "doc_id": np.concatenate(ids),
            "place": np.concatenate(starts).astype(np.int32),
        }

    return map_batches(joined, of, "hash long, doc_id long, place int")


def repeated_spans(
    docs: DataFrame, min_words: int = 50, head: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (doc_id, start_word, n_words, first_doc_id): passages that occur in two or more documents.

    A span is the longest stretch of words all of whose windows of ``min_words`` words
    occur in another document too and first in the same one: ``first_doc_id`` is the
    smallest doc_id that holds them (it may be the document itself).  Words are parted
    by ASCII white space and compared as they are; windows by a 64-bit hash.

    Texts of fewer words and null texts give no rows; rows without a doc_id take no
    part; rows that repeat a doc_id are one document, so a passage in them alone does
    not count as repeated, nor does one repeated within a single document.  Runs jobs.
    """
    if not 0 < head <= min_words // 2:
        raise ValueError("head must be at most half of min_words")
    texts = keyed_texts(docs, id_col, text_col).where("doc_id is not null")
    suffixes = stored(sparse_suffixes(texts, min_words, head))
    windows = candidate_windows(texts, stored(repeated_suffixes(suffixes)), min_words, head)
    repeated = (
        windows.groupBy("hash").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last"))
        .where(F.col("first_doc_id") < F.col("last")).drop("last")
    )
    starts = windows.join(repeated, "hash").select("doc_id", "place", "first_doc_id").distinct()
    return _spans(starts, min_words)


def _spans(starts: DataFrame, min_words: int) -> DataFrame:
    """Joins windows that follow each other; the windows of one document are put in order together."""
    together = starts.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("place", "first_doc_id"))).alias("w"))

    def of(batch):
        out = {k: [] for k in ("doc_id", "start_word", "n_words", "first_doc_id")}
        for doc_id, windows in zip(batch.column(0).to_pylist(), batch.column(1)):
            place = windows.values.field("place").to_numpy(zero_copy_only=False)
            first = windows.values.field("first_doc_id").to_numpy(zero_copy_only=False)
            cut = np.flatnonzero((np.diff(place) != 1) | (np.diff(first) != 0)) + 1
            lo, hi = np.concatenate([[0], cut]), np.concatenate([cut, [len(place)]]) - 1
            out["doc_id"] += [doc_id] * len(lo)
            out["start_word"] += place[lo].tolist()
            out["n_words"] += (place[hi] - place[lo] + min_words).tolist()
            out["first_doc_id"] += first[lo].tolist()
        return out

    return map_batches(together, of, "doc_id long, start_word long, n_words long, first_doc_id long")
