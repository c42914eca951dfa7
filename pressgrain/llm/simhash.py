"""Near copies by SimHash, with candidates pruned on a ring of bit segments.

The 64 bits are cut into ``d + 1`` segments that form a ring, for at most ``d``
differing bits.  If two fingerprints differ in at most ``d`` bits, then from some
segment on every chain of ``l`` consecutive segments differs in at most
``l * d / (d + 1)`` bits.  A chain therefore starts with an equal segment, its
second segment differs in at most one bit, its third brings the sum to at most two,
and so on.  The first two links of the chain are the join key (one side lists the
second segment's one-bit variants); the longer chains prune the candidates that
met before the full distance is counted.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from pressgrain.llm.common import fresh, keyed_texts, map_batches, stored
from pressgrain.llm.components import connected_components

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
_BLOCK = 1 << 16  # shingles unpacked at a time


def shingles(text: str, size: int) -> list[str]:
    words = _WORD.findall(text.translate(_LOWER))
    if len(words) <= size:
        return [" ".join(words)] if words else []
    return list(map(" ".join, zip(*(words[i:] for i in range(size)))))


def fingerprint(text: str, size: int = 4) -> int:
    """The 64 majority bits of the shingles' hashes; zero for a text without words."""
    parts = shingles(text, size)
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(parts), _BLOCK):
        block = parts[at : at + _BLOCK]
        hashes = np.fromiter((digest(s, 42) for s in block), dtype=">u8", count=len(block))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(parts)).view(">u8")[0])


def fingerprints(
    docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (doc_id, bits): one for each input row.  A null text counts as empty."""

    def of(batch):
        texts = batch.column(1).to_pylist()
        bits = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
        return {"doc_id": batch.column(0), "bits": bits}

    return map_batches(keyed_texts(docs, id_col, text_col), of, "doc_id long, bits long")


def segments(distance: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the ring's segments."""
    n = distance + 1
    width = [64 // n + (i < 64 % n) for i in range(n)]
    return [(sum(width[:i]), w) for i, w in enumerate(width)]


def _cut(bits: Column, segment: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(bits, segment[0]).bitwiseAND(F.lit((1 << segment[1]) - 1))


_KEY = ["i", "head", "second"]  # a chain's start, its first segment and the next one


def _entries(prints: DataFrame, distance: int) -> tuple[DataFrame, DataFrame]:
    """Each distinct value ``a`` under the keys of its chains, and ``b`` also under their one-bit variants.

    Values meet only if about two segments agree.  Nulls meet nothing.
    """
    if not 0 < distance < 32:
        raise ValueError("distance must lie between 1 and 31")
    ring = segments(distance)
    n = len(ring)
    values = prints.select("bits").where(F.col("bits").isNotNull()).distinct()

    def key(i: int, flip: int | None) -> Column:
        bits = F.col("bits")
        second = _cut(bits, ring[(i + 1) % n])
        if flip is not None:
            second = second.bitwiseXOR(F.lit(1 << flip))
        head = F.shiftleft(F.lit(i).cast("long"), ring[i][1]).bitwiseOR(_cut(bits, ring[i]))
        return F.struct(F.lit(i).alias("i"), head.alias("head"), second.alias("second"))

    plain = values.select(F.col("bits").alias("a"), F.inline(F.array(*(key(i, None) for i in range(n)))))
    varied = values.select(
        F.col("bits").alias("b"),
        F.inline(F.array(*(key(i, f) for i in range(n) for f in [None, *range(ring[(i + 1) % n][1])]))),
    )
    return plain, varied


def _met(plain: DataFrame, varied: DataFrame, distance: int, wanted: Column) -> DataFrame:
    """Pairs a < b under one key that every longer chain and then the full distance let through."""
    ring = segments(distance)
    n = len(ring)
    differ = F.col("a").bitwiseXOR(F.col("b"))
    chains = F.lit(False)
    for i in range(n):
        kept = F.lit(True)
        for length in range(3, n + 1):
            mask = 0
            for j in range(length):
                low, width = ring[(i + j) % n]
                mask |= ((1 << width) - 1) << low
            mask = mask - (1 << 64) if mask >= 1 << 63 else mask
            within = F.bit_count(differ.bitwiseAND(F.lit(mask).cast("long"))) <= length * distance // n
            kept = kept & within
        chains = chains | ((F.col("p.i") == i) & kept)
    on = (
        (F.col("p.i") == F.col("v.i"))
        & (F.col("p.head") == F.col("v.head"))
        & (F.col("p.second") == F.col("v.second"))
        & (F.col("a") < F.col("b"))
        & wanted
        & chains
        & (F.bit_count(differ) <= distance)
    )
    return plain.alias("p").join(varied.alias("v"), on).select("a", "b")


def near_pairs(prints: DataFrame, distance: int = 4) -> DataFrame:
    """All pairs (a, b), a < b, of the distinct values in ``bits`` that differ in 1 to ``distance`` bits."""
    plain, varied = _entries(prints, distance)
    return _met(plain, varied, distance, F.lit(True)).distinct()


def near_links(prints: DataFrame, distance: int = 4) -> DataFrame:
    """Links (a, b) of 1 to ``distance`` differing bits that connect what ``near_pairs`` connects.

    Each key has a representative, its smallest value.  Other pairs of a key meet only
    if one of the two is not near it.  A value near several representatives keeps its
    link to the smallest of them, and to others only where those do not have the same
    smallest one.  So a dense group of values gives about as many links as values.
    """
    near = lambda x: F.bit_count(F.col(x).bitwiseXOR(F.col("rep"))) <= distance
    plain, varied = _entries(prints, distance)
    reps = plain.groupBy(*_KEY).agg(F.min("a").alias("rep"))
    plain = plain.join(reps, _KEY).select("a", *_KEY, near("a").alias("near_a"))
    varied = varied.join(reps, _KEY).withColumn("near_b", near("b"))
    stars = varied.where(F.col("near_b") & (F.col("b") != F.col("rep"))).select("b", "rep").distinct()
    centres = stars.groupBy("b").agg(F.min("rep").alias("least")).select("b", F.least("b", "least").alias("centre"))
    of_rep = centres.select(F.col("b").alias("rep"), F.col("centre").alias("rep_centre"))
    kept = stars.join(centres, "b").join(of_rep, "rep", "left").where(
        (F.col("rep") == F.col("centre")) | (F.col("centre") != F.coalesce("rep_centre", "rep"))
    )
    links = kept.select(F.least("b", "rep").alias("a"), F.greatest("b", "rep").alias("b"))
    others = _met(plain, varied.drop("rep"), distance, ~(F.col("near_a") & F.col("near_b")))
    return links.unionByName(others).distinct()


def near_copies(
    docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (doc_id, bits, component_id): a document's fingerprint and its group.

    Equal fingerprints and those within ``distance`` bits are linked;
    ``component_id`` is the smallest doc_id reachable.  Equal fingerprints are
    grouped before any pair is made, so copies never meet each other.

    One row for each input row: repeated rows are repeated; a null doc_id gets the
    group of its text but names none (null if no other document is in it); texts
    without words share the fingerprint zero.  Runs jobs.
    """
    prints = stored(fingerprints(docs, shingle, id_col, text_col))
    values = stored(prints.groupBy("bits").agg(F.min("doc_id").alias("first_id")))
    roots = connected_components(near_links(values, distance))
    grouped = values.join(roots, values["bits"] == roots["node"], "left").select(
        "bits", "first_id", F.coalesce("root", "bits").alias("root")
    )
    names = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_value = stored(grouped.join(names, "root").select("bits", "component_id"))
    return prints.join(of_value, "bits").select("doc_id", "bits", "component_id")


def hex16(bits: str = "bits") -> Column:
    return F.lower(F.lpad(F.hex(F.col(bits)), 16, "0"))


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """The documents that name their group; all columns stay.

    Rows without a doc_id stay; rows repeating a doc_id stand for one document and
    stay or go together.  Runs jobs.
    """
    groups = near_copies(docs, shingle, distance)
    gone_id = fresh(docs, "gone_id")
    gone = (
        groups.groupBy("doc_id")
        .agg(F.min("component_id").alias("component_id"))
        .where(F.col("doc_id") != F.col("component_id"))
        .select(F.col("doc_id").alias(gone_id))
    )
    return docs.join(stored(gone), docs["doc_id"] == F.col(gone_id), "left_anti")
