"""One query per operator over the whole of its table, and SQL where it can say the same."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pressgrain.llm import alignment, decontam, divergence, licences, merkle, packing, paragraphs, pivots, quality, secret_scan, simhash, suffixes, warc
from pressgrain.llm.common import table
from pressgrain.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query()
def op1_simhash(spark, sf):
    groups = simhash.near_copies(table(spark, sf, "documents"), shingle=4, distance=4)
    return groups.select("doc_id", simhash.hex16().alias("fingerprint"), "component_id")


@query()
def op2_decontamination(spark, sf):
    return decontam.leaked(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query()
def op3_secrets(spark, sf):
    return secret_scan.scan(table(spark, sf, "documents"))


@query()
def op5_packing(spark, sf):
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf, "documents"), path, window=2048, end_id=1)


@query()
def op6_quality(spark, sf):
    return quality.score_documents(table(spark, sf, "documents"), table(spark, sf, "labels"), threshold=0.7)


@query(merkle.COMPARE_SQL)
def op9_fingerprints(spark, sf):
    return merkle.compare_with_edits(table(spark, sf, "documents"))


@query("""
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest FROM p),
    k AS (SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS kept FROM d)
    SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
           CASE WHEN n >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 1000 AND page_id <> kept THEN kept END AS refers_to, true AS intact
    FROM k
""")
def op4_warc(spark, sf):
    return warc.round_trip(table(spark, sf, "pages"), f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}")


@query()
def op7_licences(spark, sf):
    return licences.scan(table(spark, sf, "documents"))


@query()
def op10_suffix_arrays(spark, sf):
    return suffixes.repeated_spans(table(spark, sf, "documents"), min_words=50)


@query()
def op8_paragraphs(spark, sf):
    return paragraphs.repeated_passages(table(spark, sf, "documents"), threshold=0.8)


@query(divergence.AUDIT_SQL)
def op11_divergence(spark, sf):
    return divergence.audit(table(spark, sf, "documents"), min_docs=10, ranks=10)


@query()
def op12_alignment(spark, sf):
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.agreement(table(spark, sf, "documents"), a, b)


@query()
def op13_pivots(spark, sf):
    return pivots.near_vectors(table(spark, sf, "embeddings"), threshold=0.9)
