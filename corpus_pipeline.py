"""From documents to packed training sequences: each stage reads what the one before wrote."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pressgrain.llm import decontam, packing, quality, secret_scan, simhash
from pressgrain.llm.common import fresh, prepare, table
from pressgrain.session import shared_dir

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model, learned from the labels, accepts."""
    prepare(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    prepare(spark)
    return simhash.keep_one(docs, shingle=4, distance=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark."""
    prepare(spark)
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced and ``n_chars`` counted anew where text changed."""
    prepare(spark)
    name = fresh(docs, "clean_text")
    clean = docs.withColumn(name, secret_scan.redact(F.col("text")))
    n_chars = F.when(F.col(name).eqNullSafe(F.col("text")), F.col("n_chars")).otherwise(F.length(name).cast("long"))
    return clean.withColumn("n_chars", n_chars).withColumn("text", F.col(name)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences."""
    prepare(spark)
    return packing.pack(docs, TOKENIZER, window=2048, end_id=1)


STAGES = [
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("secret_scans", without_secrets),
    ("packing", packed),
]

# Trained models, compression and tokenizers are beyond SQL; tests/llm holds the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; runs jobs and writes each stage to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs
