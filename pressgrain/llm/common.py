"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math
import re
import shutil
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import pressgrain
from pressgrain.session import shared_dir, tune
from pressgrain.sources.stored import stored

# Rows of one Arrow batch.  Texts can be long, so batches hold few of them.
BATCH_ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings for speed and bounded batches; results do not depend on them.

    Python workers import this package.  On a cluster it is installed or handed over
    with ``--py-files``; a local session, whose workers may start in any folder, gets
    it from here.
    """
    tune(spark)
    _hand_over(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


_HANDED_OVER: set[str] = set()  # applications


def _hand_over(spark: SparkSession) -> None:
    context = spark.sparkContext
    folder = shared_dir(spark).removeprefix("file://") if re.match(r"local($|\[)", context.master) else ""
    if folder.startswith("/") and context.applicationId not in _HANDED_OVER:
        _HANDED_OVER.add(context.applicationId)
        root = Path(pressgrain.__file__).resolve().parent.parent
        name = f"{folder}/package-{context.applicationId}/pressgrain"
        context.addPyFile(shutil.make_archive(name, "zip", root, "pressgrain"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, under fixed names; null texts are empty."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, in whatever case: the name given, or it with underscores."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def per_batch(fn: Callable[[pa.RecordBatch], dict], schema: str) -> Callable:
    """Wrap a function from a batch to columns for ``mapInArrow``; the schema is Spark's."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = fn(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) for f in arrow], schema=arrow
                )

    return run


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    return df.mapInArrow(per_batch(fn, schema), schema)


def presence_bits(keys: DataFrame, column: str, most_log2: int = 28, per_key: int = 16) -> np.ndarray:
    """A bit map of the 64-bit keys that occur: about ``per_key`` bits for each, at most 2**most_log2.

    It only spares a shuffle the rows that cannot join (32 MB at the most, whatever the
    number of keys); what it lets through wrongly falls away in the join.  Runs jobs.
    """
    log2 = min(most_log2, max(16, math.ceil(math.log2(per_key * keys.count() + 1))))
    slot = F.shiftrightunsigned(column, 64 - log2)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    words = keys.select(F.shiftright(slot, 6).alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    bits = np.zeros(1 << (log2 - 6), dtype=np.int64)
    found = words.toArrow()
    bits[found.column("w").to_numpy()] = found.column("b").to_numpy()
    return bits.view(np.uint64)


def present(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which of the keys (unsigned) may be in the bit map."""
    slot = keys >> np.uint64(64 - (len(bits).bit_length() + 5))
    return (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def may_be_in(key: Column, bits: np.ndarray, spark: SparkSession) -> Column:
    """Whether a 64-bit key may be in the bit map; only the key goes to Python."""
    shared = spark.sparkContext.broadcast(bits)

    def of(keys: pd.Series) -> pd.Series:
        return pd.Series(present(keys.to_numpy(dtype=np.int64).view(np.uint64), shared.value))

    return F.pandas_udf(of, "boolean")(key)


__all__ = [
    "BATCH_ROWS", "fresh", "keyed_texts", "map_batches", "may_be_in", "per_batch", "prepare", "presence_bits", "present", "stored", "table",
]
