"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.session import materialize, ship_code

#: rows of an Arrow batch sent to a Python worker (whole texts can be long)
BATCH_ROWS = 250
WORD = "[^\\x20\\x09-\\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Ship the package to the Python workers and keep their batches small."""
    ship_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_rows(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text``: columns of any other name never reach an operator."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def saved(df: DataFrame) -> DataFrame:
    """A frame that several branches read, written once to the shared checkpoint folder."""
    return materialize(df)


def text_key(text: Column) -> list[Column]:
    """Identity of a whole text: its hash from two seeds and its length."""
    return [
        F.xxhash64(text).alias("th"),
        F.xxhash64(F.lit("second"), text).alias("th2"),
        F.coalesce(F.octet_length(text), F.lit(-1)).alias("tn"),
    ]


def texts_of(batch: pa.RecordBatch, name: str = "text") -> Iterator[str | None]:
    """The texts of a batch one by one, without a second copy of the whole batch."""
    col = batch.column(name)
    for i in range(len(col)):
        yield col[i].as_py()


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def shard_count(rows: int, per_shard: int, spark: SparkSession) -> int:
    """Shards of about ``per_shard`` rows, at least as many as shuffle partitions when there is work for them."""
    wanted = -(-max(rows, 1) // per_shard)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(wanted, min(parts, rows // 2000 + 1))


def runs(mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the maximal runs of True."""
    edge = np.diff(np.concatenate(([0], mark.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
