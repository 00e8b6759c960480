"""Preparation of the vector tables that the two searches share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import saved


def usable(vectors: DataFrame, zeros: bool) -> DataFrame:
    """(vec_id, v array<double>, d, key): the distinct rows; ``d`` is a vector's length, ``key`` its row's hash.

    Null vec_ids, null or empty vectors and vectors with null or non-finite
    components are left out, zero vectors too unless ``zeros``. An id may stand
    on several different vectors; rows that repeat one wholly count once.
    """
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and size(v) > 0")
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.coalesce(finite, F.lit(False)))
    if not zeros:
        rows = rows.where(F.exists("v", lambda x: x != 0.0))
    return saved(rows.distinct().withColumns({"d": F.size("v"), "key": F.xxhash64("vec_id", "v")}))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of an array<double> column as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


#: rows of one shard and queries of one block, of vectors of one length, meet in one group
TOGETHER = ("d", "shard", "block")


def with_shards(rows: DataFrame, queries: DataFrame, shards: int, blocks: int) -> tuple[DataFrame, DataFrame]:
    """Candidates dealt to shards and queries to blocks; each pair of the two meets in one group per length.

    A stated query set against all rows, in blocks: rows are sent once per
    block of queries, queries once per shard. Both are dealt by whole rows, so
    an id that many rows share is spread.
    """
    data = rows.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    asked = queries.withColumn("block", F.pmod(F.xxhash64(F.lit("q"), "key"), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )
    return data, asked
