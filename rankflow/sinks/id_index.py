"""Which batches may hold an event id: split-block Bloom filters, one per batch, kept as rows.

An id sets one bit in each of the eight 32-bit words of one block. A batch's
filter has a power of two of blocks, about ``BITS`` bits per id, and its rows
are (blocks as a power of two, block, eight words), so that looking up the ids
of a new batch is an equi-join with the blocks they fall into. Reading the
filters instead of the stored ids costs 3 bytes an id, and only the batches
that a filter names are opened.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS, BLOCK_BITS, BITS = 8, 256, 24
SCHEMA = "size int, block long, " + ", ".join(f"w{i} int" for i in range(WORDS)) + ", batch_id int"


def _masks(key: str) -> list[Column]:
    h = F.xxhash64(F.lit("bits"), F.col(key))
    bit = [F.shiftright(h, 5 * i).bitwiseAND(F.lit(31)).cast("int") for i in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1), b).alias(f"m{i}") for i, b in enumerate(bit)]


def _block(key: str, size: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), F.col(key)), F.call_function("shiftleft", F.lit(1).cast("long"), size))


def blooms(ids: DataFrame, key: str, n: int) -> DataFrame:
    """The rows of the filter of ``n`` ids."""
    size = max(math.ceil(math.log2(max(n, 1) * BITS / BLOCK_BITS)), 0)
    rows = ids.select(F.lit(size).alias("size"), _block(key, F.lit(size)).alias("block"), *_masks(key))
    return rows.groupBy("size", "block").agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS)])


def may_hold(ids: DataFrame, key: str, filters: DataFrame) -> list[int]:
    """The batches whose filter has any of the ids: at most one number per stored batch reaches the driver."""
    sizes = [r.size for r in filters.select("size").distinct().collect()]
    if not sizes:
        return []
    asked = ids.select(key, *_masks(key), F.explode(F.array(*[F.lit(s) for s in sorted(sizes)])).alias("size"))
    asked = asked.withColumn("block", _block(key, F.col("size")))
    hit = F.lit(True)
    for i in range(WORDS):
        hit = hit & (F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
    found = asked.join(filters, ["size", "block"]).where(hit).select("batch_id").distinct()
    return sorted(r.batch_id for r in found.collect())
