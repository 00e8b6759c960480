"""Blocks of documents that look their items up in a table of the whole corpus.

A block is one row: a bounded stretch of whole documents with the distinct
items (words, pairs of ids) they hold. Looking up blocks instead of documents
shuffles an item once per block, so a very common item costs no more than the
number of blocks, and what comes back to a block is bounded by its text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.session import checkpoint_dir

#: characters of a block's texts, but for one document that is longer
BLOCK_CHARS = 4_000_000


def grouped(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, list[tuple[int | None, str | None]]]]:
    """(block id, [(doc_id, text)]) of a task's rows in their order; ids are unique over all tasks."""
    first, rows, size = TaskContext.get().partitionId() << 40, [], 0
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        for i in range(batch.num_rows):
            text = texts[i].as_py()
            if rows and size + len(text or "") > limit:
                yield first, rows
                first, rows, size = first + 1, [], 0
            rows.append((ids[i].as_py(), text))
            size += len(text or "")
    if rows:
        yield first, rows


class Numbers(dict):
    """Numbers the items in the order in which they are met."""

    def __missing__(self, item: str) -> int:
        self[item] = n = len(self)
        return n


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The values added up by stretches of these sizes, which may be zero."""
    run = np.concatenate(([0], np.cumsum(values)))
    ends = np.cumsum(sizes)
    return run[ends] - run[ends - sizes]


CODEC = pa.Codec("zstd", 1)


def packed(values: np.ndarray) -> bytes:
    """The numbers, byte plane by byte plane, behind their bytes: the high ones are nearly all zero."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return values.nbytes.to_bytes(8, "little") + CODEC.compress(np.ascontiguousarray(planes).tobytes(), asbytes=True)


def unpacked(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(CODEC.decompress(data[8:], int.from_bytes(data[:8], "little")), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def written(df: DataFrame) -> DataFrame:
    """A frame that several steps read, as Parquet in the shared checkpoint folder: smaller than a checkpoint where rows are wide."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/blocks-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def looked_up(blocks: DataFrame, items: str, table: DataFrame, key: str, values: list[str]) -> DataFrame:
    """(block, values): for every item of a block, in the items' order, the named columns of the table's row."""
    rows = blocks.select("block", F.posexplode(items).alias("at", key))
    found = rows.join(table.select(key, *values), key).groupBy("block").agg(F.collect_list(F.struct("at", *values)).alias("f"))
    in_order = found.select("block", F.array_sort("f").alias("f"))
    return in_order.select("block", *[F.col(f"f.{v}").alias(v) for v in values])
