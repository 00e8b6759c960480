"""Approximate nearest neighbours by multi-index hashing.

Codes: centred vectors, turned by a learned rotation (principal axes, then
iterative quantisation, fitted in every shard on the ``SAMPLE`` rows of least
hash), give one bit per dimension, ``BITS`` in all. Every row is indexed. A code is split into
substrings of eight bits with an index each. For a radius r, a code within r
bits of the query is within r // substrings bits in some substring (the
pigeonhole), so probing those values retrieves every code within r. The radius
grows until at least ``SHARE`` of the shard (``LEAST`` rows or more) lies within it;
all rows within it are ranked by their original vectors.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part; a query meets all other rows of its length, another
vector under its own vec_id included; rows that repeat id and vector count
once; equal distances go to the smaller vec_id; an empty table gives no rows;
other columns are not read. ``query_key`` tells queries with one id apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import prepare
from rankflow.llm.vectors import TOGETHER, matrix, usable, with_shards

BITS, PART_BITS = 64, 8
SAMPLE, ROUNDS, SEED = 8000, 20, 7
SHARE, LEAST = 0.15, 500
SHARD_ROWS, BLOCK_QUERIES = 60_000, 20_000
K, EVERY = 10, 100
#: all changes of a substring by rising number of bits, and how many there are up to each number
CHANGES = np.array(sorted(range(1 << PART_BITS), key=lambda x: (bin(x).count("1"), x)))
UPTO = np.cumsum(np.bincount([bin(int(x)).count("1") for x in CHANGES]))


def learn(sample: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(mean, rotation): the rotation turns principal axes so that signs lose least."""
    rng = np.random.default_rng(SEED)
    mean = sample.mean(0)
    x = sample - mean
    if x.shape[1] < bits:
        x = np.pad(x, ((0, 0), (0, bits - x.shape[1])))
    _, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, ::-1][:, :bits]
    v = x @ axes
    turn = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
    for _ in range(ROUNDS):
        left, _, right = np.linalg.svd(np.where(v @ turn > 0, 1.0, -1.0).T @ v)
        turn = (left @ right).T
    return mean, axes @ turn


def encode(x: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One row of eight-bit substrings per vector."""
    mean, turn = model
    x = x - mean
    if x.shape[1] < len(turn):
        x = np.pad(x, ((0, 0), (0, len(turn) - x.shape[1])))
    return np.packbits(x @ turn > 0, axis=1)


class Index:
    """One table per substring: the rows of every value."""

    def __init__(self, codes: np.ndarray):
        self.codes = np.ascontiguousarray(codes)
        self.whole = self.codes.view(np.uint64)
        self.parts = codes.shape[1]
        self.rows = [np.argsort(codes[:, j], kind="stable") for j in range(self.parts)]
        self.first = [np.concatenate(([0], np.cumsum(np.bincount(codes[:, j], minlength=256)))) for j in range(self.parts)]

    def within(self, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, distances) of every code within the radius, by probing the substrings."""
        changes = CHANGES[: UPTO[min(radius // self.parts, PART_BITS)]]
        seen = np.zeros(len(self.codes), bool)
        for j in range(self.parts):
            first, rows = self.first[j], self.rows[j]
            for value in (changes ^ int(code[j])).tolist():
                seen[rows[first[value] : first[value + 1]]] = True
        rows = np.flatnonzero(seen)
        far = np.bitwise_count(self.whole[rows] ^ code.view(np.uint64)).sum(1)
        near = far <= radius
        return rows[near], far[near]

    def candidates(self, code: np.ndarray, wanted: int) -> np.ndarray:
        """All rows within the least radius that holds ``wanted`` rows (or all rows)."""
        wanted = min(wanted, len(self.codes))
        radius = self.parts - 1 + 2 * self.parts
        while True:
            rows, far = self.within(code, radius)
            if len(rows) >= wanted:
                enough = int(np.searchsorted(np.cumsum(np.bincount(far)), wanted))
                return rows[far <= enough]
            radius += self.parts


def search(left: pa.Table, right: pa.Table, k: int, share: float, least: int) -> pa.Table:
    """The k nearest found in one shard for the queries of one block, by original vectors."""
    out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    if left.num_rows and right.num_rows:
        left = left.sort_by("key")
        keys, ids, x = left.column("key").to_numpy(), left.column("vec_id").to_numpy(), matrix(left.column("v"))
        q = matrix(right.column("v"))
        model = learn(x[:SAMPLE])
        index = Index(encode(x, model))
        asked = zip(right.column("vec_id").to_pylist(), right.column("key").to_pylist(), q, encode(q, model))
        for own, key, vec, code in asked:
            rows = index.candidates(code, max(least, int(share * len(ids))) + 1)
            rows = rows[(keys[rows] != key) | (ids[rows] != own)]
            far = np.sqrt(((x[rows] - vec) ** 2).sum(1))
            best = np.lexsort((ids[rows], far))[:k]
            out.append((own, key, ids[rows[best]], far[best]))
    sizes = [len(o[2]) for o in out]
    return pa.table({
        "query_id": pa.array(np.repeat(np.array([o[0] for o in out], np.int64), sizes)),
        "query_key": pa.array(np.repeat(np.array([o[1] for o in out], np.int64), sizes)),
        "vec_id": pa.array(np.concatenate([np.empty(0, np.int64), *(o[2] for o in out)])),
        "score": pa.array(np.concatenate([np.empty(0), *(o[3] for o in out)])),
    })


def neighbours(
    vectors: DataFrame, k: int = K, every: int = EVERY, share: float = SHARE, least: int = LEAST, shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """(query_id, rank, vec_id, score, query_key): the k nearest found of every row whose vec_id is divisible by ``every``."""
    prepare(vectors.sparkSession)
    rows = usable(vectors, zeros=False)
    queries = rows.where(F.col("vec_id") % every == 0)
    shards, blocks = max(1, -(-rows.count() // shard_rows)), max(1, -(-queries.count() // BLOCK_QUERIES))
    data, asked = with_shards(rows, queries, shards, blocks)
    near = data.groupBy(*TOGETHER).cogroup(asked.groupBy(*TOGETHER)).applyInArrow(
        lambda a, b: search(a, b, k, share, least), "query_id long, query_key long, vec_id long, score double"
    )
    rank = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "query_key")


def query(vectors: DataFrame) -> DataFrame:
    return neighbours(vectors)
