"""Exact top-k by inner product with a KD-tree per shard.

Components become the integers floor(256 x). A shard's rows are split at the
median of their widest dimension; every node keeps tight bounds of its rows
and their least vec_id. A query goes down best-first: the bound of a box is the
largest inner product that a point in it can have, and the traversal ends when
no box can beat the k-th best. Each query first visits a home shard; the k-th
score found there goes with it to all other shards and prunes them from the start.

Defined results: vectors that are null, or hold null or non-finite components
take no part (zero vectors do); a query meets all other rows of its length,
another vector under its own vec_id included; rows that repeat id and vector
count once; equal scores go to the smaller vec_id; an empty table gives no
rows; other columns are not read. Scores are 64-bit. ``query_key`` tells
queries with one id apart.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import prepare, saved
from rankflow.llm.vectors import TOGETHER, matrix, usable, with_shards

SCALE, LEAF = 256, 256
SHARD_ROWS, BLOCK_QUERIES = 30_000, 20_000
K, EVERY = 5, 50
NO_SCORE = -(1 << 63)


class Tree:
    def __init__(self, ids: np.ndarray, keys: np.ndarray, x: np.ndarray, leaf: int = LEAF):
        order = np.lexsort((keys, ids))
        self.ids, self.keys, self.x = ids[order], keys[order], x[order]
        # doubles are exact below 2^53 and much faster to multiply
        most = float(np.abs(x).max(initial=0))
        self.kind = np.float64 if most * most * x.shape[1] < 2**53 else np.int64
        self.x = self.x.astype(self.kind)
        self.low, self.high, self.first_id, self.children, self.rows = [], [], [], [], []
        todo = [(np.arange(len(ids)), -1, 0)] if len(ids) else []
        while todo:
            rows, parent, side = todo.pop()
            at = len(self.low)
            part = self.x[rows]
            lo, hi = part.min(0), part.max(0)
            self.low.append(lo)
            self.high.append(hi)
            self.first_id.append(int(self.ids[rows[0]]))
            self.children.append([-1, -1])
            self.rows.append(None)
            if parent >= 0:
                self.children[parent][side] = at
            if len(rows) <= leaf:
                self.rows[at] = rows
                continue
            half, d = len(rows) // 2, int((hi - lo).argmax())
            # equal rows are split by id, so that the later half can be left out
            cut = np.argpartition(part[:, d], half) if hi[d] > lo[d] else np.arange(len(rows))
            todo.append((np.sort(rows[cut[half:]]), at, 1))
            todo.append((np.sort(rows[cut[:half]]), at, 0))
        self.low, self.high = np.array(self.low), np.array(self.high)

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """The largest inner product of any point of each node's box, for every query."""
        return np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T

    def top(self, q: np.ndarray, bounds: np.ndarray, k: int, own: tuple[int, int], floor: tuple[int, int]) -> list[tuple[int, int]]:
        """The k best (score, -vec_id) that are above ``floor``, best-first; ``own`` is the query's (vec_id, key)."""
        best: list[tuple[int, int]] = []
        heap = [(-int(bounds[0]), self.first_id[0], 0)] if len(self.low) else []
        while heap:
            bound, least_id, node = heapq.heappop(heap)
            worst = max(floor, best[0]) if len(best) == k else floor
            if -bound < worst[0] or (-bound == worst[0] and -least_id <= worst[1]):
                if -bound < worst[0]:
                    break
                continue
            rows = self.rows[node]
            if rows is None:
                for c in self.children[node]:
                    heapq.heappush(heap, (-int(bounds[c]), self.first_id[c], c))
                continue
            score = self.x[rows] @ q
            if len(best) == k:
                rows, score = rows[score >= worst[0]], score[score >= worst[0]]
            for s, i, key in zip(score.tolist(), self.ids[rows].tolist(), self.keys[rows].tolist()):
                if (i, key) == own or (s, -i) <= floor:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (s, -i))
                elif (s, -i) > best[0]:
                    heapq.heapreplace(best, (s, -i))
        return sorted(best, reverse=True)


def search(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The best of one shard for the queries of one block; scores at or below a query's floor are left out."""
    out: list[tuple[int, int, int, int]] = []
    if left.num_rows and right.num_rows:
        tree = Tree(left.column("vec_id").to_numpy(), left.column("key").to_numpy(), matrix(left.column("v")).astype(np.int64))
        q = matrix(right.column("v")).astype(tree.kind)
        floors = list(zip(right.column("floor").to_pylist(), right.column("floor_id").to_pylist()))
        asked = list(zip(right.column("vec_id").to_pylist(), right.column("key").to_pylist()))
        for at in range(0, len(q), 256):
            bounds = tree.bounds(q[at : at + 256])
            for i, own in enumerate(asked[at : at + 256]):
                out += [(*own, -neg, int(s)) for s, neg in tree.top(q[at + i], bounds[i], k, own, floors[at + i])]
    return pa.table({n: pa.array([o[c] for o in out], pa.int64()) for c, n in enumerate(("query_id", "query_key", "vec_id", "score"))})


def top_products(vectors: DataFrame, k: int = K, every: int = EVERY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score, query_key): the k largest inner products of every row whose vec_id is divisible by ``every``."""
    prepare(vectors.sparkSession)
    rows = usable(vectors, zeros=True)
    rows = rows.withColumn("v", F.transform("v", lambda x: F.floor(x * SCALE).cast("long")))
    queries = rows.where(F.col("vec_id") % every == 0)
    shards, blocks = max(1, -(-rows.count() // shard_rows)), max(1, -(-queries.count() // BLOCK_QUERIES))
    data, asked = with_shards(rows, queries, shards, blocks)
    home = F.pmod(F.xxhash64(F.lit("home"), "key"), F.lit(shards)).cast("int")

    def best(of: DataFrame) -> DataFrame:
        met = data.groupBy(*TOGETHER).cogroup(of.groupBy(*TOGETHER))
        return met.applyInArrow(lambda a, b: search(a, b, k), "query_id long, query_key long, vec_id long, score long")

    none = asked.withColumns({"floor": F.lit(NO_SCORE).cast("long"), "floor_id": F.lit(NO_SCORE).cast("long")})
    found = saved(best(none.where(F.col("shard") == home)))
    if shards > 1:
        kth = found.groupBy("query_id", "query_key").agg(
            F.count("*").alias("n"), F.min(F.struct("score", (-F.col("vec_id")).alias("neg"))).alias("kth")
        )
        kth = kth.where(F.col("n") == k).select("query_id", "query_key", "kth")
        same = (F.col("vec_id") == F.col("query_id")) & (F.col("key") == F.col("query_key"))
        rest = asked.where(F.col("shard") != home).join(kth, same, "left").select(
            # new names of its own: the rows it meets below come from the same table
            *[F.col(c).alias(c) for c in ("vec_id", "v", "d", "key", "block", "shard")],
            F.coalesce("kth.score", F.lit(NO_SCORE).cast("long")).alias("floor"), F.coalesce("kth.neg", F.lit(NO_SCORE).cast("long")).alias("floor_id"),
        )
        found = found.union(best(rest))
    rank = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "query_key")


def query(vectors: DataFrame) -> DataFrame:
    return top_products(vectors)
