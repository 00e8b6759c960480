"""SimHash near-duplicates by the generalised pigeonhole.

Fingerprints: lower-case A-Z, split at ASCII white space, hash every word
shingle with XXH64 (seed 42); a bit is 1 if more than half of the hashes set it.

Links: two fingerprints link when at most ``max_distance`` bits differ. The 64
bits are dealt into partitions so that correlated bits stand together; every
fingerprint then gets its own thresholds, one per partition, with
``sum(threshold + 1) = max_distance + 1`` (-1 skips a partition), which by the
pigeonhole lose no link. Dynamic programming picks those with the fewest
estimated candidates from the partitions' value counts over all fingerprints.
Values within a threshold are probed, and every candidate is verified on all
64 bits. Buckets give a spanning forest of their links, never all pairs.

Defined results: a null text and a text without words have fingerprint zero;
repeated rows each get a row; ``component_id`` is the smallest non-null doc_id
reachable (null when there is none); an empty table gives no rows; other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import prepare, saved, shard_count, text_key, text_rows, texts_of
from rankflow.llm.graph import components, local_forest

SEED, BITS = 42, 64
SHINGLE, MAX_DISTANCE = 3, 3
PARTITIONS = 4
#: shingles whose bits are counted at a time
BLOCK = 1 << 14
#: rows of a bucket shard, members of a bucket block, pairs verified at a time
SHARD_ROWS, BLOCK_MEMBERS, PAIRS = 400_000, 50_000, 2_000_000
#: estimated candidates that one probe of a bucket costs beside those it finds
PROBE_COST = 2.0


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    k = min(shingle, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    of, n = xxhash.xxh64_intdigest, len(words) - k + 1
    hashes = np.fromiter(
        (of(line[s:e], SEED) for s, e in zip(starts[:n].tolist(), ends[k - 1 :].tolist())), np.uint64, n
    )
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, BLOCK):
        part = hashes[at : at + BLOCK]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, th, th2, tn): fp is the fingerprint as a signed long, the rest is the text's identity."""
    schema = "doc_id long, th long, th2 long, tn int, fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in texts_of(b)), np.uint64, b.num_rows).view(np.int64)
            kept = [b.column(c) for c in ("doc_id", "th", "th2", "tn")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(fp)], ["doc_id", "th", "th2", "tn", "fp"])

    rows = text_rows(docs)
    return rows.select("doc_id", "text", *text_key(F.col("text"))).mapInArrow(run, schema)


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fp).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_groups(distinct: DataFrame, parts: int = PARTITIONS) -> list[list[int]]:
    """The 64 bits in ``parts`` groups of equal width, correlated bits together.

    Co-occurrence counts come from all fingerprints (64 x 64 sums per task,
    added up by Spark); the driver receives 4096 numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        n = 0
        for b in batches:
            x = _bits(b.column("fp").to_numpy(zero_copy_only=False)).astype(np.float64)
            total += x.T @ x
            n += len(x)
        if n:
            flat = np.concatenate((total.ravel(), [n])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["i", "v"])

    both = np.zeros(BITS * BITS + 1)
    for r in distinct.select("fp").mapInArrow(run, "i int, v long").groupBy("i").agg(F.sum("v").alias("v")).collect():
        both[r.i] = r.v
    n, both = max(both[-1], 1), both[:-1].reshape(BITS, BITS)
    mean = np.diag(both) / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    like = np.abs(both / n - np.outer(mean, mean)) / np.outer(spread, spread)
    np.fill_diagonal(like, 0)
    left, groups = set(range(BITS)), []
    for g in range(parts):
        rest = sorted(left)
        width = -(-len(rest) // (parts - g))
        group = [rest[int(like[np.ix_(rest, rest)].max(1).argmax())]]
        while len(group) < width:
            rest = sorted(left - set(group))
            group.append(rest[int(like[np.ix_(rest, group)].mean(1).argmax())])
        left -= set(group)
        groups.append(group)
    return groups


def values(fp: np.ndarray, groups: list[list[int]]) -> np.ndarray:
    """One row per partition: the value of its bits for every fingerprint."""
    bits = _bits(fp)
    return np.stack([(bits[:, g].astype(np.int64) << np.arange(len(g))).sum(1) for g in groups])


def masks(width: int, radius: int) -> np.ndarray:
    """All changes of exactly ``radius`` bits."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(width), radius)], np.int64)


def allocate(counts: list[list[np.ndarray]], vals: np.ndarray, distance: int) -> np.ndarray:
    """Thresholds of every fingerprint (partitions x n), -1 for a partition it does not probe.

    counts[p][t][v]: estimated cost of probing partition p at threshold t from
    value v. Dynamic programming over the partitions with the pigeonhole's
    budget of ``distance + 1``.
    """
    parts, n, budget = len(counts), vals.shape[1], distance + 1
    best = np.full((budget + 1, n), np.inf)
    best[0] = 0
    picks = []
    for p in range(parts):
        new, pick = np.full((budget + 1, n), np.inf), np.zeros((budget + 1, n), np.int8)
        for spend in range(budget + 1):
            cost = 0.0 if spend == 0 else counts[p][spend - 1][vals[p]]
            for have in range(budget + 1 - spend):
                total = best[have] + cost
                better = total < new[have + spend]
                new[have + spend][better] = total[better]
                pick[have + spend][better] = spend
        best = new
        picks.append(pick)
    out, at, i = np.empty((parts, n), np.int8), np.full(n, budget), np.arange(n)
    for p in reversed(range(parts)):
        out[p] = picks[p][at, i] - 1
        at = at - picks[p][at, i]
    return out


def _ball_costs(hist: np.ndarray, width: int, distance: int) -> list[np.ndarray]:
    """Members within each threshold of every value, and what the probes cost."""
    v, out, total = np.arange(1 << width), [], np.zeros(1 << width)
    for radius in range(distance + 1):
        m = masks(width, radius)
        # radii beyond 1 are estimated from the mean count: exact sums would read the table 500 times
        total = total + (sum(hist[v ^ x] for x in m) if radius < 2 else len(m) * hist.mean()) + PROBE_COST * len(m)
        out.append(total.copy())
    return out


def _pairs(bucket: np.ndarray, fp: np.ndarray, role: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified links between probes (role 2) and members (role 1) of equal buckets, in blocks of bounded size."""
    members, probes = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
    members, probes = members[np.argsort(bucket[members], kind="stable")], probes[np.argsort(bucket[probes], kind="stable")]
    lo = np.searchsorted(bucket[members], bucket[probes], "left")
    n = np.searchsorted(bucket[members], bucket[probes], "right") - lo
    ends = np.cumsum(n)
    at = 0
    while at < len(probes):
        done = ends[at - 1] if at else 0
        to = max(int(np.searchsorted(ends, done + PAIRS, "right")), at + 1)
        k = n[at:to]
        shift = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        q = np.repeat(fp[probes[at:to]], k)
        x = fp[members[np.repeat(lo[at:to], k) + shift]]
        ok = (np.bitwise_count((q ^ x).view(np.uint64)) <= distance) & (q != x)
        yield q[ok], x[ok]
        at = to


def links(distinct: DataFrame, distance: int = MAX_DISTANCE, parts: int = PARTITIONS) -> DataFrame:
    """(a, b): edges between distinct fingerprints whose components are those of all links."""
    spark = distinct.sparkSession
    groups = bit_groups(distinct, parts)
    widths = [len(g) for g in groups]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = values(b.column("fp").to_numpy(zero_copy_only=False), groups)
            key = np.concatenate([(p << 32) + x for p, x in enumerate(v)])
            key, n = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], ["key", "n"])

    # bounded by the number of values a partition can take, 2^16 at four partitions
    seen = distinct.select("fp").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    hist = [np.zeros(1 << w) for w in widths]
    keys, ns = seen["key"].to_numpy(np.int64), seen["n"].to_numpy(np.float64)
    for p in range(parts):
        own = keys >> 32 == p
        hist[p][keys[own] & 0xFFFFFFFF] = ns[own]
    rows = int(hist[0].sum())
    shared = spark.sparkContext.broadcast((hist, [_ball_costs(h, w, distance) for h, w in zip(hist, widths)]))
    shards = shard_count(rows * parts, SHARD_ROWS, spark)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hist, costs = shared.value
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False)
            if not len(fp):
                continue
            v = values(fp, groups)
            taus = allocate(costs, v, distance)
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
            for p in range(parts):
                blocks = np.maximum(1, np.ceil(hist[p] / BLOCK_MEMBERS)).astype(np.int64)
                exact = taus[p] >= 0
                single = blocks[v[p]] == 1
                own = (fp.view(np.uint64) % blocks[v[p]].astype(np.uint64)).astype(np.int64)
                out.append(((p << 32) + v[p], own, fp, np.where(exact & single, 3, 1)))
                for radius in range(distance + 1):
                    wide = np.flatnonzero((taus[p] >= radius) & ~(single if radius == 0 else False))
                    for mask in masks(widths[p], radius):
                        to = v[p][wide] ^ mask
                        k = np.where(hist[p][to] > 0, blocks[to], 0)
                        at = np.repeat(wide, k)
                        block = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
                        out.append(((p << 32) + np.repeat(to, k), block, fp[at], np.full(len(at), 2)))
            bucket, block, f, role = (np.concatenate(x) for x in zip(*out))
            bucket = bucket + (block << 40)
            mixed = (bucket.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
            yield pa.RecordBatch.from_arrays(
                [pa.array((mixed % np.uint64(shards)).astype(np.int32)), pa.array(bucket), pa.array(f), pa.array(role.astype(np.int8))],
                ["shard", "bucket", "fp", "role"],
            )

    def verify(t: pa.Table) -> pa.Table:
        bucket, fp, role = (t.column(c).to_numpy() for c in ("bucket", "fp", "role"))
        a, b = np.empty(0, np.int64), np.empty(0, np.int64)
        for q, x in _pairs(bucket, fp, role, distance):
            a, b = local_forest(np.concatenate((a, q)), np.concatenate((b, x)))
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    dealt = distinct.select("fp").mapInArrow(deal, "shard int, bucket long, fp long, role byte")
    return dealt.groupBy("shard").applyInArrow(verify, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, th, th2, tn, fp, component_id) per row of ``docs`` (see the module's text)."""
    prepare(docs.sparkSession)
    rows = saved(fingerprints(docs, shingle))
    distinct = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(distinct, distance))
    placed = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = placed.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp")


def query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, shingle: int = SHINGLE, distance: int = MAX_DISTANCE) -> DataFrame:
    """All columns of one row per component: the smallest doc_id (nulls last), one of it if it repeats."""
    found = near_duplicates(docs, shingle, distance)
    # rows without any doc_id in their component have no component_id; their fingerprints' roots keep them apart
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp"), F.col("fp").cast("string")))
    best = (
        found.groupBy(group.alias("g"))
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tn", "th", "th2")).alias("k"))
        .select(F.col("k.doc_id").alias("__k_id"), F.col("k.th").alias("__k_th"), F.col("k.th2").alias("__k_th2"), F.col("k.tn").alias("__k_tn"))
    )
    th, th2, tn = text_key(docs["text"].cast("string"))
    keyed = docs.withColumns({"__th": th, "__th2": th2, "__tn": tn, "__id": docs["doc_id"].cast("long")})
    cond = (
        F.col("__id").eqNullSafe(F.col("__k_id"))
        & (F.col("__th") == F.col("__k_th"))
        & (F.col("__th2") == F.col("__k_th2"))
        & (F.col("__tn") == F.col("__k_tn"))
    )
    hit = keyed.join(best, cond)
    once = hit.dropDuplicates(["__id", "__th", "__th2", "__tn"])
    return once.select(*[F.col(f"`{c}`") for c in docs.columns])
