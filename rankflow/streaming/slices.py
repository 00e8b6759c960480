"""Hourly partial counts that a micro-batch adds to and takes from (A1, A2 kept up incrementally).

A slice is one hour of one key and topic: ``((s - 1) h, s h]``. A batch writes
what it changes: the events it adds, and with a minus the stored copies of
ids that it sends again. Counts add up. A latest time cannot be taken back by
subtraction, so where a copy was taken out the batch reads that slice's events
and writes the latest time anew (``reset``); what later batches add goes on
top. The vectors of touched keys are their whole slices inside the window and
the events of the window's two broken hours, if it has any.

Slices are a versioned table, folded in place every ``PARTS`` parts; a batch
that runs again replaces its own part, and only earlier batches are folded.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import micros
from ..operators import features as feat
from ..sinks import bucket_of
from ..sinks.versions import VersionedTable, compact

HOUR = 3_600_000_000
#: parts of a table before they are folded, and versions that readers may still use
PARTS, KEPT = 16, 2


def to_micros(t: str) -> int:
    return int((dt.datetime.fromisoformat(t) - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))


def _slice(ts: str = "event_timestamp"):
    return F.ceil(micros(ts) / F.lit(HOUR)).alias("slice")


def changes(added: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    """(bucket, key, topic, slice, counts, last_event_at, reset) of the events a batch adds and the stored copies it takes out."""
    cols = [key, "topic", "event_type", "event_timestamp"]
    signed = added.select(*cols, F.lit(1).alias("sign")).unionByName(taken.select(*cols, F.lit(-1).alias("sign")))
    counts = [F.sum(F.when(F.col("event_type") == et, F.col("sign")).otherwise(0)).alias(m) for et, m in C.METRIC_FOR_EVENT.items()]
    return signed.groupBy(bucket_of(key).alias("bucket"), key, "topic", _slice()).agg(
        *counts,
        F.max(F.when(F.col("sign") > 0, F.col("event_timestamp"))).alias("last_event_at"),
        F.bool_or(F.col("sign") < 0).alias("reset"),
    )


def with_resets(rows: DataFrame, key: str, current: DataFrame) -> DataFrame:
    """The latest times of slices that lost an event, read from the stored events of those slices."""
    at = [key, "topic", "slice"]
    lost = rows.where("reset").select(*[F.col(c).alias(f"_{c}") for c in at])
    same = [current[key] == F.col(f"_{key}"), current["topic"].eqNullSafe(F.col("_topic")), _slice() == F.col("_slice")]
    known = current.join(lost, same, "left_semi").groupBy(key, "topic", _slice()).agg(F.max("event_timestamp").alias("_last"))
    known = known.select(*[F.col(c).alias(f"_{c}") for c in at], "_last")
    same = [rows[key] == F.col(f"_{key}"), rows["topic"].eqNullSafe(F.col("_topic")), rows["slice"] == F.col("_slice")]
    joined = rows.join(known, same, "left")
    return joined.withColumn("last_event_at", F.when(F.col("reset"), F.col("_last")).otherwise(F.col("last_event_at"))).select(*rows.columns)


def folded(rows: DataFrame, key: str) -> DataFrame:
    """One row per slice: counts added up, the latest time since the last reset."""
    times = F.collect_list(F.struct("version", "last_event_at")).alias("_t")
    since = F.max(F.when(F.col("reset"), F.col("version"))).alias("_since")
    out = rows.groupBy("bucket", key, "topic", "slice").agg(
        *[F.sum(m).alias(m) for m in C.METRICS], F.max("version").alias("version"), since, times
    )
    kept = F.filter("_t", lambda t: F.col("_since").isNull() | (t["version"] >= F.col("_since")))
    last = F.array_max(F.transform(kept, lambda t: t["last_event_at"]))
    return out.withColumn("last_event_at", last).withColumn("reset", F.lit(False)).select(*rows.columns)


def append(table: VersionedTable, rows: DataFrame, key: str, batch: int, oldest: int) -> None:
    """Commits a batch's changes; folds the parts of earlier batches when there are many, without slices before ``oldest``."""
    if sum(p["batch"] < batch for p in table.manifest()["parts"]) >= PARTS:
        keep = F.col("slice") >= oldest
        # the hours that are left out come first: an emptied slice needs no row either
        compact(table, lambda df: folded(df.where(keep), key).where(" + ".join(C.METRICS) + " > 0").sortWithinPartitions("bucket", key), batch)
        table.vacuum(KEPT)
    table.append(rows.withColumn("version", F.lit(int(batch))).sortWithinPartitions("bucket", key), batch)


def counts(
    table: VersionedTable, touched: DataFrame, buckets: list[int], key: str, t: str, window_hours: int, events: Callable[[str, str], DataFrame]
) -> DataFrame:
    """(key, topic, counts, last_event_at) of touched keys, which lie in ``buckets``, over ``(t - window, t]``.

    ``events(lo, hi)`` gives the stored events of an interval; it is asked for
    the broken hours at the window's edges only.
    """
    hi = to_micros(t)
    lo = hi - int(window_hours) * HOUR
    first, last = -(-lo // HOUR) + 1, hi // HOUR
    whole = table.read().where(F.col("bucket").isin(buckets) & F.col("slice").between(first, last)).join(touched, key, "left_semi")
    cols = [key, "topic", *C.METRICS, "last_event_at"]
    rows = folded(whole, key).select(*cols)
    edges = [(lo, hi)] if first > last else [(a, b) for a, b in ((lo, (first - 1) * HOUR), (last * HOUR, hi)) if a < b]
    for a, b in edges:
        part = events(to_text(a), to_text(b)).join(touched, key, "left_semi")
        rows = rows.unionByName(part.groupBy(key, "topic").agg(*feat.metric_counts(), F.max("event_timestamp").alias("last_event_at")).select(*cols))
    total = rows.groupBy(key, "topic").agg(*[F.sum(m).alias(m) for m in C.METRICS], F.max("last_event_at").alias("last_event_at"))
    return total.where(" + ".join(C.METRICS) + " > 0")


def to_text(us: int) -> str:
    return (dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=us)).strftime("%Y-%m-%d %H:%M:%S.%f")
