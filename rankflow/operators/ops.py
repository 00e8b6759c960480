"""Pipeline-health aggregates over an operations log.

Dashboard expressions (rates, increases, quantiles from histogram buckets)
re-aimed at a log table: ``ts, service, operation, topic, outcome,
duration_seconds``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import micros, ts_lit


def _seconds(duration: str) -> int:
    n, unit = duration.split()
    return int(n) * {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600}[unit]


def rate(log: DataFrame, by: Sequence[str], window: str = "5 minutes", slide: str | None = None) -> DataFrame:
    """Events per second in each (sliding) window and group."""
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    agg = log.groupBy(w.alias("w"), *by).agg(F.count("*").alias("events"))
    return agg.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        *by,
        "events",
        (F.col("events") / F.lit(float(_seconds(window)))).alias("rate_per_second"),
    )


def increase(log: DataFrame, by: Sequence[str], window: str = "15 minutes") -> DataFrame:
    """O2: count increase per tumbling window and group."""
    agg = log.groupBy(F.window("ts", window).alias("w"), *by).agg(F.count("*").alias("increase"))
    return agg.select(F.col("w.start").alias("window_start"), *by, "increase")


def quantile_exact(log: DataFrame, by: Sequence[str], value: str = "duration_seconds", q: float = 0.95) -> DataFrame:
    """Exact quantile with linear interpolation (the ``percentile`` /
    ``quantile_cont`` definition) without holding a group's rows in one task.

    Rows are counted per value range first (a 64th of a power of two, so a few
    thousand ranges per group at most); only the ranges that hold the two
    order statistics around ``q * (n - 1)`` are then counted by value."""
    part = F.when(F.col(value) > 0, F.floor(F.log2(value) * 64)).otherwise(F.when(F.col(value) == 0, -(1 << 20)).otherwise(-(1 << 21)))
    rows = log.filter(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"), part.cast("long").alias("_part"))
    ranges = rows.groupBy(*by, "_part").agg(F.count("*").alias("_n"))
    order = Window.partitionBy(*by).orderBy("_part")
    ranges = ranges.select(
        *by, "_part", (F.sum("_n").over(order) - F.col("_n")).alias("_below"), F.sum("_n").over(order).alias("_upto"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("samples"),
    )
    pos = F.lit(q) * (F.col("samples") - 1)
    lo_i, hi_i = F.floor(pos) + 1, F.ceil(pos) + 1
    holds = lambda i: (F.col("_below") < i) & (i <= F.col("_upto"))
    aimed = ranges.filter(holds(lo_i) | holds(hi_i)).drop("_upto")
    cond = [F.col(f"r.{c}").eqNullSafe(F.col(f"a.{c}")) for c in [*by, "_part"]]
    near = rows.alias("r").join(aimed.alias("a"), cond).select(*[f"r.{c}" for c in [*by, "_part", "_v"]], "_below", "samples")
    counts = near.groupBy(*by, "_part", "_below", "samples", "_v").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*by, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    cum = counts.withColumn("_cum", F.col("_below") + F.sum("_n").over(w))
    agg = cum.groupBy(*by).agg(
        F.min(F.when(F.col("_cum") >= lo_i, F.col("_v"))).alias("_lo"),
        F.min(F.when(F.col("_cum") >= hi_i, F.col("_v"))).alias("_hi"),
        F.max("samples").alias("samples"),
    )
    frac = pos - F.floor(pos)
    return agg.select(*by, (F.col("_lo") + frac * (F.col("_hi") - F.col("_lo"))).alias("_q"), "samples")


def p95(log: DataFrame, by: Sequence[str], value: str = "duration_seconds", q: float = 0.95) -> DataFrame:
    """O3: exact p95 per group, in seconds at microsecond resolution."""
    r = quantile_exact(log, by, value, q)
    return r.select(*by, F.round("_q", 6).alias("p95_seconds"), "samples")


def p95_approx(log: DataFrame, by: Sequence[str], value: str = "duration_seconds", q: float = 0.95) -> DataFrame:
    """O3 at scale: bounded-memory quantile sketch per group."""
    return log.groupBy(*by).agg(F.percentile_approx(value, q, 10000).alias("p95_seconds"))


def latency_buckets(
    log: DataFrame, by: Sequence[str], value: str = "duration_seconds", bounds: Sequence[float] = C.LATENCY_BUCKETS
) -> DataFrame:
    """Cumulative histogram buckets ``(by, le, count)`` including ``+Inf``,
    as a metrics exporter would publish them."""
    les = list(bounds) + [float("inf")]
    idx = F.lit(len(bounds))
    for i in range(len(bounds) - 1, -1, -1):
        idx = F.when(F.col(value) <= F.lit(bounds[i]), F.lit(i)).otherwise(idx)
    per = log.groupBy(*by, idx.alias("_i")).agg(F.count("*").alias("_n"))
    grid = log.select(*by).distinct().select(*by, F.explode(F.array(*[F.lit(i) for i in range(len(les))])).alias("_i"))
    le_arr = F.array(*[F.lit(x) for x in les])
    filled = grid.join(per, [*by, "_i"], "left").fillna({"_n": 0})
    w = Window.partitionBy(*by).orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    return filled.select(
        *by, F.element_at(le_arr, F.col("_i") + 1).alias("le"), F.sum("_n").over(w).alias("count"), "_i"
    ).drop("_i")


def histogram_quantile(buckets: DataFrame, by: Sequence[str], q: float = 0.95) -> DataFrame:
    """O3: quantile from cumulative buckets, linear inside the bucket; a rank
    in the +Inf bucket returns the largest finite bound."""
    w = Window.partitionBy(*by).orderBy("le")
    b = (
        buckets.withColumn("_prev_le", F.coalesce(F.lag("le").over(w), F.lit(0.0)))
        .withColumn("_prev_n", F.coalesce(F.lag("count").over(w), F.lit(0)))
        .withColumn("_total", F.max("count").over(Window.partitionBy(*by)))
        .withColumn("_max_finite", F.max(F.when(F.col("le") != F.lit(float("inf")), F.col("le"))).over(Window.partitionBy(*by)))
    )
    rank = F.lit(q) * F.col("_total")
    hit = b.filter((F.col("count") >= rank) & (F.col("_total") > 0))
    first = hit.withColumn("_r", F.row_number().over(w)).filter("_r = 1")
    value = F.when(F.col("le") == F.lit(float("inf")), F.col("_max_finite")).otherwise(
        F.col("_prev_le")
        + (F.col("le") - F.col("_prev_le"))
        * F.when(F.col("count") > F.col("_prev_n"), (rank - F.col("_prev_n")) / (F.col("count") - F.col("_prev_n"))).otherwise(F.lit(0.0))
    )
    return first.select(*by, F.round(value, 6).alias("quantile_seconds"))


def lag(offsets: DataFrame) -> DataFrame:
    """Consumer lag per partition: ``max(end - current, 0)``, current
    falling back to the low watermark."""
    cur = F.coalesce(F.col("current_offset"), F.col("low_offset"))
    return offsets.select(
        "topic", "partition", F.greatest(F.col("end_offset") - cur, F.lit(0)).alias("lag")
    )


def lag_from_progress(progress_json: DataFrame, col: str = "json") -> DataFrame:
    """O5 from streaming progress JSON: per source and partition, the
    difference between ``latestOffset`` and ``endOffset``."""
    m = "map<string,map<string,long>>"
    p = progress_json.select(F.explode(F.from_json(F.col(col), "struct<sources:array<struct<description:string,endOffset:string,latestOffset:string>>>")["sources"]).alias("s"))
    end = F.from_json(F.col("s.endOffset"), m)
    latest = F.from_json(F.col("s.latestOffset"), m)
    rows = p.select(F.col("s.description").alias("source"), F.explode(latest).alias("topic", "parts"), end.alias("_end"))
    return rows.select(
        "source", "topic", F.explode("parts").alias("partition", "end_offset"), F.col("_end")
    ).select(
        "source",
        "topic",
        "partition",
        F.greatest(F.col("end_offset") - F.coalesce(F.col("_end")[F.col("topic")][F.col("partition")], F.lit(0)), F.lit(0)).alias("lag"),
    )


def flushes(snapshots: DataFrame, latest: DataFrame) -> DataFrame:
    """Snapshot flushes, the last one, and the keys changed since (dirty)."""
    done = snapshots.agg(F.countDistinct("batch_id").alias("flushes"), F.max("snapshot_at").alias("last_flush_at"))
    since = snapshots.agg(F.max("snapshot_at")).scalar()
    dirty = latest.filter(since.isNull() | (F.col("updated_at") > since)).agg(F.count("*").alias("dirty_keys"))
    return done.withColumn("dirty_keys", dirty.scalar())


def flush_report(flushes: DataFrame) -> DataFrame:
    """O6 per flush, from the table the job writes: records, rejected ones, keys written, newest event."""
    return flushes.groupBy("batch_id").agg(
        F.sum("processed").alias("processed"), F.sum("failed").alias("failed"), F.max("content_keys").alias("content_keys"),
        F.max("user_keys").alias("user_keys"), F.max("last_processed_at").alias("last_processed_at"), F.max("flushed_at").alias("flushed_at"),
    )


def lag_after(flushes: DataFrame, ends: DataFrame, batch_id: int) -> DataFrame:
    """O5 after a flush: ``ends`` (topic, partition, low_offset, end_offset) against the offsets flushed until then."""
    done = flushes.filter(F.col("batch_id") <= batch_id).groupBy("topic", "partition").agg(F.max("current_offset").alias("current_offset"))
    return lag(ends.join(done, ["topic", "partition"], "left"))


def freshness(validated: DataFrame) -> DataFrame:
    """Processed / failed totals, last processed event, touched keys."""
    ok = F.size("errors") == 0
    return validated.agg(
        F.count_if(ok).alias("processed"),
        F.count_if(~ok).alias("failed"),
        F.max(F.when(ok, F.col("event_timestamp"))).alias("last_processed_at"),
        F.countDistinct(F.when(ok, F.col("content_id"))).alias("content_keys"),
        F.countDistinct(F.when(ok, F.col("user_id"))).alias("user_keys"),
    )


def availability(heartbeats: DataFrame, now: str, max_age_seconds: int = 60) -> DataFrame:
    """A service is up when its latest heartbeat is recent enough."""
    last = heartbeats.groupBy("service").agg(F.max("ts").alias("last_seen"))
    age = (micros(ts_lit(now)) - micros("last_seen")) / F.lit(1_000_000.0)
    return last.select("service", "last_seen", (age <= max_age_seconds).alias("up"))
