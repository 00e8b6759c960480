"""Rolling ranking features.

Counts are a static pivot: one ``count_if`` per metric inside a hash
aggregate, so a content that carries a third of all events is reduced
map-side before the shuffle (partial + final aggregate). The latest topic
comes from a second, small aggregate over the topics of each key.

The window is ``(as_of - window_hours, as_of]``; ``as_of`` is always a
parameter so results are reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import (
    affinity_raw,
    affinity_ratio,
    micros,
    ratio,
    rate_of,
    round6,
    trending_decay,
    trending_from,
    trending_ratios,
    trending_raw,
    ts_lit,
)


def _check_window(window_hours: int) -> int:
    if not (C.FEATURE_WINDOW_MIN_HOURS <= int(window_hours) <= C.FEATURE_WINDOW_MAX_HOURS):
        raise ValueError(f"window_hours must be within 1..720, got {window_hours}")
    return int(window_hours)


def in_window(ts: str, as_of: str, window_hours: int) -> Column:
    """``ts > as_of - window and ts <= as_of`` as two literal bounds (pushed to the scan)."""
    now = ts_lit(as_of)
    lo = F.timestamp_micros(micros(now) - F.lit(int(window_hours) * 3_600_000_000))
    return (F.col(ts) > lo) & (F.col(ts) <= now)


def metric_counts() -> list[Column]:
    """Event type -> metric pivot (A3): seven ``count_if`` aggregates."""
    return [F.expr(f"count_if(event_type = '{et}')").alias(m) for et, m in C.METRIC_FOR_EVENT.items()]


def dedupe_events(interactions: DataFrame, arrival: str | None = None) -> DataFrame:
    """Idempotent counting (I2): one row per event id; a re-sent id keeps the
    last arrival (and therefore its newer timestamp). An aggregate, so many
    copies of one id are reduced map-side."""
    if arrival is None:
        return interactions.dropDuplicates(["event_id"])
    others = [c for c in interactions.columns if c != "event_id"]
    return interactions.groupBy("event_id").agg(F.max_by(F.struct(*others), F.col(arrival)).alias("_r")).select(
        "event_id", "_r.*"
    )


# ------------------------------------------------------------------ content
def content_counts(interactions: DataFrame, as_of: str, window_hours: int = C.FEATURE_WINDOW_HOURS) -> DataFrame:
    """A1 + A5 + A6: per-content metric counts over the window, the latest
    event time and the latest non-null event topic (of equally late ones the
    greatest)."""
    _check_window(window_hours)
    ev = interactions.filter(in_window("event_timestamp", as_of, window_hours))
    return _counts_with_topic(ev, ["content_id"])


def _counts_with_topic(events: DataFrame, keys: list[str]) -> DataFrame:
    """Counts per key and topic (fixed-width buffers, so a hash aggregate over
    the events), then the few topic rows of each key folded into one."""
    return fold_topics(events.groupBy(*keys, "topic").agg(*metric_counts(), F.max("event_timestamp").alias("last_event_at")), keys)


def fold_topics(per_topic: DataFrame, keys: list[str]) -> DataFrame:
    """Counts per key from rows (keys, topic, counts, last_event_at), with the topic of the latest one."""
    return per_topic.groupBy(*keys).agg(
        *[F.sum(m).alias(m) for m in C.METRICS],
        F.max("last_event_at").alias("last_event_at"),
        F.expr("max_by(topic, struct(last_event_at, topic)) FILTER (WHERE topic IS NOT NULL)").alias("topic"),
    )


def with_content_rates(counts: DataFrame, as_of: str, window_hours: int, now_col: str | None = None) -> DataFrame:
    """A7 + A8 + A9 + V13 on a counts frame (``now_col``: per-row time of
    the vector, e.g. a snapshot time; default ``as_of``).

    Staged selects: ratios, then 6-digit rates (``round6`` always reads a
    column), then the raw trending score, then its decayed rounding."""
    now = F.col(now_col) if now_col else ts_lit(as_of)
    keys = ["content_id"] + ([now_col] if now_col else [])
    base = [*keys, "topic", F.lit(int(window_hours)).alias("window_hours"), *C.METRICS]
    s1 = counts.select(
        *base,
        ratio("`likes`", "`clicks`").alias("_q_like"),
        ratio("`saves`", "`clicks`").alias("_q_save"),
        ratio("`skip_count`", "`impressions`").alias("_q_skip"),
        ratio("`watch_completes`", "`watch_starts`").alias("_q_comp"),
        *trending_ratios(),
        trending_decay(now, window_hours).alias("_decay"),
        "last_event_at",
    )
    out = [*keys, "topic", "window_hours", *C.METRICS]
    s2 = s1.select(
        *out,
        rate_of("_q_ctr").alias("ctr"),
        rate_of("_q_like").alias("like_rate"),
        rate_of("_q_save").alias("save_rate"),
        rate_of("_q_skip").alias("skip_rate"),
        rate_of("_q_comp").alias("completion_rate"),
        trending_raw().alias("_raw"),
        "_decay",
        "last_event_at",
    )
    rates = ["ctr", "like_rate", "save_rate", "skip_rate", "completion_rate"]
    return s2.select(
        *out, *rates, trending_from("_raw", "_decay").alias("trending_score"), "last_event_at"
    ).withColumn(
        # Rates above 1 are kept and flagged (likes/saves are over clicks)
        "rate_out_of_bounds",
        F.greatest(*rates) > 1.0,
    )


def content_features(interactions: DataFrame, as_of: str, window_hours: int = C.FEATURE_WINDOW_HOURS) -> DataFrame:
    """Content feature vectors as of ``as_of`` (A1..A9)."""
    return with_content_rates(content_counts(interactions, as_of, window_hours), as_of, window_hours)


FEATURE_COLUMNS = (
    "ctr",
    "like_rate",
    "save_rate",
    "skip_rate",
    "completion_rate",
    "trending_score",
)


def attach_features(items: DataFrame, features: DataFrame) -> DataFrame:
    """Left-join features to items; missing vectors become zero vectors
    that carry the item's topic."""
    f = features.select("content_id", *C.METRICS, *FEATURE_COLUMNS, "last_event_at")
    joined = items.join(f, "content_id", "left")
    fill = {m: 0 for m in C.METRICS}
    fill.update({c: 0.0 for c in FEATURE_COLUMNS})
    return joined.fillna(fill)


# --------------------------------------------------------------- user-topic
def user_topic_counts(interactions: DataFrame, as_of: str, window_hours: int = C.FEATURE_WINDOW_HOURS) -> DataFrame:
    """A2 + A5: per (user, topic) counts; events without topic skipped.
    ``last_event_at`` is per user across topics (the user is the state key).
    The user-level max runs on the aggregated rows, not on raw events."""
    _check_window(window_hours)
    ev = interactions.filter(in_window("event_timestamp", as_of, window_hours) & F.col("topic").isNotNull())
    agg = ev.groupBy("user_id", "topic").agg(*metric_counts(), F.max("event_timestamp").alias("last_event_at"))
    return latest_of_user(agg)


def latest_of_user(per_topic: DataFrame) -> DataFrame:
    """Rows (user_id, topic, counts, last_event_at) with the user's latest event time in place of the topic's."""
    return per_topic.withColumn("last_event_at", F.max("last_event_at").over(Window.partitionBy("user_id")))


def user_topic_affinity(interactions: DataFrame, as_of: str, window_hours: int = C.FEATURE_WINDOW_HOURS) -> DataFrame:
    """A10 + A11: user-topic vectors with their affinity score."""
    return with_affinity(user_topic_counts(interactions, as_of, window_hours), window_hours)


def with_affinity(counts: DataFrame, window_hours: int) -> DataFrame:
    """A10 + A11 on a counts frame."""
    s1 = counts.select("user_id", "topic", *C.METRICS, affinity_ratio().alias("_q"), "last_event_at")
    staged = s1.select("user_id", "topic", *C.METRICS, affinity_raw("_q").alias("_raw"), "last_event_at")
    return staged.select(
        "user_id",
        "topic",
        F.lit(int(window_hours)).alias("window_hours"),
        *C.METRICS,
        round6("_raw").alias("affinity_score"),
        "last_event_at",
    )


def affinity_map(user_topic: DataFrame, topics: tuple = C.TOPICS) -> DataFrame:
    """One map per user (topic -> score). Only supported topics are
    stored (V7 rejects others before the write), so a user's collected map
    holds at most ``len(topics)`` entries."""
    kept = user_topic.filter(F.col("topic").isin(*topics))
    return kept.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("topic", "affinity_score"))).alias("topic_affinity"),
        F.max("last_event_at").alias("last_event_at"),
    )


def affinity_map_pivot(
    interactions: DataFrame, as_of: str, window_hours: int = C.FEATURE_WINDOW_HOURS, topics: tuple = C.TOPICS
) -> DataFrame:
    """A2 + A10 + A12 in one aggregate per user: a static pivot of
    (topic, event type) counts (topics are the fixed supported list), then
    the map of affinity scores of the topics the user touched. Same result
    as ``affinity_map(user_topic_affinity(...))`` with a single shuffle,
    partial-aggregated map-side (a hot user is reduced before the shuffle)."""
    _check_window(window_hours)
    ev = interactions.filter(in_window("event_timestamp", as_of, window_hours) & F.col("topic").isin(*topics))
    aggs = [
        F.expr(f"count_if(topic = '{t}' AND event_type = '{et}')").alias(f"t{i}_{m}")
        for i, t in enumerate(topics)
        for et, m in C.METRIC_FOR_EVENT.items()
    ]
    agg = ev.groupBy("user_id").agg(*aggs, F.max("event_timestamp").alias("last_event_at"))
    idx = range(len(topics))
    s1 = agg.select(
        "*",
        *[affinity_ratio(f"t{i}_").alias(f"_q{i}") for i in idx],
        *[F.expr(" + ".join(f"t{i}_{m}" for m in C.METRICS)).alias(f"_n{i}") for i in idx],
    )
    staged = s1.select(
        "user_id",
        "last_event_at",
        *[affinity_raw(f"_q{i}", p=f"t{i}_").alias(f"_a{i}") for i in idx],
        *[f"_n{i}" for i in idx],
    )
    entries = F.array(
        *[
            F.struct(F.lit(t).alias("topic"), round6(f"_a{i}").alias("affinity_score"), F.col(f"_n{i}").alias("n"))
            for i, t in enumerate(topics)
        ]
    )
    agg = staged
    touched = F.filter(entries, lambda e: e["n"] > 0)
    return agg.select(
        "user_id",
        F.map_from_entries(F.transform(touched, lambda e: F.struct(e["topic"], e["affinity_score"]))).alias("topic_affinity"),
        "last_event_at",
    )


# ----------------------------------------------------------- point in time
def point_in_time_counts(
    interactions: DataFrame,
    key: str = "content_id",
    window_hours: int = C.FEATURE_WINDOW_HOURS,
    slice_seconds: int = 3600,
) -> DataFrame:
    """A4: the rolling counts of ``key`` as they stood after each event,
    i.e. over ``(t - window, t]`` (ties in ``t`` included).

    Written as differences of prefix counts, ``C(t) - C(t - window)`` with
    ``C(x)`` = events of the key at or before ``x``, so no window partition
    has to hold a key's whole window:

    * each event emits two zero-weight probes, at ``t`` and ``t - window``;
    * prefix sums run per ``(key, time slice)`` (``slice_seconds``), plus an
      offset = the key's totals of all earlier slices, computed on one row
      per active slice;
    * the two probes of an event are folded back by event id.

    A key holding a third of all rows is thereby split into its time slices.
    """
    _check_window(window_hours)
    w_us = int(window_hours) * 3_600_000_000
    s_us = int(slice_seconds) * 1_000_000
    ev = interactions.select("event_id", key, "event_type", "event_timestamp", micros("event_timestamp").alias("_us"))
    # one scan: each event emits its weight row (kind 0) and two probes
    # (kind 1) at t (+) and t - window (-); probes carry the event's fields
    emitted = F.array(
        F.struct(F.col("_us").alias("us"), F.lit(0).alias("kind"), F.lit(0).alias("side")),
        F.struct(F.col("_us").alias("us"), F.lit(1).alias("kind"), F.lit(1).alias("side")),
        F.struct((F.col("_us") - F.lit(w_us)).alias("us"), F.lit(1).alias("kind"), F.lit(-1).alias("side")),
    )
    rows = ev.select("event_id", key, "event_type", "event_timestamp", F.explode(emitted).alias("e")).select(
        "event_id",
        key,
        "event_type",
        "event_timestamp",
        F.col("e.us").alias("_us"),
        F.col("e.kind").alias("_kind"),
        F.col("e.side").alias("_side"),
        F.floor(F.col("e.us") / F.lit(s_us)).alias("_slice"),
        *[
            F.when(F.col("e.kind") == 0, (F.col("event_type") == et).cast("long")).otherwise(F.lit(0)).alias(m)
            for et, m in C.METRIC_FOR_EVENT.items()
        ],
    )
    # events sort before probes at equal time: C(x) counts events at exactly x
    local = Window.partitionBy(key, "_slice").orderBy("_us", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    pref = rows.select(
        "event_id", key, "event_type", "event_timestamp", "_slice", "_kind", "_side",
        *[F.sum(m).over(local).alias(m) for m in C.METRICS],
    )
    # every active slice gets a row (probe-only slices too: they need the
    # carried offset); probes weigh zero
    totals = rows.groupBy(key, "_slice").agg(*[F.sum(m).alias(m) for m in C.METRICS])
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(key, "_slice", *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_o_{m}") for m in C.METRICS])
    probed = pref.filter(F.col("_kind") == 1).join(offsets, [key, "_slice"], "left")
    signed = probed.select(
        "event_id", key, "event_type", "event_timestamp",
        *[(F.col("_side") * (F.col(m) + F.coalesce(F.col(f"_o_{m}"), F.lit(0)))).alias(m) for m in C.METRICS],
    )
    # each event's two probes fold back (event fields are functions of the id)
    return signed.groupBy("event_id", key, "event_type", "event_timestamp").agg(
        *[F.sum(m).cast("long").alias(m) for m in C.METRICS]
    )


# ------------------------------------------------------------- snapshots
def daily_content_snapshots(
    interactions: DataFrame, window_hours: int = C.FEATURE_WINDOW_HOURS, until: str | None = None
) -> DataFrame:
    """Content vectors as of every midnight (an append-only snapshot
    history, S6 shape). Each event is sent to the snapshots whose window
    contains it (``s - window < t <= s``) by a generator, then one grouped
    aggregate computes all snapshots at once. With ``until`` only the snapshots
    up to that time are made, and later events are left out in the scan."""
    _check_window(window_hours)
    if until is not None:
        interactions = interactions.filter(F.col("event_timestamp") <= ts_lit(until))
    w_us = int(window_hours) * 3_600_000_000
    day_us = 86_400_000_000
    t = micros("event_timestamp")
    first = F.ceil(t / F.lit(day_us)) * F.lit(day_us)
    n = -(-int(window_hours) // 24)
    snaps = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(n)), lambda k: first + k * F.lit(day_us)),
        lambda s: (s - F.lit(w_us) < t) & (s >= t) & (F.lit(True) if until is None else s <= micros(ts_lit(until))),
    )
    ev = interactions.select("*", F.explode(snaps).alias("_s_us"))
    counts = _counts_with_topic(ev, ["content_id", "_s_us"])
    counts = counts.withColumn("snapshot_at", F.timestamp_micros("_s_us")).drop("_s_us")
    return with_content_rates(counts, "", window_hours, now_col="snapshot_at").drop("rate_out_of_bounds")



def touched_keys(batch: DataFrame, key_cols: list[str]) -> DataFrame:
    """The distinct keys a micro-batch touched."""
    return batch.select(*key_cols).distinct()


def snapshot_as_of(snapshots: DataFrame, key_cols: list[str], as_of: str, ts_col: str = "snapshot_at") -> DataFrame:
    """Latest snapshot per key with ``snapshot_at <= as_of`` (append-only history)."""
    h = snapshots.filter(F.col(ts_col) <= ts_lit(as_of))
    other = [c for c in h.columns if c not in key_cols]
    latest = h.groupBy(*key_cols).agg(F.max_by(F.struct(*other), F.col(ts_col)).alias("_s"))
    return latest.select(*key_cols, "_s.*")
