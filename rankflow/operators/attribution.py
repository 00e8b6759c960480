"""Last-touch attribution and strategy comparison.

PySpark has no public as-of join, and an inequality join would become a
per-key cross product. ``asof_join`` is written as unions, windows and
equi-joins instead, and is split by time buckets so that a hot key (one
user-content pair holding a large share of rows) is spread over many
tasks:

1. within a bucket: union both sides on ``(by, bucket)`` and take the last
   right row at or before each left row (window ``last(..., ignorenulls)``);
2. across buckets: reduce the right side to its latest row per
   ``(by, bucket)`` (partial aggregate), then carry it forward over the
   bucket sequence of the key (one row per active bucket, not per event);
3. equi-join the carry-in to the left rows and keep the later of the two.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import micros, rate, ts_lit


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    right_cols: Sequence[str],
    right_order: Sequence[Column] = (),
    bucket_seconds: int = 3600,
    how: str = "inner",
) -> DataFrame:
    """Backward as-of join: for each left row, the right row of the same
    ``by`` key with the greatest ``right_ts <= left_ts``. Among right rows
    with equal time, the one that sorts last by ``right_order`` wins.

    ``how='inner'`` drops left rows without a match, ``'left'`` keeps them
    with null right columns. Right columns are returned under their names.
    """
    by = list(by)
    b_us = int(bucket_seconds) * 1_000_000
    order_keys = [F.col(right_ts).alias("_t0")] + [c.alias(f"_t{i + 1}") for i, c in enumerate(right_order)]
    r = right.select(
        *by,
        micros(right_ts).alias("_us"),
        F.struct(*order_keys, *[F.col(c) for c in right_cols]).alias("_r"),
    ).withColumn("_b", F.floor(F.col("_us") / F.lit(b_us)))
    l_cols = left.columns
    lft = left.withColumn("_us", micros(left_ts)).withColumn("_b", F.floor(F.col("_us") / F.lit(b_us)))

    # 1. within-bucket match
    r_rows = r.select(
        *by, "_b", "_us", F.lit(0).alias("_kind"), "_r",
        *[F.lit(None).cast(lft.schema[c].dataType).alias(c) for c in l_cols if c not in by],
    )
    l_rows = lft.select(
        *by, "_b", "_us", F.lit(1).alias("_kind"), F.lit(None).cast(r.schema["_r"].dataType).alias("_r"),
        *[c for c in l_cols if c not in by],
    )
    # right rows sort before left rows at equal time; among equal-time right
    # rows the struct order (time, right_order...) decides which is last
    w = Window.partitionBy(*by, "_b").orderBy("_us", "_kind", "_r").rowsBetween(Window.unboundedPreceding, 0)
    within = (
        r_rows.unionByName(l_rows)
        .withColumn("_in", F.last("_r", ignorenulls=True).over(w))
        .filter(F.col("_kind") == 1)
        .drop("_r", "_kind")
    )

    # 2. carry-in from earlier buckets: latest right row per active bucket
    r_last = r.groupBy(*by, "_b").agg(F.max("_r").alias("_r"))
    l_buckets = lft.select(*by, "_b").distinct().withColumn("_r", F.lit(None).cast(r.schema["_r"].dataType))
    wb = Window.partitionBy(*by).orderBy("_b").rangeBetween(Window.unboundedPreceding, -1)
    carry = (
        r_last.withColumn("_k", F.lit(0))
        .unionByName(l_buckets.withColumn("_k", F.lit(1)))
        .withColumn("_carry", F.max("_r").over(wb))
        .filter(F.col("_k") == 1)
        .select(*by, "_b", "_carry")
    )

    # 3. the later of the within-bucket match and the carry-in
    joined = within.join(carry, [*by, "_b"], "left").withColumn("_m", F.coalesce("_in", "_carry"))
    if how == "inner":
        joined = joined.filter(F.col("_m").isNotNull())
    return joined.select(*l_cols, *[F.col(f"_m.{c}").alias(c) for c in right_cols])


# ------------------------------------------------------------------ T1..T6
def select_exposures(header: DataFrame, experiment_key: str, now: str, lookback_hours: int) -> DataFrame:
    """Exposures of one experiment created within the lookback."""
    cutoff = F.timestamp_micros(micros(ts_lit(now)) - F.lit(int(lookback_hours) * 3_600_000_000))
    return header.filter((F.col("experiment_key") == experiment_key) & (F.col("created_at") >= cutoff))


def exposed_items(header: DataFrame, items: DataFrame) -> DataFrame:
    """Exposure header 1:N items (inner: pages without items add no item
    rows). Items that already carry the header's fields need no join."""
    if {"user_id", "generated_at", "experiment_key", "variant_key", "strategy_name"} <= set(items.columns):
        return items
    h = header.select("exposure_id", "user_id", "generated_at", "variant_key", "strategy_name")
    return items.select("item_id", "exposure_id", "content_id", "created_at").join(h, "exposure_id")


def attribute(outcomes: DataFrame, items: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """J7 + J8 + T2: each outcome event credited to the latest earlier
    exposure item of the same (user, content); unmatched outcomes dropped.
    Ties in ``generated_at`` go to the earliest ``created_at``, then the
    greatest item id."""
    reduced = outcomes.filter(F.col("event_type").isin(*C.OUTCOME_EVENT_TYPES)).join(
        items.select("user_id", "content_id").distinct(), ["user_id", "content_id"], "left_semi"
    )
    return asof_join(
        reduced.select("event_id", "user_id", "content_id", "event_type", "event_timestamp"),
        items,
        by=["user_id", "content_id"],
        left_ts="event_timestamp",
        right_ts="generated_at",
        right_cols=["item_id", "exposure_id", "generated_at", "variant_key", "strategy_name"],
        right_order=[F.negative(micros("created_at")), F.col("item_id")],
        bucket_seconds=bucket_seconds,
    )


def item_outcomes(attributed: DataFrame) -> DataFrame:
    """Clicked / saved / completed per exposure item (repeats do not inflate)."""
    et = F.col("event_type")
    return attributed.groupBy("item_id").agg(
        F.max((et == "click").cast("int")).alias("clicked"),
        F.max((et == "save").cast("int")).alias("saved"),
        F.max((et == "watch_complete").cast("int")).alias("completed"),
    )


def strategy_comparison(
    header: DataFrame,
    items: DataFrame,
    outcomes: DataFrame,
    now: str,
    lookback_hours: int = C.ANALYTICS_LOOKBACK_HOURS,
    experiment_key: str = C.EXPERIMENT_KEY,
) -> DataFrame:
    """T1..T6: per-strategy exposure denominators, attributed outcomes and
    rates, ordered by (variant_key, strategy_name)."""
    h = select_exposures(header, experiment_key, now, lookback_hours)
    if "experiment_key" in items.columns:
        items = select_exposures(items, experiment_key, now, lookback_hours)
    it = exposed_items(h, items)
    # Nothing before the first selected exposure can be credited to one
    since = h.agg(F.min("generated_at").alias("since")).scalar()
    flags = item_outcomes(attribute(outcomes.filter(F.col("event_timestamp") >= since), it))
    per_item = it.join(flags, "item_id", "left").groupBy("strategy_name").agg(
        F.count("*").alias("item_exposures"),
        F.coalesce(F.sum("clicked"), F.lit(0)).cast("long").alias("clicks"),
        F.coalesce(F.sum("saved"), F.lit(0)).cast("long").alias("saves"),
        F.coalesce(F.sum("completed"), F.lit(0)).cast("long").alias("completions"),
    )
    per_page = h.groupBy("strategy_name").agg(
        F.min_by("variant_key", F.struct("created_at", "exposure_id")).alias("variant_key"),
        F.count("*").alias("exposure_requests"),
        F.countDistinct("user_id").alias("unique_users"),
    )
    out = per_page.join(per_item, "strategy_name", "left").fillna(
        {"item_exposures": 0, "clicks": 0, "saves": 0, "completions": 0}
    )
    return out.select(
        "variant_key",
        "strategy_name",
        "exposure_requests",
        "item_exposures",
        "unique_users",
        "clicks",
        "saves",
        "completions",
        rate("clicks", "item_exposures").alias("ctr"),
        rate("saves", "item_exposures").alias("save_rate"),
        rate("completions", "item_exposures").alias("completion_rate"),
    ).orderBy("variant_key", "strategy_name")


def best_strategy(comparison: DataFrame, metrics: Sequence[str] = ("ctr", "save_rate", "completion_rate")) -> DataFrame:
    """For each metric the strategy with the highest value (ties keep
    the comparison's variant order) and the total exposure requests."""
    stacked = comparison.select(
        "variant_key",
        "strategy_name",
        "exposure_requests",
        F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])).alias("m"),
    ).select("variant_key", "strategy_name", "exposure_requests", "m.metric", "m.value")
    w = Window.partitionBy("metric").orderBy(F.col("value").desc(), "variant_key", "strategy_name")
    total = F.sum("exposure_requests").over(Window.partitionBy("metric"))
    return (
        stacked.withColumn("_rn", F.row_number().over(w))
        .withColumn("total_exposure_requests", total)
        .filter("_rn = 1")
        .select("metric", "variant_key", "strategy_name", "value", "total_exposure_requests")
    )


def attribute_direct(outcomes: DataFrame, items: DataFrame) -> DataFrame:
    """Attribution by the exposure id recorded in the interaction's
    metadata JSON (``feed_exposure_id``): an equi-join, used to cross-check
    the as-of attribution."""
    o = outcomes.withColumn("exposure_id", F.get_json_object("metadata", "$.feed_exposure_id"))
    return o.join(items.select("exposure_id", "content_id", "item_id"), ["exposure_id", "content_id"], "inner")
