"""Experiment assignment, exposure records and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import assignment_bucket, ts_lit


def variants_table(
    spark: SparkSession,
    experiment_key: str = C.EXPERIMENT_KEY,
    variants: tuple = C.EXPERIMENT_VARIANTS,
) -> DataFrame:
    """E5: experiment configuration as a literal table with cumulative
    ``[lo, hi)`` bucket ranges; the last variant's ``hi`` is the whole space
    so it also takes any remainder (fallback to the last variant)."""
    rows, lo = [], 0
    for i, (v, s, bp) in enumerate(variants):
        hi = C.BUCKET_SPACE if i == len(variants) - 1 else lo + int(bp)
        rows.append(f"('{experiment_key}', {i}, '{v}', '{s}', {int(bp)}, {lo}, {hi})")
        lo = hi
    cols = "experiment_key, variant_order, variant_key, strategy_name, allocation_basis_points, bucket_lo, bucket_hi"
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({cols})")


def with_ranges(variants: DataFrame) -> DataFrame:
    w = Window.partitionBy("experiment_key").orderBy("variant_order")
    hi = F.sum("allocation_basis_points").over(w.rowsBetween(Window.unboundedPreceding, 0))
    last = F.max("variant_order").over(Window.partitionBy("experiment_key"))
    return (
        variants.withColumn("bucket_lo", hi - F.col("allocation_basis_points"))
        .withColumn("bucket_hi", F.when(F.col("variant_order") == last, F.lit(C.BUCKET_SPACE)).otherwise(hi))
        .withColumn("bucket_lo", F.when(F.col("variant_order") == F.lit(0), F.lit(0)).otherwise(F.col("bucket_lo")))
    )


def resolve_variant(bucketed: DataFrame, variants: DataFrame) -> DataFrame:
    """Bucket -> variant by cumulative allocation.

    The range lookup is turned into an equi-join: each variant's ``[lo, hi)``
    range is expanded into its buckets (a generator), giving one row per
    bucket of the experiment, at most ``BUCKET_SPACE`` rows (10,000) whatever
    the number of users, so it is broadcast and joined on
    ``(experiment_key, assignment_bucket)`` - a hash join, not a range scan.
    """
    per_bucket = variants.select(
        "experiment_key",
        "variant_key",
        "strategy_name",
        F.explode(F.sequence(F.col("bucket_lo"), F.col("bucket_hi") - 1)).alias("assignment_bucket"),
    )
    return bucketed.join(F.broadcast(per_bucket), ["experiment_key", "assignment_bucket"], "left")


def assign(users: DataFrame, variants: DataFrame, experiment_key: str = C.EXPERIMENT_KEY) -> DataFrame:
    """E1 + E2: deterministic assignment of every user (no stored state).
    Other columns of ``users`` are kept."""
    b = users.select(
        "*",
        F.lit(experiment_key).alias("experiment_key"),
        assignment_bucket(F.lit(experiment_key), F.col("user_id")).alias("assignment_bucket"),
    )
    return resolve_variant(b, variants)


def get_or_create(
    stored: DataFrame,
    users: DataFrame,
    variants: DataFrame,
    assigned_at: str,
    experiment_key: str = C.EXPERIMENT_KEY,
) -> tuple[DataFrame, DataFrame]:
    """The stored assignment wins; users without one get the hash.

    Returns ``(assignments for users, new rows to append)``; at most one row
    per (experiment_key, user_id).
    """
    s = stored.filter(F.col("experiment_key") == experiment_key)
    fresh = assign(users.join(s.select("user_id"), "user_id", "left_anti"), variants, experiment_key).withColumn(
        "assigned_at", ts_lit(assigned_at)
    )
    kept = s.join(users.select("user_id"), "user_id", "left_semi").select(*fresh.columns)
    return kept.unionByName(fresh), fresh


def exposures_from_pages(pages: DataFrame, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """One header per delivered page (empty pages included) and one item
    row per ranked item; ``generated_at`` comes from the page. ``carry``
    copies header columns onto the item rows (one pass, no join back)."""
    header = pages.select(
        "exposure_id",
        "experiment_key",
        "variant_key",
        "strategy_name",
        "user_id",
        "feed_limit",
        "feed_offset",
        *[c for c in ("session_id", "request_id", "correlation_id", "cache_hit") if c in pages.columns],
        "generated_at",
        F.col("generated_at").alias("created_at"),
    )
    extra = [c for c in carry if c not in ("exposure_id", "generated_at")]
    items = pages.select("exposure_id", "generated_at", *extra, F.explode("items").alias("it")).select(
        F.concat_ws(":", "exposure_id", F.col("it.content_id").cast("string")).alias("item_id"),
        "exposure_id",
        F.col("it.content_id").alias("content_id"),
        F.col("it.topic").alias("topic"),
        F.col("it.category").alias("category"),
        F.col("it.rank").alias("rank"),
        F.col("it.score").alias("score"),
        F.col("generated_at").alias("created_at"),
        *extra,
    )
    return header, items


def _errors(*checks: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(c, F.lit(msg)) for c, msg in checks]))


def validate_exposures(header: DataFrame, items: DataFrame, assignments: DataFrame) -> DataFrame:
    """V15 + J13: payload bounds and agreement with the stored assignment.

    Item-level checks are aggregated per exposure (partial aggregate) and
    joined back; the assignment lookup is an equi-join on (experiment, user).
    """
    item_err = items.groupBy("exposure_id").agg(
        F.count_if(F.col("rank") < 1).alias("_bad_rank"),
        F.count_if(~F.col("category").isin(*C.CATEGORIES)).alias("_bad_category"),
        (F.count("*") - F.countDistinct("content_id")).alias("_dup_items"),
    )
    a = assignments.select(
        "experiment_key",
        "user_id",
        F.col("variant_key").alias("_a_variant"),
        F.col("strategy_name").alias("_a_strategy"),
    )
    h = header.join(a, ["experiment_key", "user_id"], "left").join(item_err, "exposure_id", "left")
    errors = _errors(
        (F.coalesce(F.trim("experiment_key"), F.lit("")) == "", "experiment_key_empty"),
        (F.coalesce(F.trim("variant_key"), F.lit("")) == "", "variant_key_empty"),
        ((F.col("feed_limit") < 1) | (F.col("feed_limit") > C.PAGE_MAX_LIMIT), "feed_limit_out_of_range"),
        (F.col("feed_offset") < 0, "feed_offset_negative"),
        (F.coalesce(F.col("_bad_rank"), F.lit(0)) > 0, "item_rank_below_1"),
        (F.coalesce(F.col("_bad_category"), F.lit(0)) > 0, "item_category_unknown"),
        (F.coalesce(F.col("_dup_items"), F.lit(0)) > 0, "duplicate_item"),
        (F.col("_a_variant").isNull(), "assignment_missing"),
        (F.col("_a_variant").isNotNull() & (F.col("_a_variant") != F.col("variant_key")), "variant_mismatch"),
        (F.col("_a_strategy").isNotNull() & (F.col("_a_strategy") != F.col("strategy_name")), "strategy_mismatch"),
    )
    return h.select(*header.columns, errors.alias("errors"))


def validate_pages(pages: DataFrame, assignments: DataFrame) -> DataFrame:
    """V15 + J13 on pages with nested ``items``: item checks are
    higher-order functions over the page's own (bounded) item array, so the
    only wide step is the equi-join to the stored assignment."""
    a = assignments.select(
        "experiment_key",
        "user_id",
        F.col("variant_key").alias("_a_variant"),
        F.col("strategy_name").alias("_a_strategy"),
    )
    h = pages.join(a, ["experiment_key", "user_id"], "left")
    ids = F.transform("items", lambda x: x["content_id"])
    errors = _errors(
        (F.coalesce(F.trim("experiment_key"), F.lit("")) == "", "experiment_key_empty"),
        (F.coalesce(F.trim("variant_key"), F.lit("")) == "", "variant_key_empty"),
        ((F.col("feed_limit") < 1) | (F.col("feed_limit") > C.PAGE_MAX_LIMIT), "feed_limit_out_of_range"),
        (F.col("feed_offset") < 0, "feed_offset_negative"),
        (F.exists("items", lambda x: x["rank"] < 1), "item_rank_below_1"),
        (F.exists("items", lambda x: ~x["category"].isin(*C.CATEGORIES)), "item_category_unknown"),
        (F.size(ids) != F.size(F.array_distinct(ids)), "duplicate_item"),
        (F.col("_a_variant").isNull(), "assignment_missing"),
        (F.col("_a_variant").isNotNull() & (F.col("_a_variant") != F.col("variant_key")), "variant_mismatch"),
        (F.col("_a_strategy").isNotNull() & (F.col("_a_strategy") != F.col("strategy_name")), "strategy_mismatch"),
    )
    return h.withColumn("errors", errors).drop("_a_variant", "_a_strategy")
