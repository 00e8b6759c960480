"""Candidate scoring.

All components are row-local column expressions (whole-stage codegen). The
strategy registry is a two-row table joined by name; it is configuration
(bounded), so it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import (
    canonical_strategy,
    engagement_raw,
    id_text,
    recency_from,
    recency_raw,
    round6,
    strategy_adjustment,
    trending_norm,
    ts_lit,
)

BREAKDOWN_FIELDS = (
    "user_topic_affinity",
    "user_topic_affinity_weighted",
    "recency",
    "recency_weighted",
    "engagement",
    "engagement_weighted",
    "trending",
    "trending_weighted",
    "strategy_adjustment",
    "diversity_penalty",
    "final_score",
)


STRATEGY_FIELDS = (
    "strategy_name",
    "affinity_weight",
    "recency_weight",
    "engagement_weight",
    "trending_weight",
    "boost_threshold",
    "boost_multiplier",
    "max_adjustment",
)


def strategies_table(spark: SparkSession, strategies: tuple = C.STRATEGIES) -> DataFrame:
    """K6: the strategy registry as a literal table (a JVM-side VALUES
    relation built in one statement)."""
    rows = ", ".join(
        "(" + ", ".join([f"'{st[0]}'", *[f"{float(v)!r}D" for v in st[1:]]]) + ")" for st in strategies
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(STRATEGY_FIELDS)})")


def item_scores(items: DataFrame, now: str) -> DataFrame:
    """K2-K5 of rows that carry a strategy's fields: everything of the base
    breakdown that does not depend on the user, raw and weighted."""
    staged = items.select(
        "*",
        recency_raw("published_at", ts_lit(now)).alias("_rec"),
        engagement_raw().alias("_eng"),
        trending_norm("trending_score").alias("c_trending"),
    )
    comps = staged.select(
        *[c for c in staged.columns if c not in ("_rec", "_eng")],
        recency_from("_rec", "published_at").alias("c_recency"),
        round6("_eng").alias("c_engagement"),
        strategy_adjustment("c_trending", "boost_threshold", "boost_multiplier", "max_adjustment").alias(
            "c_adjustment"
        ),
    )
    return comps.select(
        "*",
        round6("c_recency * recency_weight").alias("w_recency"),
        round6("c_engagement * engagement_weight").alias("w_engagement"),
        round6("c_trending * trending_weight").alias("w_trending"),
    )


def user_scores(rows: DataFrame) -> DataFrame:
    """K1, K7: the user's affinity, raw and weighted, and the base score of
    rows with ``item_scores``. One rounding per select: the code generated for
    several in one is longer than the JVM compiles."""
    s = rows.select("*", round6("greatest(0.0D, least(1.0D, user_topic_affinity))").alias("c_affinity"))
    s = s.select("*", round6("c_affinity * affinity_weight").alias("w_affinity"))
    s = s.select("*", round6("w_affinity + w_recency + w_engagement + w_trending").alias("_sum"))
    return s.select(*[c for c in s.columns if c != "_sum"], round6("_sum + c_adjustment").alias("base_score"))


def score(candidates: DataFrame, strategies: DataFrame, now: str) -> DataFrame:
    """K7: base breakdown per candidate. ``candidates`` needs
    ``strategy_name``; names are canonicalized (alias, trim) first and an
    unsupported name leaves the row without weights (null score)."""
    c = candidates.withColumn("strategy_name", canonical_strategy("strategy_name"))
    s = c.join(F.broadcast(strategies), "strategy_name", "left")
    return user_scores(item_scores(s, now)).drop(*STRATEGY_FIELDS[1:])


def score_pool(pool: DataFrame, strategies: DataFrame, now: str) -> DataFrame:
    """The item scores of the bounded pool under every strategy, and under none
    (``strategy_key`` empty: no weights). A user's candidates take them by
    (item, strategy) instead of working them out once per user.

    ``pick`` numbers the rows in the order that breaks ties between equal
    scores; ``topic_no`` and ``category_no`` stand for topic and category."""
    none = strategies.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in strategies.schema.fields])
    every = pool.crossJoin(F.broadcast(strategies.unionByName(none)))
    scored = item_scores(every, now).withColumn("strategy_key", F.coalesce("strategy_name", F.lit("")))
    order = (F.col("published_at").desc_nulls_last(), id_text("content_id").desc(), F.col("strategy_key"))
    return scored.select(
        *[c for c in scored.columns if c not in STRATEGY_FIELDS or c == "affinity_weight"],
        F.row_number().over(Window.orderBy(*order)).alias("pick"),
        F.dense_rank().over(Window.orderBy("topic")).alias("topic_no"),
        F.dense_rank().over(Window.orderBy("category")).alias("category_no"),
    )


def breakdown(penalty_col: str = "diversity_penalty", final_col: str = "score") -> F.Column:
    """The 11-field explanation struct."""
    return F.struct(
        F.col("c_affinity").alias("user_topic_affinity"),
        F.col("w_affinity").alias("user_topic_affinity_weighted"),
        F.col("c_recency").alias("recency"),
        F.col("w_recency").alias("recency_weighted"),
        F.col("c_engagement").alias("engagement"),
        F.col("w_engagement").alias("engagement_weighted"),
        F.col("c_trending").alias("trending"),
        F.col("w_trending").alias("trending_weighted"),
        F.col("c_adjustment").alias("strategy_adjustment"),
        F.col(penalty_col).alias("diversity_penalty"),
        F.col(final_col).alias("final_score"),
    )


def validate_candidates(candidates: DataFrame) -> DataFrame:
    """Title 1..500, affinity in [0, 1], the feature vector's item is the
    candidate's, sources de-duplicated in order (``array_distinct`` keeps
    first-seen order)."""
    vector = F.col("content_features")["content_id"] if "content_features" in candidates.columns else F.col("content_id")
    errors = F.array_compact(
        F.array(
            F.when(vector.isNull() | (vector != F.col("content_id")), F.lit("features_of_another_item")),
            F.when(F.length(F.trim("title")).between(1, 500) == F.lit(False), F.lit("title_length")),
            F.when(~F.col("user_topic_affinity").between(0.0, 1.0), F.lit("affinity_out_of_range")),
            F.when(F.col("topic").isNull() | (F.trim("topic") == ""), F.lit("topic_empty")),
        )
    )
    return candidates.withColumn("candidate_sources", F.array_distinct("candidate_sources")).withColumn("errors", errors)
