"""Descriptive insight aggregates over feed pages and interactions.

A "page" is the first ``limit`` ranked items of a user (rank <= limit).
Every aggregate is keyed by user (or session) and partial-aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from .candidates import top_k_per_group


# Means of 6-decimal values over a page (<= 100 items) are reported to 10
# decimals: this removes the last-bit noise of floating summation order
# (which differs between partitionings) without touching the exact mean.
MEAN_DIGITS = 10


def page_items(ranked: DataFrame, limit: int = C.PAGE_DEFAULT_LIMIT) -> DataFrame:
    return ranked.filter(F.col("rank") <= limit)


def observed_affinity(ranked: DataFrame, limit: int = C.PAGE_DEFAULT_LIMIT) -> DataFrame:
    """Mean candidate affinity per topic on the page; 0 for absent topics.
    One pass: per (user, topic) means, folded into one bounded map per user,
    then read back for the fixed topic list."""
    p = page_items(ranked, limit)
    avg = p.groupBy("user_id", "topic").agg(F.round(F.avg("user_topic_affinity"), MEAN_DIGITS).alias("v"))
    per_user = avg.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("topic", "v"))).alias("m"))
    topics = F.array(*[F.struct(F.lit(i).alias("topic_order"), F.lit(t).alias("topic")) for i, t in enumerate(C.TOPICS)])
    return per_user.select("user_id", "m", F.explode(topics).alias("t")).select(
        "user_id",
        F.col("t.topic").alias("topic"),
        F.col("t.topic_order").alias("topic_order"),
        F.coalesce(F.try_element_at("m", F.col("t.topic")), F.lit(0.0)).alias("observed_affinity"),
    )


def trending_rows(ranked: DataFrame, limit: int = C.PAGE_DEFAULT_LIMIT, n: int = 8) -> DataFrame:
    """Top ``n`` page items by raw trending score (stable: ties keep page order)."""
    p = page_items(ranked, limit)
    w = Window.partitionBy("user_id").orderBy(F.col("trending_score").desc(), F.col("rank"))
    return (
        p.withColumn("position", F.row_number().over(w))
        .filter(F.col("position") <= n)
        .select("user_id", "position", "content_id", "trending_score", "rank")
    )


def category_distribution(content: DataFrame) -> DataFrame:
    """Items per category."""
    return content.groupBy("category").agg(F.count("*").alias("value"))


def feed_summary(ranked: DataFrame, limit: int = C.PAGE_DEFAULT_LIMIT) -> DataFrame:
    """Per page: item count, mean score / trending / completion, leading
    topic (most items; ties go to the earlier topic in display order, null
    when no known topic). One aggregate per user: the leading topic is the
    deterministic mode of the topic's display index (lowest index on ties;
    its counter holds at most one entry per topic)."""
    p = page_items(ranked, limit)
    topics = F.array(*[F.lit(t) for t in C.TOPICS])
    idx = F.when(F.col("topic").isin(*C.TOPICS), F.array_position(topics, F.col("topic")))
    agg = p.groupBy("user_id").agg(
        F.count("*").alias("total_items"),
        F.round(F.avg("score"), MEAN_DIGITS).alias("average_score"),
        F.round(F.avg("trending_score"), MEAN_DIGITS).alias("average_trending"),
        F.round(F.avg("completion_rate"), MEAN_DIGITS).alias("average_completion"),
        F.mode(idx, deterministic=True).alias("_lead"),
    )
    return agg.withColumn("leading_topic", F.try_element_at(topics, F.col("_lead").cast("int"))).drop("_lead")


def event_type_distribution(interactions: DataFrame) -> DataFrame:
    """Events per (session, event type)."""
    return interactions.groupBy("session_id", "event_type").agg(F.count("*").alias("value"))


def topic_mix(ranked: DataFrame, limit: int = C.PAGE_DEFAULT_LIMIT) -> DataFrame:
    """Items per topic on each page."""
    return page_items(ranked, limit).groupBy("user_id", "topic").agg(F.count("*").alias("items"))


def source_mix(ranked: DataFrame, limit: int = C.PAGE_DEFAULT_LIMIT) -> DataFrame:
    """Items per candidate source on each page."""
    p = page_items(ranked, limit).select("user_id", F.explode("candidate_sources").alias("source"))
    return p.groupBy("user_id", "source").agg(F.count("*").alias("items"))


def score_bands(ranked: DataFrame, top: int = 6) -> DataFrame:
    """The first ``top`` items: score, completion percent, impressions."""
    return ranked.filter(F.col("rank") <= top).select(
        "user_id",
        "rank",
        "content_id",
        "score",
        (F.col("completion_rate") * F.lit(100.0)).alias("completion_percent"),
        "impressions",
    )


def breakdown_long(ranked: DataFrame, limit: int = C.PAGE_DEFAULT_LIMIT) -> DataFrame:
    """One row per score component with its raw and weighted value."""
    p = page_items(ranked, limit)
    comps = F.array(
        F.struct(F.lit("user_topic_affinity").alias("component"), F.col("c_affinity").alias("raw"), F.col("w_affinity").alias("weighted")),
        F.struct(F.lit("recency").alias("component"), F.col("c_recency").alias("raw"), F.col("w_recency").alias("weighted")),
        F.struct(F.lit("engagement").alias("component"), F.col("c_engagement").alias("raw"), F.col("w_engagement").alias("weighted")),
        F.struct(F.lit("trending").alias("component"), F.col("c_trending").alias("raw"), F.col("w_trending").alias("weighted")),
    )
    return p.select("user_id", "content_id", F.explode(comps).alias("c")).select(
        "user_id", "content_id", "c.component", "c.raw", "c.weighted"
    )


def engagement_percent(ranked: DataFrame) -> DataFrame:
    """Engagement rates in percent."""
    return ranked.select(
        "user_id", "content_id", *[(F.col(c) * F.lit(100.0)).alias(f"{c}_percent") for c in ("ctr", "like_rate", "save_rate", "completion_rate", "skip_rate")]
    )


def action_state(interactions: DataFrame) -> DataFrame:
    """Clicked / liked / saved per (user, content)."""
    et = F.col("event_type")
    return interactions.groupBy("user_id", "content_id").agg(
        F.bool_or(et == "click").alias("clicked"),
        F.bool_or(et == "like").alias("liked"),
        F.bool_or(et == "save").alias("saved"),
    )


def exclude_dismissed(ranked: DataFrame, interactions: DataFrame, limit: int = C.PAGE_DEFAULT_LIMIT) -> DataFrame:
    """Page items minus the ones the user dismissed (skipped); order kept."""
    dismissed = interactions.filter(F.col("event_type") == "skip").select("user_id", "content_id").distinct()
    p = page_items(ranked, limit).join(dismissed, ["user_id", "content_id"], "left_anti")
    w = Window.partitionBy("user_id").orderBy("rank")
    return p.select("user_id", "content_id", "rank", F.row_number().over(w).alias("position"))


def recent_events(interactions: DataFrame, n: int = 10) -> DataFrame:
    """Newest ``n`` events per session (two-stage top-k, hot-session safe)."""
    cols = ["session_id", "event_id", "event_type", "content_id", "event_timestamp"]
    top = top_k_per_group(
        interactions.select(*cols),
        ["session_id"],
        [F.col("event_timestamp").desc(), F.col("event_id").desc()],
        n,
    )
    return top.withColumnRenamed("_rank", "position")
