"""Whole-feed build for all users.

``build`` composes assignment (E1, E2), candidates (R1-R8), scoring (K7)
and reranking (K9/K10). Every wide step after the user-level joins is keyed
by ``user_id``, so the windows and the page grouping reuse one partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import canonical_strategy, micros, ts_lit
from ..session import materialize
from . import candidates as cand
from . import experiments as exp
from . import features as feat
from . import rerank, scoring

# rank first: the collected structs are sorted by their first field
ITEM_FIELDS = (
    "rank",
    "content_id",
    "title",
    "topic",
    "category",
    "published_at",
    "candidate_sources",
    "user_topic_affinity",
    "score",
)


FANOUT_PARTITIONS_CONF = "spark.rankflow.feed.fanoutPartitions"
#: users of a task: about 400,000 narrow candidate rows, which are sorted in memory
USERS_PER_TASK = 4000


def fanout_partitions(spark: SparkSession, users: DataFrame) -> int:
    """Partitions for the per-user candidate fan-out. Each user row becomes
    up to 120 candidate rows inside its task, so their number follows the
    users; ``spark.rankflow.feed.fanoutPartitions`` and the session's shuffle
    partition count raise it."""
    configured = spark.conf.get(FANOUT_PARTITIONS_CONF, None)
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    needed = -(-users.count() // USERS_PER_TASK)
    return max(base, needed, int(configured or 0))


def build(
    spark: SparkSession,
    users: DataFrame,
    interactions: DataFrame,
    content: DataFrame,
    profiles: DataFrame,
    now: str,
    window_hours: int = C.FEATURE_WINDOW_HOURS,
    mode: str = "auto",
    apply_diversity_penalty: bool = True,
    experiment_key: str = C.EXPERIMENT_KEY,
) -> DataFrame:
    """Ranked candidates of every user with score breakdown.

    ``mode``: ``auto`` (the default) takes the two-window form only when the
    bounded pool's topics and categories are one to one and the general form
    otherwise; ``window`` and ``greedy`` name one of them.
    """
    runtime = feat.affinity_map_pivot(interactions, now, window_hours)
    # assignment is a pure function of the user id: computed on the user rows
    # themselves (E1) plus a broadcast lookup of the variant ranges
    rows = exp.assign(cand.user_affinity_rows(users, runtime, profiles), exp.variants_table(spark, experiment_key), experiment_key)
    # one row per user, hash-partitioned by user: the candidate fan-out
    # (broadcast pool join) and every ranking window keep this partitioning,
    # so the users x ~120 candidate rows are never shuffled. The partition
    # count is explicit: adaptive coalescing sizes partitions by the *user*
    # rows and would pack ~120x their volume into each task after the fan-out.
    strategy_key = F.coalesce(canonical_strategy("strategy_name"), F.lit(""))
    rows = rows.drop("assignment_bucket").withColumn("strategy_key", strategy_key)
    rows = rows.withColumn("strategy_name", canonical_strategy("strategy_name")).repartition(fanout_partitions(spark, users), "user_id")
    items = cand.pool_items(content)
    # features only for the bounded pool (the feed never reads other vectors)
    features = feat.content_features(cand.pool_key_filter(interactions, items), now, window_hours)
    pool = cand.flag_pool(feat.attach_features(items, features))
    # a few hundred rows, worked out once: the fan-out and the columns attached after it read them
    priced = materialize(scoring.score_pool(pool, scoring.strategies_table(spark), now))
    if mode == "auto":
        mode = "window" if rerank.topic_category_one_to_one(items) else "greedy"
    # only numbers go through the ranking; an item's other columns are attached to the ranked rows
    narrow = priced.select("strategy_key", "topic", *RANKED_BY, *ADDENDS, "in_recent", "in_trending", "in_topic")
    candidates = cand.generate(rows, narrow, on=("strategy_key",)).drop("topic", "strategy_key")
    scored = scoring.user_scores(candidates).drop(*ADDENDS)
    if mode == "greedy" and apply_diversity_penalty:
        ranked = rerank.rank_greedy(scored, topic="topic_no", category="category_no", tie="pick")
    else:
        ranked = rerank.rank_window(scored, apply_diversity_penalty, topic="topic_no", tie="pick")
    ranked = with_total(ranked).drop("topic_no", "category_no")
    columns = priced.drop("strategy_key", "topic_no", "category_no", "in_recent", "in_trending", "in_topic", "affinity_weight")
    out = ranked.join(F.broadcast(columns), "pick").withColumn("candidate_sources", cand.source_names()).drop("pick", "source_flags")
    return with_content_features(out).withColumn("score_breakdown", scoring.breakdown())


#: what the ranking reads of an item, and what its score adds up
RANKED_BY = ("pick", "topic_no", "category_no")
ADDENDS = ("affinity_weight", "w_recency", "w_engagement", "w_trending", "c_adjustment")


def with_total(ranked: DataFrame) -> DataFrame:
    """Each row with the number of its user's candidates."""
    return ranked.withColumn("total_candidates", F.count("*").over(Window.partitionBy("user_id")))


def page(ranked: DataFrame, users: DataFrame, limit: int = C.PAGE_DEFAULT_LIMIT, offset: int = 0) -> DataFrame:
    """K12 + K13: one page per user. Items ``offset < rank <= offset+limit``
    collected in rank order (bounded by ``limit``); users without candidates
    get an empty page with total 0."""
    if not (1 <= limit <= C.PAGE_MAX_LIMIT) or offset < 0:
        raise ValueError("limit must be 1..100 and offset >= 0")
    on_page = (F.col("rank") > offset) & (F.col("rank") <= offset + limit)
    # the first rank carries the total of a user without items on the page
    counted = ranked if "total_candidates" in ranked.columns else with_total(ranked)
    per_user = counted.filter(on_page | (F.col("rank") == 1)).groupBy("user_id").agg(
        F.max("total_candidates").alias("total_candidates"),
        F.sort_array(
            F.collect_list(
                F.when(on_page, F.struct(*[F.col(c) for c in ITEM_FIELDS], "score_breakdown", "content_features"))
            )
        ).alias("items"),
        F.first("experiment_key", ignorenulls=True).alias("experiment_key"),
        F.first("variant_key", ignorenulls=True).alias("variant_key"),
        F.first("strategy_name", ignorenulls=True).alias("strategy_name"),
    )
    out = users.select("user_id").join(per_user, "user_id", "left")
    return out.select(
        "user_id",
        "experiment_key",
        "variant_key",
        "strategy_name",
        F.lit(limit).alias("feed_limit"),
        F.lit(offset).alias("feed_offset"),
        F.coalesce("total_candidates", F.lit(0)).cast("long").alias("total_candidates"),
        (F.lit(offset + limit) < F.coalesce("total_candidates", F.lit(0))).alias("has_more"),
        F.coalesce("items", F.array()).alias("items"),
    )


def with_content_features(ranked: DataFrame) -> DataFrame:
    return ranked.withColumn(
        "content_features",
        F.struct(
            "content_id",
            "topic",
            *C.METRICS,
            *feat.FEATURE_COLUMNS,
            "last_event_at",
        ),
    )


def decisions(ranked: DataFrame, generated_at: str) -> DataFrame:
    """One ranking decision per user; the id is a digest of user
    and time, so a re-run writes the same record."""
    per_user = ranked.groupBy("user_id").agg(
        F.first("strategy_name", ignorenulls=True).alias("strategy_name"),
        F.count("*").alias("candidate_count"),
        F.sort_array(F.collect_list(F.struct("rank", "content_id", "score", "score_breakdown"))).alias("ranked_items"),
    )
    return per_user.select(
        F.sha2(F.concat_ws("|", F.col("user_id").cast("string"), F.lit(generated_at)), 256).alias("decision_id"),
        F.lit(C.RANKING_DECISION_SCHEMA_NAME).alias("schema_name"),
        "user_id",
        "strategy_name",
        "candidate_count",
        F.size("ranked_items").alias("ranked_count"),
        "ranked_items",
        ts_lit(generated_at).alias("generated_at"),
    )


def pages_for_exposure(
    pages: DataFrame, generated_at: str, session_col: str | None = None, correlation_id: str | None = None, cache_hit: bool = False
) -> DataFrame:
    """E4 input: a page with its exposure id, generation time, session,
    request and correlation ids and whether the cache served it. Ids are
    digests of the page's key, so a re-run records the same rows."""
    gen = ts_lit(generated_at)
    key = F.concat_ws("|", F.col("user_id").cast("string"), F.lit(generated_at), F.col("feed_offset").cast("string"))
    return pages.withColumns(
        {
            "exposure_id": F.sha2(key, 256),
            "generated_at": gen,
            "session_id": F.col(session_col).cast("string") if session_col else F.lit(None).cast("string"),
            "request_id": F.sha2(F.concat_ws("|", F.lit("request"), key), 256),
            "correlation_id": F.lit(correlation_id).cast("string"),
            "cache_hit": F.lit(bool(cache_hit)),
        }
    )


def write_feed_pages(pages: DataFrame, path: str, generated_at: str, ttl_seconds: int = C.FEED_CACHE_TTL_SECONDS) -> None:
    """Precomputed pages, valid ``ttl_seconds``; partitioned by generation hour."""
    gen = ts_lit(generated_at)
    out = (
        pages.withColumn("generated_at", gen)
        .withColumn("expires_at", F.timestamp_micros(micros(gen) + F.lit(ttl_seconds * 1_000_000)))
        .withColumn("generated_hour", F.date_format(gen, "yyyyMMddHH"))
    )
    out.write.mode("append").partitionBy("generated_hour").parquet(path)


def read_feed_pages(spark: SparkSession, path: str, now: str) -> DataFrame:
    """S12 reader: the latest unexpired page per user, experiment, variant,
    limit and offset (pages of no experiment have no such columns)."""
    p = spark.read.parquet(path).filter(F.col("expires_at") > ts_lit(now))
    w = Window.partitionBy("user_id", *[c for c in ("experiment_key", "variant_key") if c in p.columns], "feed_limit", "feed_offset").orderBy(F.col("generated_at").desc())
    return p.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
