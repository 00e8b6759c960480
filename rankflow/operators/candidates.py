"""Feed candidate generation for all users at once.

Plan shape:

* per user, one row: runtime affinity map (A12) and profile preference map,
  both left-joined on ``user_id`` (one shuffle by user);
* effective affinity (R1, R2) and the top topics (R3) are computed inside
  that row with higher-order functions: no window, no extra shuffle;
* the global pool (recent, trending, per-topic) is at most
  ``RECENT + TRENDING_SOURCE + |TOPICS| * TOPIC_LIMIT`` rows whatever the
  data size, so it is broadcast; users are expanded into one row per topic
  key (a generator) and equi-joined to the pool on that key. No cross join,
  and no per-(user, item) aggregation: candidate sources are flags carried
  by the pool row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import id_text, round6, sql_double
from .features import attach_features

# rows of the global pool, a structural bound independent of the data
POOL_MAX_ROWS = C.RECENT_LIMIT + C.TRENDING_SOURCE_LIMIT + len(C.TOPICS) * C.TOPIC_CANDIDATE_LIMIT
OTHER_TOPIC = ""


def top_k_per_group(df: DataFrame, group_cols: list[str], order: list[Column], k: int) -> DataFrame:
    """Top ``k`` rows per group (``_rank`` 1..k).

    ``row_number() <= k`` is planned with a partial ``WindowGroupLimit``
    before the exchange, so every map task sends at most ``k`` rows per group:
    a hot group shuffles ``k x tasks`` rows, not its size."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k)


# ------------------------------------------------------------------ R1..R3
def profile_map(profiles_long: DataFrame) -> DataFrame:
    """Profile preferences as one map per user (bounded by the topic list)."""
    return profiles_long.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("topic", "preference"))).alias("topic_preferences")
    )


def user_affinity_rows(users: DataFrame, runtime_map: DataFrame, profiles: DataFrame) -> DataFrame:
    """One row per user with ``affinity`` (array of (topic, score) for the
    five topics, R2) and ``top_topics`` (R3). J2: users without a profile get
    empty preferences; users without runtime vectors use the profile only."""
    rt = runtime_map.select("user_id", "topic_affinity")
    pm = profiles.select("user_id", "topic_preferences") if "topic_preferences" in profiles.columns else profile_map(profiles)
    u = users.select("user_id").join(rt, "user_id", "left").join(pm, "user_id", "left")
    rmap = F.coalesce(F.col("topic_affinity"), F.create_map().cast("map<string,double>"))
    pmap = F.coalesce(F.col("topic_preferences"), F.create_map().cast("map<string,double>"))
    # Scale by the max clipped score over *all* stored topics; keep the five
    scale = F.aggregate(F.map_values(rmap), F.lit(0.0), lambda acc, v: F.greatest(acc, F.greatest(v, F.lit(0.0))))
    in_topics = F.filter(F.map_keys(rmap), lambda k: k.isin(*C.TOPICS))
    has_runtime = (scale > 0) & (F.size(in_topics) > 0)
    scale = F.nullif(scale, F.lit(0.0))

    # staged so that each rounding applies to a column reference
    idx = range(len(C.TOPICS))
    s1 = u.select(
        "user_id",
        has_runtime.alias("_has"),
        *[(F.greatest(F.try_element_at(rmap, F.lit(t)), F.lit(0.0)) / scale).alias(f"_rt{i}") for i, t in enumerate(C.TOPICS)],
        *[F.coalesce(F.try_element_at(pmap, F.lit(t)), F.lit(0.0)).alias(f"_pf{i}") for i, t in enumerate(C.TOPICS)],
    )
    s2 = s1.select("user_id", "_has", *[F.coalesce(round6(f"_rt{i}"), F.lit(0.0)).alias(f"_rn{i}") for i in idx],
                   *[f"_pf{i}" for i in idx])

    def eff(i: int) -> Column:
        blended = round6(
            f"{sql_double(C.RUNTIME_AFFINITY_WEIGHT)} * _rn{i} + {sql_double(C.PROFILE_AFFINITY_WEIGHT)} * _pf{i}"
        )
        return F.when(F.col("_has"), blended).otherwise(round6(f"_pf{i}"))

    s3 = s2.select(
        "user_id", F.array(*[F.struct(F.lit(t).alias("topic"), eff(i).alias("affinity")) for i, t in enumerate(C.TOPICS)]).alias("affinity")
    )
    affinity = F.col("affinity")
    # (affinity desc, topic desc) is the descending order of (affinity, topic) structs
    ranked = F.sort_array(
        F.transform(
            F.filter(affinity, lambda x: x["affinity"] > 0),
            lambda x: F.struct(x["affinity"].alias("affinity"), x["topic"].alias("topic")),
        ),
        asc=False,
    )
    top = F.transform(F.slice(ranked, 1, C.MAX_TOPIC_SOURCES), lambda x: x["topic"])
    return s3.select("user_id", "affinity", top.alias("top_topics"))


def effective_affinity(user_rows: DataFrame) -> DataFrame:
    """Long form of R2/R3: (user_id, topic, affinity, topic_rank), rank 1..3
    among the user's top topics, 0 when the topic is not one of them."""
    # explode_outer: the array always holds the five topics, and a plain
    # explode would make the optimizer infer (and push down, inlined) a
    # non-empty filter over the whole affinity computation
    return user_rows.select("user_id", "top_topics", F.explode_outer("affinity").alias("a")).select(
        "user_id",
        F.col("a.topic").alias("topic"),
        F.col("a.affinity").alias("affinity"),
        F.array_position("top_topics", F.col("a.topic")).cast("int").alias("topic_rank"),
    )


# ------------------------------------------------------------------ R4..R6
def _recency_order() -> list[Column]:
    return [F.col("published_at").desc_nulls_last(), F.col("created_at").desc(), id_text("content_id").desc()]


POOL_ITEMS_MAX_ROWS = C.TRENDING_SEED_LIMIT + len(C.TOPICS) * C.TOPIC_CANDIDATE_LIMIT


def pool_items(content: DataFrame) -> DataFrame:
    """The items any pool can draw from: the 100 most recent published
    (global top-k, a TakeOrderedAndProject) and the 20 most recent per topic
    (limited before the shuffle). At most 100 + 5 * 20 rows."""
    cols = ["content_id", "title", "topic", "category", "published_at", "created_at"]
    published = content.filter(F.col("status") == "published").select(*cols)
    seed = published.orderBy(*_recency_order()).limit(C.TRENDING_SEED_LIMIT).select(
        *cols, F.lit(1).alias("in_seed"), F.lit(0).alias("in_topic")
    )
    per_topic = top_k_per_group(
        published.filter(F.col("topic").isin(*C.TOPICS)), ["topic"], _recency_order(), C.TOPIC_CANDIDATE_LIMIT,
    ).select(*cols, F.lit(0).alias("in_seed"), F.lit(1).alias("in_topic"))
    return seed.unionByName(per_topic).groupBy("content_id").agg(
        *[F.max(c).alias(c) for c in cols[1:]],  # one value per item: deterministic pick
        F.max("in_seed").alias("in_seed"),
        F.max("in_topic").alias("in_topic"),
    )


def flag_pool(items: DataFrame) -> DataFrame:
    """R4 recent: first 40 of the seed by recency; R5 trending: first 20 of
    the seed by (trending desc, coalesce(published_at, created_at) desc, id
    desc); R6: the per-topic items. Windows over the bounded item set."""
    seed_first = (F.col("in_seed") == 1).desc()
    by_recency = Window.orderBy(seed_first, *_recency_order())
    by_trending = Window.orderBy(
        seed_first,
        F.col("trending_score").desc(),
        F.coalesce("published_at", "created_at").desc(),
        id_text("content_id").desc(),
    )
    flagged = items.select(
        "*",
        ((F.col("in_seed") == 1) & (F.row_number().over(by_recency) <= C.RECENT_LIMIT)).cast("int").alias("in_recent"),
        ((F.col("in_seed") == 1) & (F.row_number().over(by_trending) <= C.TRENDING_SOURCE_LIMIT))
        .cast("int")
        .alias("in_trending"),
    )
    return flagged.filter((F.col("in_recent") == 1) | (F.col("in_trending") == 1) | (F.col("in_topic") == 1)).drop(
        "in_seed"
    )


def candidate_pool(content: DataFrame, features: DataFrame) -> DataFrame:
    """The global pool: one row per distinct item with source flags and its
    feature vector (J1: missing vectors become zero vectors)."""
    return flag_pool(attach_features(pool_items(content), features))


def pool_key_filter(events: DataFrame, items: DataFrame) -> DataFrame:
    """Events of pool items only: a semi-join to at most
    ``POOL_ITEMS_MAX_ROWS`` keys, broadcast, applied before any shuffle, so
    the feature aggregate for the feed touches only the pool's events."""
    return events.join(F.broadcast(items.select("content_id")), "content_id", "left_semi")


# ------------------------------------------------------------------ R7, R8
#: candidate sources in their order; source ``i`` is bit ``1 << i`` of ``source_flags``
SOURCES = ("recent", "trending", "topic_affinity")


def source_names(flags: str = "source_flags") -> Column:
    """The ordered ``candidate_sources`` of a candidate's flags."""
    return F.array_compact(F.array(*[F.when(F.col(flags).bitwiseAND(1 << i) > 0, F.lit(s)) for i, s in enumerate(SOURCES)]))


def generate(user_rows: DataFrame, pool: DataFrame, on: tuple[str, ...] = ()) -> DataFrame:
    """Candidates for every user: one row per (user, item) with its
    ``source_flags`` (see ``source_names``) and the user's affinity for the
    item's topic. ``on`` names further columns that user and pool row share."""
    keys = F.array(
        *[F.struct(F.lit(t).alias("topic_key"), F.lit(i).alias("_ti")) for i, t in enumerate(C.TOPICS)],
        F.struct(F.lit(OTHER_TOPIC).alias("topic_key"), F.lit(-1).alias("_ti")),
    )
    passthrough = [c for c in user_rows.columns if c not in ("user_id", "affinity", "top_topics")]
    u = user_rows.select("user_id", *passthrough, "affinity", "top_topics", F.explode(keys).alias("k")).select(
        "user_id",
        *passthrough,
        F.col("k.topic_key").alias("topic_key"),
        F.when(F.col("k._ti") >= 0, F.try_element_at("affinity", (F.col("k._ti") + 1).cast("int"))["affinity"])
        .otherwise(F.lit(0.0))
        .alias("user_topic_affinity"),
        F.array_contains("top_topics", F.col("k.topic_key")).alias("is_top_topic"),
    )
    p = pool.withColumn(
        "topic_key", F.when(F.col("topic").isin(*C.TOPICS), F.col("topic")).otherwise(F.lit(OTHER_TOPIC))
    )
    joined = u.join(F.broadcast(p), ["topic_key", *on])
    held = (F.col("in_recent") == 1, F.col("in_trending") == 1, (F.col("in_topic") == 1) & F.col("is_top_topic"))
    flags = sum((F.when(h, F.lit(1 << i)).otherwise(F.lit(0)) for i, h in enumerate(held)), F.lit(0))
    return (
        joined.withColumn("source_flags", flags)
        .filter(F.col("source_flags") > 0)
        .drop("topic_key", "is_top_topic", "in_recent", "in_trending", "in_topic")
    )
