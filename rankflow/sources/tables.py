"""Batch sources.

``table`` reads one parquet table with an explicit column list so the scan
only materializes what the plan needs (``ReadSchema`` shows the pruning).
The ``*_from_tables`` builders turn the shared star-schema tables into the
domain tables (interactions, content, users, profiles, exposures, ...). They
are plain projections and aggregations, planned by Catalyst like any query.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import micros, minus_hours, topic_at, ts_lit

AS_OF = "2024-01-31 00:00:00"

# fixture values of the operations log
SERVICES = ("feature-processor", "interaction-service", "ranking-service")
OPERATIONS = ("consume", "publish")
LOG_TOPICS = ("interactions.events.v1", "interactions.dead.v1")


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Scan of one table, lazy, with its own pushed filters and pruned columns."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*columns) if columns else df


# ---------------------------------------------------------------- F1
def interactions_from_events(events: DataFrame) -> DataFrame:
    """One interaction per event: type mapping, content id from ``props.k``,
    day session, topic by content, watch duration for completions. One SQL
    projection (a single plan node, built in one call)."""
    topics = "array(" + ", ".join(f"'{t}'" for t in C.TOPICS) + ")"
    k = "CAST(get_json_object(props, '$.k') AS BIGINT)"
    return events.selectExpr(
        "event_id",
        "CASE event_type"
        " WHEN 'view' THEN CASE WHEN event_id % 3 = 0 THEN 'watch_start' ELSE 'impression' END"
        " WHEN 'click' THEN 'click'"
        " WHEN 'signup' THEN 'like'"
        " WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 'watch_complete' ELSE 'save' END"
        " WHEN 'error' THEN 'skip' END AS event_type",
        "user_id",
        f"{k} AS content_id",
        "concat(CAST(user_id AS STRING), '-', date_format(ts, 'yyyyMMdd')) AS session_id",
        f"try_element_at({topics}, CAST({k} % 5 + 1 AS INT)) AS topic",
        "CAST(CASE WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN 1 + event_id % 600 ELSE 0 END AS INT)"
        " AS watch_duration_seconds",
        "CAST(ts AS TIMESTAMP) AS event_timestamp",
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "props"])
    return interactions_from_events(ev)


# ---------------------------------------------------------------- F2
def content_from_parts(part: DataFrame, as_of: str = AS_OF, general_category: bool = False) -> DataFrame:
    """Catalog of content items, one per part. ``general_category`` makes
    category vary independently of topic (exercises the general rerank).
    One SQL projection; hour offsets use long arithmetic on microseconds."""
    topics = "array(" + ", ".join(f"'{t}'" for t in C.TOPICS) + ")"
    cat_idx = "(p_partkey DIV 5) % 5" if general_category else "p_partkey % 5"
    now_us = f"unix_micros(to_timestamp('{as_of}'))"
    return part.selectExpr(
        "p_partkey AS content_id",
        "concat(p_name, ' ', CAST(p_partkey AS STRING)) AS title",
        f"try_element_at({topics}, CAST(p_partkey % 5 + 1 AS INT)) AS topic",
        f"try_element_at({topics}, CAST({cat_idx} + 1 AS INT)) AS category",
        "CASE WHEN p_partkey % 8 = 0 THEN 'draft' ELSE 'published' END AS status",
        f"CASE WHEN p_partkey % 8 <> 0 THEN timestamp_micros({now_us} - CAST(p_partkey * 4 AS BIGINT) * 3600000000) END"
        " AS published_at",
        f"timestamp_micros({now_us} - CAST(CASE WHEN p_partkey % 8 = 0 THEN p_partkey * 7 + 6 ELSE p_partkey * 4 + 12 END"
        " AS BIGINT) * 3600000000) AS created_at",
    )


def content(spark: SparkSession, sf_dir: str, general_category: bool = False, as_of: str = AS_OF) -> DataFrame:
    return content_from_parts(table(spark, sf_dir, "part", ["p_partkey", "p_name"]), as_of, general_category)


# ---------------------------------------------------------------- F3
def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer: a user without events still has a profile, an assignment and a feed."""
    return table(spark, sf_dir, "customer", ["c_custkey"]).select(F.col("c_custkey").alias("user_id"))


def user_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User rows, one per customer: username and email from the customer
    name, ``created_at`` up to a year before the tables' end, by the key."""
    cust = table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    uname = F.lower(F.regexp_replace("c_name", "#", "_"))
    age_hours = (F.col("c_custkey") * 97) % 8760 + 1
    return cust.select(
        F.col("c_custkey").alias("user_id"),
        uname.alias("username"),
        F.concat(uname, F.lit("@"), F.lower("c_mktsegment"), F.lit(".example")).alias("email"),
        F.col("c_name").alias("display_name"),
        F.timestamp_micros(micros(ts_lit(AS_OF)) - (age_hours * 3_600_000_000).cast("long")).alias("created_at"),
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile table: one per customer (the user table's 1:1 child)."""
    return profile_preferences(table(spark, sf_dir, "customer", ["c_custkey"]).select(F.col("c_custkey").alias("user_id")))


def profile_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile rows as stored upstream: one ``topic_preferences`` map per
    profile, built row-locally (no aggregation)."""
    u = F.col("c_custkey")
    prefs = [((u * 7 + F.lit(i + 1) * 13) % 101) / F.lit(100.0) for i in range(len(C.TOPICS))]
    return (
        table(spark, sf_dir, "customer", ["c_custkey"])
        .filter(u % 10 != 9)
        .select(
            u.alias("user_id"),
            F.map_from_arrays(F.array(*[F.lit(t) for t in C.TOPICS]), F.array(*prefs)).alias("topic_preferences"),
        )
    )


def profile_preferences(users_df: DataFrame) -> DataFrame:
    """Long-form profile preferences (user_id, topic, preference); users with
    id % 10 == 9 have no profile. Topics come from a generator, not a join."""
    topics = F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(t).alias("topic")) for i, t in enumerate(C.TOPICS)])
    u = F.col("user_id")
    return (
        users_df.filter(u % 10 != 9)
        .select(u, F.explode(topics).alias("t"))
        .select(
            "user_id",
            F.col("t.topic").alias("topic"),
            (((u * 7 + F.col("t.i") * 13) % 101) / F.lit(100.0)).alias("preference"),
        )
    )


# ---------------------------------------------------------------- F5 / F6
def exposure_items(interactions_df: DataFrame) -> DataFrame:
    """Pages: all content a user saw in one clock hour. One row per
    (page, content) with the page's ``generated_at``.

    Both steps are partial-aggregated before their shuffle and then joined,
    so a hot user-hour never lands in a single task as raw rows.
    """
    seen = interactions_df.filter(F.col("event_type").isin(*C.EXPOSURE_EVENT_TYPES)).select(
        "user_id", "content_id", F.date_trunc("hour", "event_timestamp").alias("page_hour"), "event_timestamp"
    )
    per_item = seen.groupBy("user_id", "page_hour", "content_id").agg(F.min("event_timestamp").alias("first_seen_at"))
    per_page = per_item.groupBy("user_id", "page_hour").agg(F.min("first_seen_at").alias("generated_at"))
    exposure_id = F.concat(F.col("user_id").cast("string"), F.lit("-"), F.date_format("page_hour", "yyyyMMddHH"))
    return per_item.join(per_page, ["user_id", "page_hour"]).select(
        exposure_id.alias("exposure_id"),
        F.concat(exposure_id, F.lit(":"), F.col("content_id").cast("string")).alias("item_id"),
        "user_id",
        "content_id",
        "generated_at",
    )


def outcome_events(interactions_df: DataFrame) -> DataFrame:
    return interactions_df.filter(F.col("event_type").isin(*C.OUTCOME_EVENT_TYPES))


# ---------------------------------------------------------------- F7
def dirty_interactions(interactions_df: DataFrame) -> DataFrame:
    """Interactions with deterministic defects keyed by ``event_id % 50``:
    0 unknown type, 1 completion without duration, 2 untrimmed upper-case
    topic, 3 empty session, 4 unsupported topic, 5 repeated row, 6 re-sent id
    with a later timestamp. ``ingest_seq`` is the arrival order."""
    d = F.col("event_id") % 50
    base = interactions_df.select(
        F.lit(C.INTERACTION_SCHEMA_NAME).alias("schema_name"),
        "event_id",
        F.when(d == 0, F.lit("share")).when(d == 1, F.lit("watch_complete")).otherwise(F.col("event_type")).alias(
            "event_type"
        ),
        "user_id",
        "content_id",
        F.when(d == 3, F.lit("")).otherwise(F.col("session_id")).alias("session_id"),
        F.when(d == 2, F.lit("  Backend ")).when(d == 4, F.lit("cooking")).otherwise(F.col("topic")).alias("topic"),
        F.when(d == 1, F.lit(0)).otherwise(F.col("watch_duration_seconds")).alias("watch_duration_seconds"),
        "event_timestamp",
    )
    # one scan: defects 5 and 6 emit a second copy through a generator
    copies = (
        F.when(d == 5, F.array(F.lit(0), F.lit(1)))
        .when(d == 6, F.array(F.lit(0), F.lit(2)))
        .otherwise(F.array(F.lit(0)))
    )
    out = base.select("*", F.explode(copies).alias("copy"))
    return out.select(
        *[c for c in base.columns if c != "event_timestamp"],
        F.when(F.col("copy") == 2, F.timestamp_micros(micros("event_timestamp") + F.lit(3_600_000_000)))
        .otherwise(F.col("event_timestamp"))
        .alias("event_timestamp"),
        (F.col("event_id") * 4 + F.col("copy")).alias("ingest_seq"),
    )


# ---------------------------------------------------------------- F8
def operations_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consumer log: one row per event; an ``error`` event is the one mapped
    to ``skip`` in F1 and is logged as a failed consume. Service, operation
    and topic vary with the event id."""
    ev = table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])
    pick = lambda names, by: F.element_at(F.array(*[F.lit(n) for n in names]), (by % len(names) + 1).cast("int"))
    return ev.select(
        F.col("ts").cast("timestamp").alias("ts"),
        pick(SERVICES, F.col("event_id")).alias("service"),
        pick(OPERATIONS, F.floor(F.col("event_id") / 3)).alias("operation"),
        pick(LOG_TOPICS, F.floor(F.col("event_id") / 7)).alias("topic"),
        F.when(F.col("event_type") == "error", F.lit("failure")).otherwise(F.lit("success")).alias("outcome"),
        (F.col("value") / F.lit(100.0)).alias("duration_seconds"),
    )
