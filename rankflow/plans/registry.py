"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator family. Each reads the shared tables at full size and lets Spark
plan the work; results are returned lazily (the caller collects).

Presentation only: timestamps are returned as ``timestamp_ntz`` (the source
type) and arrays that a report shows as text are joined with commas.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from .. import sinks
from .. import sources as S
from ..functions import micros, ts_lit
from ..operators import attribution as attr
from ..operators import candidates as cand
from ..operators import catalog, experiments, feed, ingest, insights, ops, scoring, validate
from ..operators import features as feat
from ..session import configure, materialize

AS_OF = S.AS_OF
FULL_SPAN_HOURS = C.FEATURE_WINDOW_MAX_HOURS  # 720 h covers the whole event table


def finalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _it(spark: SparkSession, sf: str) -> DataFrame:
    return S.interactions(spark, sf)


# ------------------------------------------------------------------ features
def q_content_features(spark, sf):
    return finalize(feat.content_features(_it(spark, sf), AS_OF, C.FEATURE_WINDOW_HOURS))


def q_content_feature_validation(spark, sf):
    """Every vector with its errors; counts, rates and window."""
    v = validate.content_feature_vectors(feat.content_features(_it(spark, sf), AS_OF, C.FEATURE_WINDOW_HOURS))
    return v.select("content_id", *C.METRICS, F.array_join("errors", ";").alias("errors"))


def q_content_features_strict(spark, sf):
    """V13, strict form: only vectors within all bounds."""
    cf = feat.content_features(_it(spark, sf), AS_OF, C.FEATURE_WINDOW_HOURS).drop("rate_out_of_bounds")
    return finalize(validate.content_feature_vectors(cf, strict=True))


def q_content_features_30d(spark, sf):
    return finalize(feat.content_features(_it(spark, sf), AS_OF, FULL_SPAN_HOURS))


def q_user_topic_affinity(spark, sf):
    return finalize(feat.user_topic_affinity(_it(spark, sf), AS_OF, C.FEATURE_WINDOW_HOURS))


def q_user_topic_affinity_30d(spark, sf):
    return finalize(feat.user_topic_affinity(_it(spark, sf), AS_OF, FULL_SPAN_HOURS))


def q_point_in_time_features(spark, sf):
    return finalize(feat.point_in_time_counts(_it(spark, sf), "content_id", C.FEATURE_WINDOW_HOURS))


def q_daily_snapshot_as_of(spark, sf):
    """Daily content snapshots over the whole history (each day's
    vector as of its midnight), then the latest snapshot as of a time."""
    until = "2024-01-20 12:00:00"
    snaps = feat.daily_content_snapshots(_it(spark, sf), C.FEATURE_WINDOW_HOURS, until)
    return finalize(feat.snapshot_as_of(snaps, ["content_id"], until))


# --------------------------------------------------------------- experiments
def _assignments(spark, sf):
    return experiments.assign(S.users(spark, sf), experiments.variants_table(spark))


def q_experiment_assignments(spark, sf):
    return _assignments(spark, sf)


def _exposures(spark, sf):
    """Header and items of the hour pages (F5) with the user's variant.

    The items are the exposure table (S11): worked out once, read by every
    branch of the attribution."""
    it = _it(spark, sf)
    # assignment is row-local (hash of the user id), so the items carry the header's fields
    items = experiments.assign(S.exposure_items(it), experiments.variants_table(spark)).withColumn(
        "created_at", F.col("generated_at")
    )
    items = materialize(items)
    header = items.select(
        "exposure_id", "user_id", "generated_at", "created_at", "experiment_key", "variant_key", "strategy_name"
    ).distinct()
    return header, items, it


def q_exposure_items(spark, sf):
    _, items, _ = _exposures(spark, sf)
    return finalize(items.select(
        "exposure_id", "item_id", "user_id", "content_id", "generated_at", "variant_key", "strategy_name"
    ))


def q_attributed_outcomes(spark, sf):
    """Stored items know only their page; the header says whose it was."""
    header, items, it = _exposures(spark, sf)
    ex = attr.exposed_items(header, items.select("item_id", "exposure_id", "content_id", "created_at"))
    return finalize(attr.attribute(S.outcome_events(it), ex))


def q_experiment_comparison(spark, sf):
    header, items, it = _exposures(spark, sf)
    return attr.strategy_comparison(header, items, S.outcome_events(it), AS_OF, FULL_SPAN_HOURS)


def q_experiment_comparison_7d(spark, sf):
    header, items, it = _exposures(spark, sf)
    return attr.strategy_comparison(header, items, S.outcome_events(it), AS_OF, C.ANALYTICS_LOOKBACK_HOURS)


def q_best_strategy(spark, sf):
    return attr.best_strategy(q_experiment_comparison(spark, sf))


# ---------------------------------------------------------------- candidates
def _feed_inputs(spark, sf, general_category=False):
    it = _it(spark, sf)
    users = S.users(spark, sf)
    return it, users, S.content(spark, sf, general_category), S.profile_maps(spark, sf)


def _user_rows(spark, sf):
    it, users, _, profiles = _feed_inputs(spark, sf)
    runtime = feat.affinity_map_pivot(it, AS_OF, C.FEATURE_WINDOW_HOURS)
    return cand.user_affinity_rows(users, runtime, profiles)


def q_effective_affinity(spark, sf):
    return cand.effective_affinity(_user_rows(spark, sf))


def q_candidate_pool(spark, sf):
    it, _, content, _ = _feed_inputs(spark, sf)
    pool = cand.candidate_pool(content, feat.content_features(it, AS_OF, C.FEATURE_WINDOW_HOURS))
    return finalize(pool.select(
        "content_id", "topic", "category", "published_at", "in_recent", "in_trending", "in_topic", "trending_score"
    ))


def _ranked_with_users(spark, sf, mode="auto", diversity=True, general_category=False):
    it, users, content, profiles = _feed_inputs(spark, sf, general_category)
    ranked = feed.build(spark, users, it, content, profiles, AS_OF, C.FEATURE_WINDOW_HOURS, mode, diversity)
    return ranked, users


def _ranked(spark, sf, mode="auto", diversity=True, general_category=False):
    return _ranked_with_users(spark, sf, mode, diversity, general_category)[0]


def _ranked_columns(df: DataFrame) -> DataFrame:
    return finalize(df.select(
        "user_id",
        "content_id",
        "topic",
        "category",
        F.array_join("candidate_sources", ",").alias("candidate_sources"),
        "user_topic_affinity",
        "strategy_name",
        "base_score",
        "diversity_penalty",
        "score",
        "rank",
    ))


def q_feed_candidates(spark, sf):
    r = _ranked(spark, sf)
    return finalize(r.select(
        "user_id", "content_id", "topic", "published_at",
        F.array_join("candidate_sources", ",").alias("candidate_sources"),
        "user_topic_affinity", "trending_score", "completion_rate",
    ))


def q_scored_candidates(spark, sf):
    r = _ranked(spark, sf)
    return r.select(
        "user_id", "content_id", "strategy_name",
        F.col("c_affinity").alias("affinity"), F.col("c_recency").alias("recency"),
        F.col("c_engagement").alias("engagement"), F.col("c_trending").alias("trending"),
        F.col("c_adjustment").alias("strategy_adjustment"), "base_score",
    )


def q_ranked_feed(spark, sf):
    return _ranked_columns(_ranked(spark, sf))


def q_ranked_feed_no_diversity(spark, sf):
    return _ranked_columns(_ranked(spark, sf, diversity=False))


def q_ranked_feed_general(spark, sf):
    return _ranked_columns(_ranked(spark, sf, mode="greedy", general_category=True))


def q_feed_pages(spark, sf):
    ranked, users = _ranked_with_users(spark, sf)
    pages = feed.page(ranked, users, C.PAGE_DEFAULT_LIMIT, 0)
    return pages.select(
        "user_id", "variant_key", "strategy_name", "feed_limit", "feed_offset", "total_candidates", "has_more",
        F.size("items").alias("item_count"),
        F.array_join(F.transform("items", lambda x: x["content_id"].cast("string")), ",").alias("content_ids"),
    )


def q_feed_pages_second(spark, sf):
    ranked, users = _ranked_with_users(spark, sf)
    pages = feed.page(ranked, users, C.PAGE_DEFAULT_LIMIT, C.PAGE_DEFAULT_LIMIT)
    return pages.select(
        "user_id", "total_candidates", "has_more", F.size("items").alias("item_count"),
        F.array_join(F.transform("items", lambda x: x["content_id"].cast("string")), ",").alias("content_ids"),
    )


def q_ranking_decisions(spark, sf):
    d = feed.decisions(_ranked(spark, sf), AS_OF)
    return finalize(d.select(
        "decision_id", "schema_name", "user_id", "strategy_name", "candidate_count", "ranked_count",
        F.col("ranked_items")[0]["content_id"].alias("top_content_id"),
        F.col("ranked_items")[0]["score"].alias("top_score"),
        "generated_at",
    ))


def _feed_pages_recorded(spark, sf):
    ranked, users = _ranked_with_users(spark, sf)
    return feed.pages_for_exposure(feed.page(ranked, users, C.PAGE_DEFAULT_LIMIT, 0), AS_OF)


def q_feed_exposure_items(spark, sf):
    """Exposure item rows recorded for every delivered first page (one
    pass over the pages: the header fields travel with the exploded items)."""
    _, items = experiments.exposures_from_pages(
        _feed_pages_recorded(spark, sf), carry=("user_id", "variant_key", "strategy_name")
    )
    return finalize(items)


def q_feed_exposure_headers(spark, sf):
    """The header row of every delivered first page, with the session, request,
    correlation and cache fields that its request carried."""
    ranked, users = _ranked_with_users(spark, sf)
    pages = feed.page(ranked, users, C.PAGE_DEFAULT_LIMIT, 0).withColumn("session", F.concat(F.lit("home-"), "user_id"))
    recorded = feed.pages_for_exposure(pages, AS_OF, session_col="session", correlation_id="home-feed")
    header, _ = experiments.exposures_from_pages(recorded)
    return finalize(header)


def q_exposure_validation(spark, sf):
    """J13 + V15: recorded exposures checked against a stored assignment
    table in which users with id % 7 == 0 were moved to the other variant
    and users with id % 11 == 0 have no stored row."""
    pages = _feed_pages_recorded(spark, sf)
    stored = experiments.assign(S.users(spark, sf), experiments.variants_table(spark))
    flip = F.col("user_id") % 7 == 0
    stored = stored.filter(F.col("user_id") % 11 != 0).select(
        "experiment_key",
        "user_id",
        F.when(flip & (F.col("variant_key") == "control"), F.lit("trending_boost"))
        .when(flip, F.lit("control"))
        .otherwise(F.col("variant_key"))
        .alias("variant_key"),
        F.when(flip & (F.col("strategy_name") == C.RULES_V1), F.lit(C.RULES_V2))
        .when(flip, F.lit(C.RULES_V1))
        .otherwise(F.col("strategy_name"))
        .alias("strategy_name"),
    )
    v = experiments.validate_pages(pages, stored)
    return finalize(v.select(
        "exposure_id", "user_id", "variant_key", "strategy_name", "feed_limit", "feed_offset", "generated_at",
        F.array_join("errors", ";").alias("errors"),
    ))


# -------------------------------------------------------- validation, ingest
def _dirty(spark, sf):
    return S.dirty_interactions(_it(spark, sf))


def q_interaction_validation(spark, sf):
    v = validate.interactions(_dirty(spark, sf))
    return finalize(v.select(
        "event_id", "ingest_seq", "event_type", "topic", "session_id",
        F.array_join("errors", ";").alias("errors"),
    ))


def q_dead_letters(spark, sf):
    v = validate.interactions(_dirty(spark, sf))
    dl = validate.dead_letters(v, service="feature-processor", occurred_at=AS_OF)
    return finalize(dl.select("event_id", "ingest_seq", "error_type", "error_message", "attempts", "failed_service"))


def q_deduplicated_interactions(spark, sf):
    v = validate.interactions(_dirty(spark, sf))
    valid = v.filter(F.size("errors") == 0)
    return finalize(ingest.dedupe_first(valid).select(
        "event_id", "ingest_seq", "event_type", "topic", "event_timestamp"
    ))


def q_idempotent_counts(spark, sf):
    v = validate.interactions(_dirty(spark, sf)).filter(F.size("errors") == 0)
    latest = feat.dedupe_events(v, arrival="ingest_seq")
    return finalize(feat.content_features(latest, AS_OF, FULL_SPAN_HOURS))


def q_duplicate_event_report(spark, sf):
    return validate.unique_violations(_dirty(spark, sf), ["event_id"], "event_id")


def _uuid_text(c: str) -> F.Column:
    return F.format_string("00000000-0000-0000-0000-%012d", F.col(c))


def q_stream_replay_features(spark, sf):
    """S1 + I4 + W1 + S2/S5/S6/S7 end to end: the interactions are written
    as JSON records (UUID-form ids, as the contract requires) into a fresh
    folder under the shared checkpoint directory, drained through the
    Structured Streaming features job, and the latest content vectors are
    read back (merge-on-read)."""
    from ..sources import streams

    root = _stream_root(spark)
    records = _broker_values(_it(spark, sf))
    records.select("value").write.mode("overwrite").text(f"{root}/in")
    _drain(spark, streams.read_interactions(spark, source="json", path=f"{root}/in", max_records_per_trigger=STREAM_FILES), root)
    return _latest_vectors(spark, root)


#: files of a micro-batch
STREAM_FILES = 8


def _stream_root(spark) -> str:
    import uuid

    from ..session import checkpoint_dir

    return f"{checkpoint_dir(spark).rstrip('/')}/rankflow-stream-{uuid.uuid4().hex}"


def _broker_values(it: DataFrame, *others) -> DataFrame:
    """Interactions as JSON records with UUID-form ids, beside ``others``."""
    fields = [
        F.lit(C.INTERACTION_SCHEMA_NAME).alias("schema_name"),
        _uuid_text("event_id").alias("event_id"),
        F.col("event_type"),
        _uuid_text("user_id").alias("user_id"),
        _uuid_text("content_id").alias("content_id"),
        F.col("session_id"),
        F.col("topic"),
        F.col("watch_duration_seconds"),
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_timestamp"),
    ]
    return it.select(F.to_json(F.struct(*fields)).alias("value"), *others)


def _drain(spark, stream, root: str, as_of=lambda _b: AS_OF) -> None:
    from ..streaming import features_job

    q = features_job.start(stream, f"{root}/out", C.FEATURE_WINDOW_HOURS, as_of=as_of,
                           trigger={"availableNow": True}, checkpoint=f"{root}/ckpt", query_name=None)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _latest_vectors(spark, root: str) -> DataFrame:
    latest = sinks.read_latest(
        spark, f"{root}/out/content_features_latest", ["content_id"], as_of=AS_OF, window_hours=C.FEATURE_WINDOW_HOURS
    )
    return finalize(latest.select(
        "content_id", "topic", *C.METRICS, "ctr", "like_rate", "save_rate", "skip_rate", "completion_rate",
        "trending_score", "last_event_at",
    ))


#: folders of drains by application and input: the queries on one stream read one run of it
_DRAINED: dict[tuple[str, str], str] = {}


def _drained_dirty(spark, sf) -> str:
    """The defective interactions (F7) as broker records in three
    micro-batches: every second copy of an id arrives in a later one."""
    from ..sources import streams

    this = (spark.sparkContext.applicationId, sf)
    if this in _DRAINED:
        return _DRAINED[this]
    root = _stream_root(spark)
    dirty = _dirty(spark, sf)
    copy = F.col("ingest_seq") - F.col("event_id") * 4
    records = _broker_values(
        dirty, F.col("user_id").cast("string").alias("key"), F.lit("interactions.events.v1").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"), F.col("ingest_seq").alias("offset"), F.col("event_timestamp").alias("timestamp"),
        F.array(F.struct(F.lit("x-request-id").alias("key"), F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("value"))).alias("headers"),
        (F.col("event_id") % 2 + F.when(copy > 0, 1).otherwise(0)).cast("int").alias("step"),
    )
    for step in range(3):
        part = records.filter(F.col("step") == step).drop("step")
        part.repartition(STREAM_FILES).write.mode("append").parquet(f"{root}/in")
    _drain(spark, streams.read_interactions(spark, source="records", path=f"{root}/in", max_records_per_trigger=STREAM_FILES), root)
    _DRAINED[this] = root
    return root


def q_stream_dirty_features(spark, sf):
    """I1 + I2 + W1 + W4 through the stream: re-sent ids and defective records
    in several micro-batches; the latest vectors count each id once, by its
    last arrival."""
    return _latest_vectors(spark, _drained_dirty(spark, sf))


def q_stream_dead_letters(spark, sf):
    """S5 + V14 through the stream: what was rejected, with its broker envelope."""
    dead = spark.read.parquet(f"{_drained_dirty(spark, sf)}/out/dead_letters")
    return dead.select(
        "event_id", "error_type", "error_message", "source_topic", "source_partition", "source_offset", "source_key", "request_id", "attempts"
    )


def q_stream_audit(spark, sf):
    """S2 + I1 + S13 through the stream: one audit row per accepted id (its
    first arrival), read back from the stored payload."""
    from ..sources import streams

    audit = spark.read.parquet(f"{_drained_dirty(spark, sf)}/out/audit")
    return finalize(streams.replay_audit(audit).select("event_id", "event_type", "user_id", "content_id", "topic", "event_timestamp"))


def q_stream_flushes(spark, sf):
    """W5 + O5 + O6 from the stream's own tables: per flush the records, the
    rejected ones, the keys written and the records still waiting."""
    flushes = sinks.stored(spark, f"{_drained_dirty(spark, sf)}/out/flushes", sinks.FLUSH_SCHEMA)
    ends = spark.read.parquet(f"{_drained_dirty(spark, sf)}/in").groupBy("topic", F.col("partition").cast("long").alias("partition")).agg(
        F.min("offset").alias("low_offset"), F.max("offset").alias("end_offset")
    )
    report = ops.flush_report(flushes)
    lag = None
    for batch in range(3):
        one = ops.lag_after(flushes, ends, batch).agg(F.max("lag").alias("most_lag")).select(F.lit(batch).alias("batch_id"), "most_lag")
        lag = one if lag is None else lag.unionByName(one)
    return finalize(report.join(lag, "batch_id"))


def q_stream_continuous_features(spark, sf):
    """W1 + W2 + I2 in keyed state: the defective interactions in two
    micro-batches through the two stateful steps; the last vector of every content."""
    from ..streaming import continuous

    root = _stream_root(spark)
    valid = validate.interactions(_dirty(spark, sf)).filter(F.size("errors") == 0)
    rows = valid.select(
        F.col("event_id").cast("string").alias("event_id"), F.col("ingest_seq").alias("seq"), F.col("content_id").cast("string").alias("content_id"),
        "topic", "event_type", "event_timestamp",
    )
    # every step is drained when it is written, so that it is one micro-batch of as many files as the table has partitions
    for step in range(2):
        part = rows.filter(F.col("seq") % 2 == 0) if step == 0 else rows.filter(F.col("seq") % 2 != 0)
        part.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        continuous.drain(continuous.vectors(continuous.changes(stream, C.FEATURE_WINDOW_HOURS), C.FEATURE_WINDOW_HOURS, AS_OF), f"{root}/out", f"{root}/ckpt", AS_OF)
    latest = sinks.read_latest(spark, f"{root}/out", ["content_id"], as_of=AS_OF, window_hours=C.FEATURE_WINDOW_HOURS)
    return finalize(latest.select(
        F.col("content_id").cast("long").alias("content_id"), "topic", *C.METRICS, "ctr", "like_rate", "save_rate", "skip_rate", "completion_rate",
        "trending_score", "last_event_at", "last_exact",
    ))


#: days of the moving stream, and which of the last day's events come on its first one
MOVING_DAYS, AHEAD = 4, 10


def q_stream_moving_window(spark, sf):
    """I4 + W3: a stream whose first micro-batch holds nothing but broken
    records and whose ``as_of`` moves over four days; a tenth of the last day's
    events arrive three days ahead. The vectors come from the events that the
    store still holds at the end."""
    from ..sources import streams
    from ..streaming import features_job

    root = _stream_root(spark)
    end = ts_lit(AS_OF)
    back = F.ceil((micros(end) - micros("event_timestamp")) / F.lit(86_400_000_000)).cast("int")
    it = _it(spark, sf).withColumn("day", F.lit(MOVING_DAYS + 1) - F.greatest(back, F.lit(1)))
    it = it.filter(F.col("day").between(1, MOVING_DAYS))
    sent = F.when((F.col("day") == MOVING_DAYS) & (F.col("event_id") % AHEAD == 0), F.lit(1)).otherwise(F.col("day"))
    records = _broker_values(
        it, F.col("user_id").cast("string").alias("key"), F.lit("interactions.events.v1").alias("topic"), F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"), F.timestamp_micros(micros(end) - (F.lit(MOVING_DAYS) - sent).cast("long") * 86_400_000_000).alias("timestamp"),
        F.lit(None).cast("array<struct<key: string, value: string>>").alias("headers"), sent.alias("step"),
    )
    broken = records.filter(F.col("step") == 1).withColumn("value", F.expr("left(value, length(value) - 7)")).withColumn("step", F.lit(0))
    # every step is drained when it is written, so that it is one micro-batch of as many files as the
    # table has partitions; an empty day leaves a file without rows
    for step in range(MOVING_DAYS + 1):
        part = (broken if step == 0 else records).filter(F.col("step") == step).drop("step")
        part.write.mode("append").parquet(f"{root}/in")
        _drain(spark, streams.read_interactions(spark, source="records", path=f"{root}/in"), root, features_job.max_broker_time)
    events = features_job.current_events(spark, f"{root}/out", AS_OF, C.FEATURE_WINDOW_HOURS)
    v = feat.content_features(events, AS_OF, C.FEATURE_WINDOW_HOURS)
    return finalize(v.select(
        "content_id", "topic", *C.METRICS, "ctr", "like_rate", "save_rate", "skip_rate", "completion_rate", "trending_score", "last_event_at"
    ))


def q_versioned_features(spark, sf):
    """S7 + S8 as table versions: the vectors of three days are upserted, the
    table is folded in place, and both the version from before the last day and
    the newest one are read afterwards."""
    path = f"{_stream_root(spark)}/latest"
    pinned = 0
    for batch in range(3):
        t = days_later(batch - 2)
        v = feat.content_features(_it(spark, sf), t, C.FEATURE_WINDOW_HOURS)
        sinks.upsert_latest(v.withColumn("updated_at", ts_lit(t)), path, batch, ["content_id"])
        pinned = pinned if batch == 2 else sinks.versions.VersionedTable(spark, path).version()
    sinks.compact_latest(spark, path, ["content_id"])
    out = None
    for label, version in (("before", pinned), ("after", None)):
        rows = sinks.read_latest(spark, path, ["content_id"], version=version).select(F.lit(label).alias("read"), "content_id", "topic", *C.METRICS, "trending_score", "updated_at")
        out = rows if out is None else out.unionByName(rows)
    return finalize(out)


def days_later(days: int) -> str:
    """``AS_OF`` so many days later."""
    import datetime as dt

    return (dt.datetime.fromisoformat(AS_OF) + dt.timedelta(days=days)).strftime("%Y-%m-%d %H:%M:%S")


# ---------------------------------------------- intake rules and small tables
def _scores(pairs) -> F.Column:
    """A map literal from (key, score) pairs; a score may be null or a SQL number."""
    entries = ", ".join(f"'{k}', CAST({v} AS DOUBLE)" for k, v in pairs)
    return F.expr(f"map({entries})")


# preference and affinity maps of the fixture, by user id % 6
PREFERENCE_FIXTURE = (
    ((" AI ", "0.5"), ("backend", "0.2")), (("cooking", "0.5"),), (("ai", "1.5"),), (("", "0.1"),), (("devops", "NULL"),),
    (("ai", "0.0"), ("system-design", "1.0")),
)
AFFINITY_FIXTURE = (
    (("AI", "12.5"), ("devops", "-3.0")), (("sport", "1.0"),), (("ai", "'NaN'"),), (("backend", "'Infinity'"),), (("  ", "1.0"),),
    (("interview-prep", "0.0"),),
)


def _with_map(spark, sf, name, fixture) -> DataFrame:
    which = F.col("user_id") % len(fixture)
    col = F.lit(None)
    for i, pairs in enumerate(fixture):
        col = F.when(which == i, _scores(pairs)).otherwise(col)
    return S.users(spark, sf).withColumn(name, col)


def _map_report(v: DataFrame, name: str) -> DataFrame:
    return v.select(
        "user_id", F.array_join(F.array_sort(F.map_keys(name)), ",").alias("topics"), F.array_join("errors", ";").alias("errors")
    )


def q_preference_validation(spark, sf):
    """V6 over every customer."""
    return _map_report(validate.topic_preferences(_with_map(spark, sf, "topic_preferences", PREFERENCE_FIXTURE)), "topic_preferences")


def q_affinity_validation(spark, sf):
    """V7 over every customer."""
    return _map_report(validate.topic_affinity(_with_map(spark, sf, "topic_affinity", AFFINITY_FIXTURE)), "topic_affinity")


def _parts(spark, sf) -> DataFrame:
    return S.table(spark, sf, "part", ["p_partkey", "p_name"])


def q_content_validation(spark, sf):
    """V8 over the catalog with a defect in every field."""
    raw = _parts(spark, sf).selectExpr(
        "p_partkey AS content_id",
        "CASE p_partkey % 7 WHEN 0 THEN '  ab  ' WHEN 1 THEN repeat('long ', 101) ELSE concat(' ', p_name, ' ') END AS title",
        "CASE p_partkey % 11 WHEN 0 THEN repeat('x', 2001) WHEN 1 THEN '   ' ELSE 'text' END AS description",
        "CASE p_partkey % 13 WHEN 0 THEN NULL WHEN 1 THEN repeat('t', 101) ELSE ' AI ' END AS topic",
        "CASE WHEN p_partkey % 5 = 0 THEN 'sports' ELSE 'ai' END AS category",
        "CASE p_partkey % 9 WHEN 0 THEN 'gone' WHEN 1 THEN NULL ELSE 'published' END AS status",
    )
    return validate.content(raw).select(
        "content_id", F.length("title").alias("title_chars"), F.col("description").isNull().alias("no_description"), "topic", "status",
        F.array_join("errors", ";").alias("errors"),
    )


def q_tag_validation(spark, sf):
    """V9 over tag names derived from the catalog."""
    raw = _parts(spark, sf).selectExpr(
        "p_partkey AS tag_id",
        "CASE p_partkey % 4 WHEN 0 THEN '   ' WHEN 1 THEN repeat('n', 256) ELSE concat('  ', upper(p_name)) END AS name",
        "CASE WHEN p_partkey % 6 = 0 THEN repeat('d', 501) END AS description",
    )
    return validate.tags(raw).select("tag_id", "name", F.array_join("errors", ";").alias("errors"))


def q_candidate_validation(spark, sf):
    """V11 over candidates derived from the catalog."""
    raw = _parts(spark, sf).selectExpr(
        "p_partkey AS content_id",
        "CASE p_partkey % 10 WHEN 0 THEN ' ' WHEN 1 THEN repeat('t', 501) ELSE p_name END AS title",
        "(p_partkey % 13) / 10.0D AS user_topic_affinity",
        "CASE WHEN p_partkey % 17 = 0 THEN '' ELSE 'ai' END AS topic",
        "array('trending', 'recent', 'trending') AS candidate_sources",
        "named_struct('content_id', p_partkey + CAST(p_partkey % 19 = 0 AS INT)) AS content_features",
    )
    return scoring.validate_candidates(raw).select(
        "content_id", F.array_join("candidate_sources", ",").alias("candidate_sources"), F.array_join("errors", ";").alias("errors")
    )


def q_publish_outbox(spark, sf):
    """Rows whose publication is recorded now, and the ones still pending."""
    audit = _it(spark, sf).select(
        "event_id", F.when(F.col("event_id") % 3 != 0, F.col("event_timestamp")).alias("published_at")
    )
    sent = ingest.pending_publish(audit).filter(F.col("event_id") % 6 == 0)
    out = ingest.mark_published(audit, sent, AS_OF)
    return finalize(out.withColumn("pending", F.col("published_at").isNull()))


def q_keyed_records(spark, sf):
    """S3: every interaction as a keyed JSON record."""
    it = _it(spark, sf).select("event_id", "event_type", "user_id", "content_id", "topic")
    return sinks.to_keyed_json(it, "user_id").select("key", "value")


def q_affinity_map_read(spark, sf):
    """The long affinity table read back as one map per user."""
    m = sinks.read_affinity_map(feat.user_topic_affinity(_it(spark, sf), AS_OF, C.FEATURE_WINDOW_HOURS))
    topics = [F.try_element_at("topic_affinity", F.lit(t)).alias(t.replace("-", "_")) for t in C.TOPICS]
    return m.select("user_id", F.size("topic_affinity").alias("n_topics"), *topics)


def q_tag_resolution(spark, sf):
    """Requested tag ids, repeats and unknown ones included, per item."""
    c = S.content(spark, sf)
    tags, _ = catalog.derive_tags(c)
    tag_id = lambda name: F.substring(F.sha2(name, 256), 1, 32)
    unknown = F.concat(F.lit("none-"), (F.col("content_id") % 5).cast("string"))
    requests = c.select(
        F.col("content_id").alias("request_id"),
        F.array(tag_id(F.lit("llm")), tag_id(unknown), tag_id(F.col("topic")), tag_id(F.lit("llm"))).alias("tag_ids"),
    )
    found = catalog.resolve_tag_ids(requests, tags)
    return found.select(
        "request_id", F.array_join(F.transform("tags", lambda t: t["name"]), ",").alias("names"), F.size("unknown_tag_ids").alias("unknown")
    )


def q_content_intake(spark, sf):
    """C5 + V16: new items with stored, repeated and fresh titles."""
    c = S.content(spark, sf)
    new = c.select(
        (F.col("content_id") + 10_000_000).alias("content_id"),
        F.when(F.col("content_id") % 4 == 0, F.col("title"))
        .when(F.col("content_id") % 4 == 1, F.concat(F.lit("repeated "), F.floor(F.col("content_id") / 40).cast("string")))
        .otherwise(F.concat(F.lit("fresh item "), F.col("content_id").cast("string")))
        .alias("title"),
        "topic", "category", F.lit("published").alias("status"),
    )
    everything, rejected = catalog.append_content(c, new, AS_OF)
    taken = everything.filter(F.col("content_id") > 10_000_000).select("content_id", "title", "published_at", F.lit("").alias("errors"))
    return finalize(taken.unionByName(rejected.select(
        "content_id", "title", F.lit(None).cast("timestamp").alias("published_at"), F.array_join("errors", ";").alias("errors")
    )))


def q_direct_attribution(spark, sf):
    """Outcomes that name in their metadata the page they came from (here
    the latest earlier one, for every second event)."""
    _, items, it = _exposures(spark, sf)
    told = attr.attribute(S.outcome_events(it), items).select(
        "event_id", "event_type", "content_id", F.when(F.col("event_id") % 2 == 0, F.col("exposure_id")).otherwise("none").alias("page")
    )
    out = told.withColumn("metadata", F.to_json(F.struct(F.col("page").alias("feed_exposure_id")))).drop("page")
    found = attr.attribute_direct(out, S.exposure_items(it))
    return found.select("event_id", "event_type", "exposure_id", "item_id")


def q_feed_page_cache(spark, sf):
    """First pages written twice, two minutes apart, and read back half a
    minute after the second time: the older ones have expired."""
    path = f"{_stream_root(spark)}/pages"
    ranked, users = _ranked_with_users(spark, sf)
    pages = feed.page(ranked, users, C.PAGE_DEFAULT_LIMIT, 0).drop("items")
    feed.write_feed_pages(pages, path, "2024-01-30 23:58:00")
    feed.write_feed_pages(pages.filter(F.col("user_id") % 5 != 0), path, AS_OF)
    return finalize(feed.read_feed_pages(spark, path, "2024-01-31 00:00:30").select(
        "user_id", "experiment_key", "variant_key", "total_candidates", "generated_at", "expires_at"
    ))


# ------------------------------------------------------------------- catalog
def q_content_listing(spark, sf):
    c = S.content(spark, sf)
    return finalize(catalog.list_content(c, status="published", category="backend", limit=20, offset=0))


def q_content_listing_by_tag(spark, sf):
    c = S.content(spark, sf)
    tags, bridge = catalog.derive_tags(c)
    return finalize(catalog.list_content(c, tag="llm", tags=tags, bridge=bridge, limit=50, offset=10))


def q_content_tags(spark, sf):
    c = S.content(spark, sf)
    return catalog.tag_names(c)


def q_tag_listing(spark, sf):
    tags, _ = catalog.derive_tags(S.content(spark, sf))
    return catalog.list_tags(tags, limit=100, offset=0)


def q_user_validation(spark, sf):
    """V10 on an intake batch built from the raw customer names."""
    acc = S.user_accounts(spark, sf).select("user_id", F.col("display_name").alias("username"), "email")
    v = validate.users(acc)
    return v.select("user_id", "username", "email", F.array_join("errors", ";").alias("errors"))


def q_user_listing(spark, sf):
    """Newest users first with the nested profile (J2: may be missing)."""
    pm = S.profile_maps(spark, sf)
    page = catalog.list_users(S.user_accounts(spark, sf), pm, limit=100, offset=0)
    return finalize(page.select(
        "user_id", "username", "created_at",
        F.col("profile").isNotNull().alias("has_profile"),
        F.when(F.col("profile").isNull(), F.lit(0)).otherwise(F.size(F.col("profile.topic_preferences"))).alias("n_preferences"),
    ))


def q_content_lookup(spark, sf):
    """C4: catalog rows for the key set of items clicked in the last day."""
    it = _it(spark, sf)
    keys = it.filter((F.col("event_type") == "click") & feat.in_window("event_timestamp", AS_OF, 24)).select("content_id")
    return finalize(catalog.lookup(S.content(spark, sf), keys, ["content_id"]))


def _catalog_changes(content: DataFrame) -> DataFrame:
    pk = F.col("content_id")
    fields = F.array_compact(F.array(
        F.when((pk % 16 == 0) | (pk % 10 == 1), F.lit("status")),
        F.when(pk % 25 == 3, F.lit("title")),
    ))
    return content.select(
        "content_id",
        fields.alias("fields"),
        F.when(pk % 16 == 0, F.lit("published")).when(pk % 10 == 1, F.lit("draft")).alias("status"),
        F.upper("title").alias("title"),
    ).filter(F.size("fields") > 0)


def q_catalog_after_patches(spark, sf):
    """C6 + C7: partial updates (publish some drafts, unpublish some items,
    retitle others); publication sets / clears ``published_at``."""
    c = S.content(spark, sf)
    out = catalog.apply_patches(c, _catalog_changes(c), "content_id", ["status", "title"], AS_OF)
    return finalize(out.select("content_id", "title", "status", "published_at"))


def q_catalog_after_purge(spark, sf):
    """C8 + C9: purge a subject set given by key (id % 97 == 0) and by
    alternative key only (titles of id % 89 == 0), then cascade to the tag
    bridge."""
    c = S.content(spark, sf)
    by_key = c.filter(F.col("content_id") % 97 == 0).select("content_id", F.lit(None).cast("string").alias("title"))
    by_title = c.filter(F.col("content_id") % 89 == 0).select(F.lit(None).cast("long").alias("content_id"), "title")
    left = catalog.purge_subjects(c, by_key.unionByName(by_title), {"title": "title"}, "content_id")
    _, bridge = catalog.derive_tags(c)
    kept_bridge = bridge.join(left.select("content_id"), "content_id", "left_semi")
    tags = kept_bridge.groupBy("content_id").agg(F.count("*").alias("n_tags"))
    return left.join(tags, "content_id", "left").select("content_id", "title", F.coalesce("n_tags", F.lit(0)).alias("n_tags"))


def q_content_with_tags(spark, sf):
    """Every item with its tags nested (sorted by name)."""
    c = S.content(spark, sf)
    tags, bridge = catalog.derive_tags(c)
    nested = catalog.content_with_tags(c.select("content_id"), tags, bridge)
    return nested.select(
        "content_id", F.size("tags").alias("n_tags"),
        F.array_join(F.transform("tags", lambda t: t["name"]), ",").alias("tag_names"),
    )


def q_assignment_get_or_create(spark, sf):
    """J14 + E3: users with id % 3 == 0 already hold a stored assignment
    (made under an earlier configuration: trending_boost); the stored row
    wins, all other users get the hash assignment now."""
    variants = experiments.variants_table(spark)
    users = S.users(spark, sf)
    stored = users.filter(F.col("user_id") % 3 == 0).select(
        "user_id",
        F.lit(C.EXPERIMENT_KEY).alias("experiment_key"),
        F.lit(-1).alias("assignment_bucket"),
        F.lit("trending_boost").alias("variant_key"),
        F.lit(C.RULES_V2).alias("strategy_name"),
        F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("assigned_at"),
    )
    everyone, _ = experiments.get_or_create(stored, users, variants, AS_OF)
    return finalize(everyone)


def q_consumer_lag(spark, sf):
    """Per partition of the interaction topic (key = user id, 4
    partitions), the lag of a consumer committed up to 2024-01-30 00:00."""
    ev = S.table(spark, sf, "events", ["user_id", "ts"])
    offs = ev.groupBy((F.col("user_id") % 4).cast("int").alias("partition")).agg(
        F.count("*").alias("end_offset"),
        F.count_if(F.col("ts") <= F.to_timestamp(F.lit("2024-01-30 00:00:00")).cast("timestamp_ntz")).alias("current_offset"),
    ).select(F.lit("interactions.events.v1").alias("topic"), "partition", "end_offset", "current_offset", F.lit(0).cast("long").alias("low_offset"))
    return ops.lag(offs)


def q_service_availability(spark, sf):
    """Services whose latest heartbeat (last logged operation) is at
    most 5 minutes old at ``as_of``."""
    hb = S.operations_log(spark, sf).select("ts", "service")
    return finalize(ops.availability(hb, AS_OF, 300))


# ------------------------------------------------------------------ insights
def q_observed_affinity(spark, sf):
    return insights.observed_affinity(_ranked(spark, sf))


def q_trending_rows(spark, sf):
    return insights.trending_rows(_ranked(spark, sf))


def q_category_distribution(spark, sf):
    return insights.category_distribution(S.content(spark, sf))


def q_feed_summary(spark, sf):
    return insights.feed_summary(_ranked(spark, sf))


def q_session_event_types(spark, sf):
    return insights.event_type_distribution(_it(spark, sf))


def q_page_topic_mix(spark, sf):
    return insights.topic_mix(_ranked(spark, sf))


def q_page_source_mix(spark, sf):
    return insights.source_mix(_ranked(spark, sf))


def q_score_bands(spark, sf):
    return insights.score_bands(_ranked(spark, sf))


def q_engagement_percent(spark, sf):
    return insights.engagement_percent(insights.page_items(_ranked(spark, sf)))


def q_score_breakdown_long(spark, sf):
    return insights.breakdown_long(_ranked(spark, sf))


def q_action_state(spark, sf):
    return insights.action_state(_it(spark, sf))


def q_page_without_dismissed(spark, sf):
    return insights.exclude_dismissed(_ranked(spark, sf), _it(spark, sf))


def q_recent_session_events(spark, sf):
    return finalize(insights.recent_events(_it(spark, sf), 10))


# ----------------------------------------------------------------------- ops
def q_event_rate_5m(spark, sf):
    return finalize(ops.rate(S.operations_log(spark, sf), ["service", "topic", "outcome"], "5 minutes"))


def q_event_rate_5m_sliding(spark, sf):
    """O1 with a 1-minute slide: each event falls into five windows."""
    return finalize(ops.rate(S.operations_log(spark, sf), ["service", "outcome"], "5 minutes", "1 minute"))


def q_event_increase_15m(spark, sf):
    return finalize(ops.increase(S.operations_log(spark, sf), ["outcome"], "15 minutes"))


def q_latency_p95(spark, sf):
    return ops.p95(S.operations_log(spark, sf), ["service", "outcome"])


def q_latency_histogram_p95(spark, sf):
    return ops.histogram_quantile(ops.latency_buckets(S.operations_log(spark, sf), ["service"]), ["service"], 0.95)


def q_processor_freshness(spark, sf):
    v = validate.interactions(_dirty(spark, sf))
    return finalize(ops.freshness(v))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "content_features": q_content_features,
    "content_features_30d": q_content_features_30d,
    "content_feature_validation": q_content_feature_validation,
    "content_features_strict": q_content_features_strict,
    "user_topic_affinity": q_user_topic_affinity,
    "user_topic_affinity_30d": q_user_topic_affinity_30d,
    "point_in_time_features": q_point_in_time_features,
    "daily_snapshot_as_of": q_daily_snapshot_as_of,
    "experiment_assignments": q_experiment_assignments,
    "exposure_items": q_exposure_items,
    "attributed_outcomes": q_attributed_outcomes,
    "experiment_comparison": q_experiment_comparison,
    "experiment_comparison_7d": q_experiment_comparison_7d,
    "best_strategy": q_best_strategy,
    "effective_affinity": q_effective_affinity,
    "candidate_pool": q_candidate_pool,
    "feed_candidates": q_feed_candidates,
    "scored_candidates": q_scored_candidates,
    "ranked_feed": q_ranked_feed,
    "ranked_feed_no_diversity": q_ranked_feed_no_diversity,
    "ranked_feed_general": q_ranked_feed_general,
    "feed_pages": q_feed_pages,
    "feed_pages_second": q_feed_pages_second,
    "ranking_decisions": q_ranking_decisions,
    "feed_exposure_items": q_feed_exposure_items,
    "feed_exposure_headers": q_feed_exposure_headers,
    "exposure_validation": q_exposure_validation,
    "interaction_validation": q_interaction_validation,
    "dead_letters": q_dead_letters,
    "deduplicated_interactions": q_deduplicated_interactions,
    "stream_replay_features": q_stream_replay_features,
    "stream_dirty_features": q_stream_dirty_features,
    "stream_dead_letters": q_stream_dead_letters,
    "stream_audit": q_stream_audit,
    "stream_flushes": q_stream_flushes,
    "stream_continuous_features": q_stream_continuous_features,
    "stream_moving_window": q_stream_moving_window,
    "versioned_features": q_versioned_features,
    "idempotent_counts": q_idempotent_counts,
    "duplicate_event_report": q_duplicate_event_report,
    "preference_validation": q_preference_validation,
    "affinity_validation": q_affinity_validation,
    "content_validation": q_content_validation,
    "tag_validation": q_tag_validation,
    "candidate_validation": q_candidate_validation,
    "publish_outbox": q_publish_outbox,
    "keyed_records": q_keyed_records,
    "affinity_map_read": q_affinity_map_read,
    "tag_resolution": q_tag_resolution,
    "content_intake": q_content_intake,
    "direct_attribution": q_direct_attribution,
    "feed_page_cache": q_feed_page_cache,
    "content_listing": q_content_listing,
    "content_listing_by_tag": q_content_listing_by_tag,
    "content_tags": q_content_tags,
    "tag_listing": q_tag_listing,
    "user_validation": q_user_validation,
    "user_listing": q_user_listing,
    "content_lookup": q_content_lookup,
    "catalog_after_patches": q_catalog_after_patches,
    "catalog_after_purge": q_catalog_after_purge,
    "content_with_tags": q_content_with_tags,
    "assignment_get_or_create": q_assignment_get_or_create,
    "observed_affinity": q_observed_affinity,
    "trending_rows": q_trending_rows,
    "category_distribution": q_category_distribution,
    "feed_summary": q_feed_summary,
    "session_event_types": q_session_event_types,
    "page_topic_mix": q_page_topic_mix,
    "page_source_mix": q_page_source_mix,
    "score_bands": q_score_bands,
    "score_breakdown_long": q_score_breakdown_long,
    "engagement_percent": q_engagement_percent,
    "action_state": q_action_state,
    "page_without_dismissed": q_page_without_dismissed,
    "recent_session_events": q_recent_session_events,
    "event_rate_5m": q_event_rate_5m,
    "event_rate_5m_sliding": q_event_rate_5m_sliding,
    "event_increase_15m": q_event_increase_15m,
    "latency_p95": q_latency_p95,
    "latency_histogram_p95": q_latency_histogram_p95,
    "processor_freshness": q_processor_freshness,
    "consumer_lag": q_consumer_lag,
    "service_availability": q_service_availability,
}


def _configured(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _configured(v) for k, v in QUERIES.items()}
