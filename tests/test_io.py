"""Sinks, readers and the remaining operators on literal frames."""

import datetime as dt
import json
import tempfile


from rankflow import constants as C
from rankflow import sinks
from rankflow.operators import attribution as attr
from rankflow.operators import catalog, experiments, feed, ingest, insights, ops, scoring, validate
from rankflow.sources import streams
from pyspark.sql import functions as F

T0 = dt.datetime(2025, 11, 19, 12)


def test_keyed_json_sorted_and_headers(spark):
    df = spark.createDataFrame([("u1", "click", 3)], "user_id string, event_type string, n int")
    r = sinks.to_keyed_json(df, "user_id", {"schema": "interaction_event.v1"}).first()
    assert r.key == "u1"
    assert list(json.loads(r.value)) == ["event_type", "n", "user_id"]  # key-sorted, compact
    assert r.headers[0].key == "schema" and bytes(r.headers[0].value) == b"interaction_event.v1"


def test_feed_page_cache_roundtrip(spark):
    path = tempfile.mkdtemp(prefix="rankflow-pages-")
    pages = spark.createDataFrame([("u1", 20, 0, 5), ("u2", 20, 0, 0)], "user_id string, feed_limit int, feed_offset int, total_candidates long")
    feed.write_feed_pages(pages, path, "2025-11-19 12:00:00")
    feed.write_feed_pages(pages.filter("user_id = 'u1'"), path, "2025-11-19 12:00:30")
    fresh = feed.read_feed_pages(spark, path, "2025-11-19 12:00:45").collect()
    assert {(r.user_id, r.generated_at) for r in fresh} == {("u1", dt.datetime(2025, 11, 19, 12, 0, 30)), ("u2", dt.datetime(2025, 11, 19, 12))}
    assert feed.read_feed_pages(spark, path, "2025-11-19 12:02:00").count() == 0  # 60 s lifetime


def test_latest_tables_and_affinity_map(spark):
    path = tempfile.mkdtemp(prefix="rankflow-latest-")
    a = spark.createDataFrame([("u1", "ai", 2.0, T0), ("u1", "devops", None, T0)], "user_id string, topic string, affinity_score double, updated_at timestamp")
    b = spark.createDataFrame([("u1", "ai", 5.0, T0 + dt.timedelta(hours=1))], "user_id string, topic string, affinity_score double, updated_at timestamp")
    sinks.upsert_latest(a, path, 0)
    sinks.upsert_latest(b, path, 1)
    sinks.upsert_latest(b, path, 1)  # replayed batch: same version rewritten
    latest = sinks.read_latest(spark, path, ["user_id", "topic"])
    assert latest.count() == 2
    assert sinks.read_affinity_map(latest).first().topic_affinity == {"ai": 5.0}
    items = spark.createDataFrame([("c1", "ai"), ("c2", "backend")], "content_id string, topic string")
    feats = spark.createDataFrame([("c1", *[1] * 7, 0.5, 0.5, 0.5, 0.1, 0.5, 3.0, T0)],
                                  "content_id string, " + ", ".join(f"{m} long" for m in C.METRICS)
                                  + ", ctr double, like_rate double, save_rate double, skip_rate double, completion_rate double, trending_score double, last_event_at timestamp")
    got = {r.content_id: r for r in sinks.read_content_features(feats, items).collect()}
    assert got["c2"].trending_score == 0.0 and got["c2"].clicks == 0 and got["c2"].topic == "backend"


def test_audit_replay_and_pending_publish(spark):
    payload = json.dumps({"event_id": "e1", "event_type": "click", "user_id": "u", "content_id": "c", "topic": "ai",
                          "watch_duration_seconds": 0, "event_timestamp": "2025-11-19T12:00:00"})
    audit = spark.createDataFrame([("e1", payload, None), ("e2", payload, T0)], "event_id string, event_payload string, published_at timestamp")
    assert streams.replay_audit(audit).first().event_type == "click"
    pend = ingest.pending_publish(audit)
    assert [r.event_id for r in pend.collect()] == ["e1"]
    marked = ingest.mark_published(audit, pend, "2025-11-19 13:00:00")
    assert ingest.pending_publish(marked).count() == 0


def test_tags_nested_and_resolution(spark):
    tags = spark.createDataFrame([("t1", "ai", None), ("t2", "llm", None)], "tag_id string, name string, description string")
    bridge = spark.createDataFrame([(1, "t2"), (1, "t1")], "content_id long, tag_id string")
    content = spark.createDataFrame([(1,), (2,)], "content_id long")
    nested = {r.content_id: [t.name for t in r.tags] for r in catalog.content_with_tags(content, tags, bridge).collect()}
    assert nested == {1: ["ai", "llm"], 2: []}
    req = spark.createDataFrame([("r1", ["t2", "zz", "t2", "t1"])], "request_id string, tag_ids array<string>")
    r = catalog.resolve_tag_ids(req, tags).first()
    assert [t.tag_id for t in r.tags] == ["t2", "t1"] and r.unknown_tag_ids == ["zz"]
    v = validate.tags(spark.createDataFrame([("  LLM ", None), ("", None)], "name string, description string")).collect()
    assert v[0].name == "llm" and v[0].errors == [] and v[1].errors == ["name_length"]


def test_users_listing_and_bulk_content(spark):
    users = spark.createDataFrame([("u1", T0), ("u2", T0 + dt.timedelta(hours=1))], "user_id string, created_at timestamp")
    profiles = spark.createDataFrame([("u1", "bio")], "user_id string, bio string")
    listed = catalog.list_users(users, profiles).collect()
    assert [r.user_id for r in listed] == ["u2", "u1"] and listed[0].profile is None
    existing = spark.createDataFrame([(1, "Existing title", "ai", "ai", "published")], "content_id long, title string, topic string, category string, status string")
    new = spark.createDataFrame([(2, " New item ", " Backend ", "backend", None, None), (3, "bad", "x", "cooking", None, None)],
                                "content_id long, title string, topic string, category string, status string, description string")
    table, rejected = catalog.append_content(existing, new, "2025-11-19 12:00:00")
    rows = {r.content_id: r for r in table.collect()}
    assert rows[2].status == "draft" and rows[2].topic == "backend" and rows[2].title == "New item"
    assert [r.content_id for r in rejected.collect()] == [3]


def test_assignment_get_or_create_and_exposures(spark):
    variants = experiments.variants_table(spark)
    stored = spark.createDataFrame([(C.EXPERIMENT_KEY, "u1", 1, "trending_boost", C.RULES_V2, T0)],
                                   "experiment_key string, user_id string, assignment_bucket int, variant_key string, strategy_name string, assigned_at timestamp")
    users = spark.createDataFrame([("u1",), ("u2",)], "user_id string")
    allr, fresh = experiments.get_or_create(stored, users, variants, "2025-11-19 13:00:00")
    got = {r.user_id: r for r in allr.collect()}
    assert got["u1"].variant_key == "trending_boost"  # stored wins
    assert [r.user_id for r in fresh.collect()] == ["u2"]
    item = "struct<rank:int,content_id:string,topic:string,category:string,score:double>"
    pages = spark.createDataFrame(
        [("x1", C.EXPERIMENT_KEY, "control", C.RULES_V1, "u2", 20, 0, T0, [(1, "c1", "ai", "ai", 0.5), (1, "c1", "ai", "cooking", 0.4)]),
         ("x2", C.EXPERIMENT_KEY, "control", C.RULES_V1, "u9", 20, 0, T0, [])],
        f"exposure_id string, experiment_key string, variant_key string, strategy_name string, user_id string, feed_limit int, feed_offset int, generated_at timestamp, items array<{item}>",
    )
    header, items = experiments.exposures_from_pages(pages)
    assert header.count() == 2 and items.count() == 2  # empty page keeps its header
    errs = {r.exposure_id: r.errors for r in experiments.validate_exposures(header, items, allr).collect()}
    want_u2 = [] if got["u2"].variant_key == "control" else ["variant_mismatch", "strategy_mismatch"]
    assert errs["x1"] == ["item_category_unknown", "duplicate_item"] + want_u2
    assert errs["x2"] == ["assignment_missing"]
    nested = {r.exposure_id: r.errors for r in experiments.validate_pages(pages, allr).collect()}
    assert nested == errs


def test_direct_attribution(spark):
    outcomes = spark.createDataFrame([("e1", "c1", '{"feed_exposure_id": "x1"}'), ("e2", "c2", "{}")], "event_id string, content_id string, metadata string")
    items = spark.createDataFrame([("x1", "c1", "i1")], "exposure_id string, content_id string, item_id string")
    assert [r.item_id for r in attr.attribute_direct(outcomes, items).collect()] == ["i1"]


def test_candidate_validation_and_engagement_percent(spark):
    c = spark.createDataFrame([("u", "c", "", "ai", 1.5, ["recent", "trending", "recent"])],
                              "user_id string, content_id string, title string, topic string, user_topic_affinity double, candidate_sources array<string>")
    r = scoring.validate_candidates(c).first()
    assert r.candidate_sources == ["recent", "trending"] and r.errors == ["title_length", "affinity_out_of_range"]
    ranked = spark.createDataFrame([("u", "c", 0.25, 0.5, 0.1, 0.75, 0.04)], "user_id string, content_id string, ctr double, like_rate double, save_rate double, completion_rate double, skip_rate double")
    p = insights.engagement_percent(ranked).first()
    assert (p.ctr_percent, p.completion_rate_percent) == (25.0, 75.0)


def test_lag_and_availability(spark):
    offs = spark.createDataFrame([("t", 0, 100, 90, 0), ("t", 1, 50, None, 10), ("t", 2, 5, 9, 0)],
                                 "topic string, partition int, end_offset long, current_offset long, low_offset long")
    assert {r.partition: r.lag for r in ops.lag(offs).collect()} == {0: 10, 1: 40, 2: 0}
    prog = spark.createDataFrame([(json.dumps({"sources": [{"description": "kafka", "endOffset": json.dumps({"t": {"0": 7}}),
                                                             "latestOffset": json.dumps({"t": {"0": 10, "1": 3}})}]}),)], "json string")
    assert {r.partition: r.lag for r in ops.lag_from_progress(prog).collect()} == {"0": 3, "1": 3}
    hb = spark.createDataFrame([("feed", T0), ("ranking", T0 - dt.timedelta(minutes=5))], "service string, ts timestamp")
    up = {r.service: r.up for r in ops.availability(hb, "2025-11-19 12:00:30").collect()}
    assert up == {"feed": True, "ranking": False}


def test_empty_page_for_users_without_candidates(spark):
    item = "struct<user_topic_affinity:double,ctr:double>"
    ranked = spark.createDataFrame(
        [("u1", C.EXPERIMENT_KEY, "control", C.RULES_V1, f"c{i}", i, 1.0 - i / 100) for i in range(1, 26)],
        "user_id string, experiment_key string, variant_key string, strategy_name string, content_id string, rank int, score double",
    )
    for c in ("title", "topic", "category"):
        ranked = ranked.withColumn(c, F.lit("ai"))
    ranked = (
        ranked.withColumn("published_at", F.lit(None).cast("timestamp"))
        .withColumn("candidate_sources", F.array(F.lit("recent")))
        .withColumn("user_topic_affinity", F.lit(0.5))
        .withColumn("score_breakdown", F.struct(F.lit(1.0).alias("final_score")))
        .withColumn("content_features", F.struct(F.lit(0.1).alias("ctr")))
    )
    users = spark.createDataFrame([("u1",), ("u2",)], "user_id string")
    first = {r.user_id: r for r in feed.page(ranked, users, 20, 0).collect()}
    assert first["u1"].total_candidates == 25 and first["u1"].has_more and [i.rank for i in first["u1"].items] == list(range(1, 21))
    assert first["u2"].total_candidates == 0 and not first["u2"].has_more and first["u2"].items == []
    second = {r.user_id: r for r in feed.page(ranked, users, 20, 20).collect()}
    assert [i.rank for i in second["u1"].items] == [21, 22, 23, 24, 25] and not second["u1"].has_more
