"""Streaming job: file source drained with availableNow, compared with the
batch operators on the same events (replays, re-sent ids, poison records)."""

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from rankflow import sinks
from rankflow.operators import features as feat
from rankflow.operators import validate
from rankflow.sources import streams
from rankflow.streaming import features_job

AS_OF = "2025-11-19 14:00:00"
U = "a7c00000-1111-4222-8333-0000000000%02d"
CID = "c0de0000-1111-4222-8333-0000000000%02d"
EID = "e7e70000-1111-4222-8333-0000000%05d"


def _rec(i, et, user, content, topic, minutes_before, duration=0):
    ts = dt.datetime(2025, 11, 19, 14) - dt.timedelta(minutes=minutes_before)
    return json.dumps({
        "schema_name": "interaction_event.v1", "event_id": EID % i, "event_type": et, "user_id": U % user,
        "content_id": CID % content, "session_id": f"s{user}", "topic": topic, "watch_duration_seconds": duration,
        "event_timestamp": ts.strftime("%Y-%m-%dT%H:%M:%S"), "metadata": {},
    })


def test_stream_matches_batch_and_routes_poison(spark):
    root = tempfile.mkdtemp(prefix="rankflow-stream-")
    src = os.path.join(root, "in")
    os.makedirs(src)
    first = [_rec(i, et, i % 3, i % 4, ["ai", "backend"][i % 2], 10 * i) for i, et in enumerate(
        ["impression", "click", "like", "save", "skip", "watch_start", "watch_complete", "click", "impression", "click"])]
    first[6] = _rec(6, "watch_complete", 0, 2, "ai", 60, duration=120)
    second = [
        first[1],                                   # replay of an already counted event
        _rec(7, "click", 7 % 3, 7 % 4, "backend", 5),  # event 7 re-sent with a newer time
        _rec(20, "watch_complete", 1, 1, "ai", 3),  # invalid: no duration
        "{not json",                                # malformed
        _rec(21, "impression", 2, 3, "  AI ", 30 * 60),  # outside the 24 h window
    ]
    for name, lines in (("a.json", first), ("b.json", second)):
        with open(os.path.join(src, name), "w") as fh:
            fh.write("\n".join(lines) + "\n")
    out = os.path.join(root, "out")
    stream = streams.read_interactions(spark, source="json", path=src, max_records_per_trigger=1)
    q = features_job.start(stream, out, 24, as_of=lambda _b: AS_OF, trigger={"availableNow": True},
                           checkpoint=os.path.join(root, "ckpt"))
    q.awaitTermination(180)
    assert q.exception() is None
    metrics = [p["observedMetrics"]["interaction_stream"] for p in q.recentProgress if p.get("observedMetrics")]
    assert sum(m["records"] for m in metrics) == len(first) + len(second)
    assert sum(m["unparsed"] for m in metrics) == 1

    dead = spark.read.parquet(os.path.join(out, "dead_letters")).collect()
    assert sorted(r.error_message for r in dead) == ["malformed_record", "watch_complete_without_duration"]

    latest = {r.content_id: r for r in sinks.read_latest(spark, os.path.join(out, "content_features_latest"), ["content_id"]).collect()}
    # batch reference on the valid, de-duplicated events (last arrival wins)
    parsed = [json.loads(x) for x in first + [second[1], second[4]]]
    rows = {p["event_id"]: p for p in parsed}  # later arrival overwrites
    ev = spark.createDataFrame(
        [(p["event_id"], p["event_type"], p["user_id"], p["content_id"], p["topic"].strip().lower(),
          dt.datetime.strptime(p["event_timestamp"], "%Y-%m-%dT%H:%M:%S")) for p in rows.values()],
        "event_id string, event_type string, user_id string, content_id string, topic string, event_timestamp timestamp",
    )
    expect = {r.content_id: r for r in feat.content_features(ev, AS_OF, 24).collect()}
    assert set(latest) == set(expect)
    for k, e in expect.items():
        g = latest[k]
        assert (g.impressions, g.clicks, g.likes, g.saves, g.skip_count, g.watch_starts, g.watch_completes) == (
            e.impressions, e.clicks, e.likes, e.saves, e.skip_count, e.watch_starts, e.watch_completes)
        assert g.trending_score == e.trending_score and g.last_event_at == e.last_event_at

    snaps = spark.read.parquet(os.path.join(out, "content_feature_snapshots"))
    assert snaps.select("batch_id").distinct().count() == 2
    aff = sinks.read_latest(spark, os.path.join(out, "user_topic_affinity_latest"), ["user_id", "topic"])
    assert aff.filter(F.col("topic").isNull()).count() == 0 and aff.count() > 0


def test_restart_from_checkpoint_and_replayed_batch(spark):
    root = tempfile.mkdtemp(prefix="rankflow-restart-")
    src = os.path.join(root, "in")
    os.makedirs(src)
    ckpt = os.path.join(root, "ckpt")
    out = os.path.join(root, "out")

    def run():
        stream = streams.read_interactions(spark, source="json", path=src)
        q = features_job.start(stream, out, 24, as_of=lambda _b: AS_OF, trigger={"availableNow": True}, checkpoint=ckpt)
        q.awaitTermination(180)
        assert q.exception() is None

    with open(os.path.join(src, "1.json"), "w") as fh:
        fh.write("\n".join(_rec(i, "click", 1, 1, "ai", 10 + i) for i in range(3)) + "\n")
    run()
    with open(os.path.join(src, "2.json"), "w") as fh:
        fh.write("\n".join(_rec(i, "click", 1, 1, "ai", 10 + i) for i in range(2, 6)) + "\n")  # ids 2 replayed
    run()  # restart: only the new file is read
    latest = sinks.read_latest(spark, os.path.join(out, "content_features_latest"), ["content_id"]).collect()
    assert [r.clicks for r in latest] == [6]
    assert spark.read.parquet(os.path.join(out, "content_feature_snapshots")).select("batch_id").distinct().count() == 2

    # a batch re-run after a failure rewrites the same partitions
    batch = streams.parse_records(spark.read.text(os.path.join(src, "2.json")))
    features_job.process_batch(batch, 1, out, 24, as_of=lambda _b: AS_OF)
    again = sinks.read_latest(spark, os.path.join(out, "content_features_latest"), ["content_id"]).collect()
    assert [r.clicks for r in again] == [6]
    events = spark.read.parquet(os.path.join(out, "events"))
    assert events.filter("batch_id = 1").count() == 4


def test_late_event_adds_nothing_and_time_never_regresses(spark):
    root = tempfile.mkdtemp(prefix="rankflow-late-")
    src = os.path.join(root, "in")
    os.makedirs(src)
    out = os.path.join(root, "out")
    ckpt = os.path.join(root, "ckpt")

    def run():
        stream = streams.read_interactions(spark, source="json", path=src)
        q = features_job.start(stream, out, 24, as_of=lambda _b: AS_OF, trigger={"availableNow": True}, checkpoint=ckpt)
        q.awaitTermination(180)
        assert q.exception() is None

    with open(os.path.join(src, "1.json"), "w") as fh:
        fh.write("\n".join(_rec(i, "click", 1, 1, "ai", 30 + i) for i in range(3)) + "\n")
    run()
    with open(os.path.join(src, "2.json"), "w") as fh:  # 40 h late: outside the 24 h window
        fh.write(_rec(50, "click", 1, 1, "ai", 40 * 60) + "\n")
    run()
    latest = sinks.read_latest(spark, os.path.join(out, "content_features_latest"), ["content_id"]).collect()
    assert [r.clicks for r in latest] == [3]
    assert latest[0].last_event_at == dt.datetime(2025, 11, 19, 13, 30)


def _drain(spark, src, out, ckpt, as_of):
    stream = streams.read_interactions(spark, source="json", path=src, max_records_per_trigger=1)
    q = features_job.start(stream, out, 24, as_of=as_of, trigger={"availableNow": True}, checkpoint=ckpt, query_name=None)
    q.awaitTermination(180)
    assert q.exception() is None


def test_contract_of_records_ids_and_expiry(spark):
    root = tempfile.mkdtemp(prefix="rankflow-contract-")
    src, out, ckpt = (os.path.join(root, x) for x in ("in", "out", "ckpt"))
    os.makedirs(src)
    blank = json.loads(_rec(40, "click", 1, 1, "ai", 5))
    extra, text, none, long_topic = (dict(blank, event_id=EID % i) for i in (41, 42, 43, 44))
    extra["colour"] = "red"
    text["watch_duration_seconds"] = "abc"
    del none["event_timestamp"]
    long_topic["session_id"] = "s" * 250 + " " * 10
    first = [_rec(30, "click", 2, 2, "ai", 10), _rec(31, "like", 2, 2, "ai", 10), _rec(32, "click", 3, 3, "ai", 10)]
    with open(os.path.join(src, "1.json"), "w") as fh:
        fh.write("\n".join([*first, *map(json.dumps, (extra, text, long_topic))]) + "\n")
    _drain(spark, src, out, ckpt, lambda _b: AS_OF)
    # the id 30 comes again, with a time outside the window: it no longer counts
    with open(os.path.join(src, "2.json"), "w") as fh:
        fh.write(_rec(30, "click", 2, 2, "ai", 30 * 60) + "\n")
    _drain(spark, src, out, ckpt, lambda _b: AS_OF)

    dead = {r.event_id: r.error_message for r in spark.read.parquet(os.path.join(out, "dead_letters")).collect()}
    assert dead == {EID % 41: "unknown_fields", EID % 42: "watch_duration_seconds_invalid"}
    audit = spark.read.parquet(os.path.join(out, "audit"))
    assert sorted(r.event_id for r in audit.collect()) == sorted(EID % i for i in (30, 31, 32, 44))
    path = os.path.join(out, "content_features_latest")
    latest = {r.content_id: r for r in sinks.read_latest(spark, path, ["content_id"]).collect()}
    assert (latest[CID % 2].clicks, latest[CID % 2].likes, latest[CID % 3].clicks) == (0, 1, 1)

    # three days on: a touched key without events is emptied, an untouched one expires on reading,
    # and dates before the retention are dropped
    later = "2025-11-22 14:00:00"
    with open(os.path.join(src, "3.json"), "w") as fh:
        fh.write(_rec(50, "click", 2, 2, "ai", 10) + "\n")
    _drain(spark, src, out, ckpt, lambda _b: later)
    latest = {r.content_id: r for r in sinks.read_latest(spark, path, ["content_id"]).collect()}
    assert (latest[CID % 2].likes, latest[CID % 2].last_event_at) == (0, None)
    assert sinks.read_latest(spark, path, ["content_id"], as_of=later, window_hours=24).count() == 0
    assert not [d for d in os.listdir(os.path.join(out, "events")) if d.startswith("event_date=") and d < "event_date=2025-11-20"]


def test_missing_time_is_the_processing_time(spark):
    rec = json.loads(_rec(60, "click", 1, 1, "ai", 5))
    del rec["event_timestamp"]
    wrong = dict(rec, event_id=EID % 61, event_timestamp="yesterday")
    batch = streams.parse_records(spark.createDataFrame([(json.dumps(rec),), (json.dumps(wrong),)], "value string"))
    got = {r.event_id: r for r in validate.interactions(batch, now=AS_OF, raw_json_col="value").collect()}
    assert (got[EID % 60].errors, got[EID % 60].event_timestamp) == ([], dt.datetime(2025, 11, 19, 14))
    assert got[EID % 61].errors == ["event_timestamp_invalid"]


def test_dead_letters_carry_envelope_and_trace(spark):
    raw = spark.createDataFrame(
        [("k1", "{broken", "t", 3, 77, None, [("X-Request-Id", "r9"), ("x-correlation-id", "c9")])], streams.BROKER_RECORD
    )
    checked = streams.parse_records(raw).withColumn("errors", F.array(F.lit("malformed_record")))
    (d,) = validate.dead_letters(checked, "svc", AS_OF).collect()
    assert (d.source_key, d.source_partition, d.source_offset, d.request_id, d.correlation_id) == ("k1", 3, 77, "r9", "c9")


def test_failing_features_dead_letter_the_batch(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="rankflow-fail-")
    tries = []

    def broken(*args):
        tries.append(1)
        raise ValueError("no features today")

    monkeypatch.setattr(features_job, "_update_features", broken)
    batch = streams.parse_records(spark.createDataFrame([(_rec(70, "click", 1, 1, "ai", 5),)], "value string"))
    features_job.process_batch(batch, 0, root, 24, as_of=lambda _b: AS_OF)
    (d,) = spark.read.parquet(os.path.join(root, "dead_letters_processing")).collect()
    assert len(tries) == 3 and (d.event_id, d.attempts, d.error_type) == (EID % 70, 3, "processing_error")
