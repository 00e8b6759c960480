"""State of the stream: bad first batches, events ahead of their day, Bloom filters, slices, versioned tables, keyed state."""

import datetime as dt
import json
import os
import random
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from rankflow import sinks
from rankflow.operators import features as feat
from rankflow.sinks import id_index
from rankflow.sinks.versions import VersionedTable, compact, latest
from rankflow.sources import streams
from rankflow.streaming import continuous, features_job, slices

NOW = "2025-11-20 18:00:00"


def _id(i):
    return f"7a000000-0000-0000-0000-{i:012d}"


def _rec(i, event, content, hours_before, user=1, topic="devops", duration=0):
    ts = dt.datetime.fromisoformat(NOW) - dt.timedelta(hours=hours_before)
    return json.dumps({
        "schema_name": "interaction_event.v1", "event_id": _id(i), "event_type": event, "user_id": _id(user), "content_id": _id(content),
        "session_id": "s", "topic": topic, "watch_duration_seconds": duration, "event_timestamp": ts.strftime("%Y-%m-%dT%H:%M:%S.%f"),
    })


def _batch(spark, lines):
    return streams.parse_records(spark.createDataFrame([(x,) for x in lines], "value string"))


def _run(spark, root, batch_id, lines, t=NOW):
    features_job.process_batch(_batch(spark, lines), batch_id, root, 24, as_of=lambda _b: t)


def _latest(spark, root, **kwargs):
    return {r.content_id: r for r in sinks.read_latest(spark, os.path.join(root, "content_features_latest"), ["content_id"], **kwargs).collect()}


def test_a_batch_of_bad_records_only_does_not_stop_the_stream(spark):
    root = tempfile.mkdtemp(prefix="rankflow-bad-")
    _run(spark, root, 0, ["{broken"])
    _run(spark, root, 1, [_rec(1, "click", 1, 1)])
    _run(spark, root, 2, ["nothing", _rec(2, "click", 99, 1, topic="cooking")])
    _run(spark, root, 3, [_rec(3, "click", 1, 2), _rec(1, "click", 1, 3)])
    assert _latest(spark, root)[_id(1)].clicks == 2
    assert spark.read.parquet(os.path.join(root, "dead_letters")).count() == 3
    assert sorted(r.event_id for r in spark.read.parquet(os.path.join(root, "audit")).collect()) == [_id(1), _id(3)]
    assert not os.path.exists(os.path.join(root, "dead_letters_processing"))


def test_an_event_ahead_of_its_day_counts_when_the_day_comes(spark):
    root = tempfile.mkdtemp(prefix="rankflow-ahead-")

    def day(n):
        return (dt.datetime.fromisoformat(NOW) + dt.timedelta(days=n)).strftime("%Y-%m-%d %H:%M:%S")

    _run(spark, root, 0, [_rec(1, "click", 1, -71)])
    for n in (1, 2):
        _run(spark, root, n, [_rec(10 + n, "click", 2, -24 * n)], day(n))
    _run(spark, root, 3, [_rec(2, "click", 1, -71.5), _rec(3, "click", 1, -72)], day(3))
    assert _latest(spark, root)[_id(1)].clicks == 3
    events = features_job.current_events(spark, root, day(3), 24)
    assert events.filter(F.col("content_id") == _id(1)).count() == 3


def _brute(rows, t, hours):
    """Clicks per content and the newest event of the window, each id by its last arrival."""
    last = {i: r for i, *r in rows}
    hi = dt.datetime.fromisoformat(t)
    out = {}
    for content, ts in last.values():
        if hi - dt.timedelta(hours=hours) < ts <= hi:
            n, m = out.get(content, (0, ts))
            out[content] = (n + 1, max(m, ts))
    return out


@pytest.mark.parametrize("minutes", [0, 25])
def test_slices_follow_random_batches(spark, monkeypatch, minutes):
    """Ids that move between contents, hours and out of the window; whole and broken hours at the edges; folds on the way."""
    monkeypatch.setattr(slices, "PARTS", 2)
    monkeypatch.setattr(sinks, "LATEST_PARTS", 2)
    root = tempfile.mkdtemp(prefix="rankflow-slices-")
    rng = random.Random(minutes)
    start, rows = dt.datetime.fromisoformat(NOW), []
    for b in range(4):
        now = start + dt.timedelta(hours=3 * b, minutes=minutes)
        t = now.strftime("%Y-%m-%d %H:%M:%S")
        new = [(rng.randint(0, 25), rng.randint(1, 3), rng.choice([0.5, 1, 2, 5, 20, 23.9, 24, 30])) for _ in range(12)]
        lines = []
        for i, content, back in new:
            ts = now - dt.timedelta(hours=back)
            rows.append((i, _id(content), ts))
            lines.append(json.dumps(json.loads(_rec(i, "click", content, 0)) | {"event_timestamp": ts.strftime("%Y-%m-%dT%H:%M:%S.%f")}))
        _run(spark, root, b, lines, t)
        got = {k: (r.clicks, r.last_event_at) for k, r in _latest(spark, root, as_of=t, window_hours=24).items()}
        want = _brute(rows, t, 24)
        touched = {_id(c) for _, c, _ in new}
        assert {k: v for k, v in got.items() if k in touched} == {k: v for k, v in want.items() if k in touched}
        assert {r.content_id: r["count"] for r in features_job.current_events(spark, root, t, 24).groupBy("content_id").count().collect()} == {
            k: n for k, (n, _) in want.items()
        }
    # the same batch again changes nothing
    _run(spark, root, 3, lines, t)
    assert {k: (r.clicks, r.last_event_at) for k, r in _latest(spark, root, as_of=t, window_hours=24).items()} == got


def test_a_batch_reads_no_events_but_those_of_touched_slices(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="rankflow-reads-")
    asked = []
    between = features_job.events_between
    monkeypatch.setattr(features_job, "events_between", lambda s, r, lo, hi: (asked.append((lo, hi)), between(s, r, lo, hi))[1])
    for b in range(2):
        _run(spark, root, b, [_rec(100 * b + i, "click", 1, 2 * i) for i in range(6)])
    assert asked == [] and _latest(spark, root)[_id(1)].clicks == 12
    # a copy that is taken out: its slice, and the hours beside it
    _run(spark, root, 2, [_rec(3, "click", 1, 1)])
    assert {(lo[:19], hi[:19]) for lo, hi in asked} == {("2025-11-20 11:00:00", "2025-11-20 13:00:00")}
    assert _latest(spark, root)[_id(1)].clicks == 12


def test_filters_name_the_batches_to_open(spark):
    path = tempfile.mkdtemp(prefix="rankflow-bloom-")
    for b in range(6):
        ids = spark.range(2000 * b, 2000 * (b + 1) - (1990 if b == 5 else 0)).select(F.concat(F.lit("e"), "id").alias("event_id"))
        sinks.append_filter(id_index.blooms(ids, "event_id", ids.count()), path, b)
    filters = sinks.stored(spark, path, id_index.SCHEMA)
    ask = lambda ids: id_index.may_hold(spark.createDataFrame([(x,) for x in ids], "event_id string"), "event_id", filters)
    assert ask(["e1", "e3", "e10003"]) == [0, 5] and ask(["e7999"]) == [3]
    assert ask([f"new{i}" for i in range(500)]) == [] and ask([]) == []
    # no id that is stored is missed
    every = spark.range(10_010).select(F.concat(F.lit("e"), "id").alias("event_id"))
    assert id_index.may_hold(every, "event_id", filters) == list(range(6))
    assert id_index.may_hold(every, "event_id", filters.limit(0)) == []


def test_only_named_batches_are_opened(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="rankflow-open-")
    named = []
    may_hold = id_index.may_hold
    monkeypatch.setattr(id_index, "may_hold", lambda *a: named.append(may_hold(*a)) or named[-1])
    for b in range(4):
        _run(spark, root, b, [_rec(10 * b + i, "click", 1, 1) for i in range(3)])
    _run(spark, root, 4, [_rec(21, "click", 1, 2), _rec(99, "click", 1, 2)])
    assert named == [[], [], [], [], [2]]
    audit = spark.read.parquet(os.path.join(root, "audit")).filter(F.col("batch_id").isin(named[-1]))
    files = {r.f for r in audit.select(F.input_file_name().alias("f")).distinct().collect()}
    assert files and all("batch_id=2/" in f for f in files)


def test_versions_are_swapped_in_one_step(spark):
    path = tempfile.mkdtemp(prefix="rankflow-versions-")
    table = VersionedTable(spark, path)
    assert table.version() == 0 and table.read() is None
    frame = lambda rows: spark.createDataFrame(rows, "k int, v int, version int")
    table.append(frame([(1, 1, 0), (2, 1, 0)]), 0)
    table.append(frame([(2, 2, 1)]), 1)
    # rows of a writer that dies before it publishes are never seen
    table.write_part(frame([(9, 9, 2)]), 2)
    pinned = table.version()
    table.append(frame([(2, 3, 1), (3, 1, 1)]), 1)
    read = lambda v=None: sorted((r.k, r.v) for r in latest(table.read(v), ["k"], "v").collect())
    assert read(pinned) == [(1, 1), (2, 2)] and read() == [(1, 1), (2, 3), (3, 1)]
    open_reader = table.read()
    compact(table, lambda df: latest(df, ["k"], "v"))
    assert len(table.manifest()["parts"]) == 1 and read() == [(1, 1), (2, 3), (3, 1)]
    assert open_reader.count() == 4
    # a part that came during a fold stays
    old = [p["name"] for p in table.manifest()["parts"]]
    table.append(frame([(4, 1, 2)]), 2)
    table.replace(old, frame([(1, 1, 1), (2, 3, 1), (3, 1, 1)]), 1)
    assert read() == [(1, 1), (2, 3), (3, 1), (4, 1)]
    gone = table.vacuum(keep=1)
    assert gone and read() == [(1, 1), (2, 3), (3, 1), (4, 1)] and len(table.versions()) == 1
    # a second writer of the same number starts again
    class Late(VersionedTable):
        seen = 0

        def version(self):
            Late.seen += 1
            return super().version() - (1 if Late.seen == 1 else 0)

    first = VersionedTable(spark, path)
    first.append(frame([(5, 1, 3)]), 3)
    Late(spark, path).append(frame([(6, 1, 4)]), 4)
    assert [k for k, _ in read()] == [1, 2, 3, 4, 5, 6]


def test_empty_parts_keep_their_schema(spark):
    table = VersionedTable(spark, tempfile.mkdtemp(prefix="rankflow-empty-"))
    table.append(spark.createDataFrame([], "k int, version int"), 0)
    assert table.read().columns == ["k", "version"] and table.read().count() == 0


def test_slice_keeps_the_latest_times():
    s = continuous.Slice()
    for us in range(200):
        s.change(0, us, 1)
    assert s.counts[0] == 200 and len(s.times) == continuous.LAST and not s.complete and max(s.times) == 199
    for us in range(199, 199 - continuous.LAST, -1):
        s.change(0, us, -1)
    assert s.counts[0] == 200 - continuous.LAST and not s.exact
    again = continuous.Slice(*continuous.Slice(*s.state()).state())
    assert (again.counts, again.complete, again.exact) == (s.counts, False, False)
    small = continuous.Slice()
    for us, sign in ((5, 1), (9, 1), (9, -1), (9, 1), (9, -1)):
        small.change(1, us, sign)
    assert small.exact and max(small.times) == 5 and small.counts[1] == 1


def test_keyed_state_equals_batch_and_survives_a_restart(spark):
    root = tempfile.mkdtemp(prefix="rankflow-keyed-")
    rng = random.Random(9)
    now = dt.datetime.fromisoformat(NOW)
    schema = "event_id string, seq long, content_id string, topic string, event_type string, event_timestamp timestamp"
    rows, seq = [], 0
    kinds = ["impression", "click", "like", "skip"]

    def write(n):
        nonlocal seq
        part = []
        for _ in range(n):
            seq += 1
            back = dt.timedelta(minutes=rng.choice([0, 1, 30, 600, 1439, 1440, 1500]), microseconds=rng.choice([0, 1, 999_999]))
            part.append((f"e{rng.randint(0, 30)}", seq, f"c{rng.randint(0, 3)}", rng.choice(["ai", "devops", None]), rng.choice(kinds), now - back))
        rows.extend(part)
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")

    def drain():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        continuous.configure(spark)
        continuous.drain(continuous.vectors(continuous.changes(stream, 24), 24, NOW), f"{root}/out", f"{root}/ckpt", NOW)

    write(30)
    drain()
    write(20)
    drain()  # a new run of the query goes on from its state
    valid = spark.createDataFrame(rows, schema)
    want = feat.content_features(feat.dedupe_events(valid, "seq"), NOW, 24)
    cols = ["content_id", "topic", "impressions", "clicks", "likes", "skip_count", "trending_score", "last_event_at"]
    got = sinks.read_latest(spark, f"{root}/out", ["content_id"], as_of=NOW, window_hours=24)
    assert got.filter("last_exact").count() == got.count()
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_progress_reports_are_kept(spark):
    root = tempfile.mkdtemp(prefix="rankflow-progress-")
    os.makedirs(f"{root}/in")
    for name in ("a", "b"):
        with open(f"{root}/in/{name}.json", "w") as fh:
            fh.write(_rec(ord(name), "click", 1, 1) + "\n{broken\n")
    table = features_job.ProgressTable(spark, f"{root}/progress")
    spark.streams.addListener(table)
    try:
        stream = streams.read_interactions(spark, source="json", path=f"{root}/in", max_records_per_trigger=1)
        q = features_job.start(stream, f"{root}/out", 24, as_of=lambda _b: NOW, trigger={"availableNow": True}, checkpoint=f"{root}/ckpt", query_name=None)
        q.awaitTermination(120)
        # reports come on a thread of their own
        for _ in range(300):
            if os.path.isdir(f"{root}/progress") and len([n for n in os.listdir(f"{root}/progress") if n.endswith(".json")]) >= 2:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(table)
    progress = spark.read.option("wholetext", True).text(f"{root}/progress").select(F.from_json("value", "batchId long, numInputRows long").alias("p")).select("p.*")
    assert sorted((r.batchId, r.numInputRows) for r in progress.collect()) == [(0, 2), (1, 2)]
    flushes = sinks.stored(spark, f"{root}/out/flushes", sinks.FLUSH_SCHEMA)
    assert sorted((r.batch_id, r.processed, r.failed, r.content_keys) for r in flushes.collect()) == [(0, 1, 1, 1), (1, 1, 1, 1)]
