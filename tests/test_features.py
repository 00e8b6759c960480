"""Feature math: values worked out by hand and brute force."""

import datetime as dt

import pytest

from rankflow import constants as C
from rankflow.operators import features as feat

NOW = "2025-11-19 14:00:00"


def _events(spark, rows):
    """rows: (event_id, event_type, user_id, content_id, topic, ts)"""
    return spark.createDataFrame(
        rows, "event_id long, event_type string, user_id string, content_id string, topic string, event_timestamp timestamp"
    )


def _burst(counts, ts, user="u1", content="c1", topic="devops", start=0):
    rows, eid = [], start
    for et, n in counts.items():
        for _ in range(n):
            rows.append((eid, et, user, content, topic, ts))
            eid += 1
    return rows


def test_content_rates_and_trending_by_hand(spark):
    counts = {"impression": 80, "click": 32, "like": 8, "save": 4, "skip": 6, "watch_start": 20, "watch_complete": 5}
    now = dt.datetime(2025, 11, 19, 14, 0, 0)
    cf = feat.content_features(_events(spark, _burst(counts, now)), NOW, 24).first()
    assert (cf.ctr, cf.like_rate, cf.save_rate, cf.skip_rate, cf.completion_rate) == (
        32 / 80, 8 / 32, 4 / 32, 6 / 80, 5 / 20)
    # 8 + 32 + 24 + 16 - 15 + 15 + 17.5 by weight, 4 + 1.5 + 1 + 3 of bonus, no decay at age 0
    assert cf.trending_score == 97.5 + 9.5
    assert cf.impressions == 80 and cf.watch_completes == 5
    assert cf.topic == "devops" and cf.window_hours == 24


def test_old_bursts_trend_below_new_ones(spark):
    counts = {"impression": 6, "click": 5, "watch_start": 3, "watch_complete": 2}
    late = _burst(counts, dt.datetime(2025, 11, 19, 13, 40), content="late")
    early = _burst(counts, dt.datetime(2025, 11, 18, 18, 20), content="early", start=50)
    rows = {r.content_id: r.trending_score for r in feat.content_features(_events(spark, late + early), NOW, 24).collect()}
    assert rows["late"] > rows["early"] > 0


def test_window_is_left_open_right_closed(spark):
    now = dt.datetime(2025, 11, 19, 14, 0, 0)
    rows = [
        (1, "click", "u", "c", "ai", now - dt.timedelta(hours=24)),  # excluded: t - window
        (2, "click", "u", "c", "ai", now - dt.timedelta(hours=24) + dt.timedelta(microseconds=1)),
        (3, "click", "u", "c", "ai", now),  # included: t
        (4, "click", "u", "c", "ai", now + dt.timedelta(seconds=1)),  # future: excluded
    ]
    assert feat.content_features(_events(spark, rows), NOW, 24).first().clicks == 2


def test_affinity_by_hand_and_user_level_last_event(spark):
    now = dt.datetime(2025, 11, 19, 13, 0, 0)
    counts = {"impression": 5, "click": 4, "like": 2, "skip": 2, "watch_start": 4, "watch_complete": 1}
    rows = _burst(counts, now, topic="ai")
    rows.append((99, "click", "u1", "c9", "backend", now + dt.timedelta(minutes=30)))
    rows.append((98, "click", "u1", "c9", None, now + dt.timedelta(minutes=50)))  # no topic: skipped
    out = {r.topic: r for r in feat.user_topic_affinity(_events(spark, rows), NOW, 24).collect()}
    # 1 + 6 + 8 - 6 + 4 + 4.5 by weight, a quarter of the starts completed: 1.25
    assert out["ai"].affinity_score == 17.5 + 1.25
    assert set(out) == {"ai", "backend"}
    # last_event_at is per user across topics (null-topic events never touch it)
    assert out["ai"].last_event_at == out["backend"].last_event_at == now + dt.timedelta(minutes=30)


def test_idempotent_counting_and_resent_timestamp(spark):
    t0 = dt.datetime(2025, 11, 19, 12, 0, 0)
    rows = spark.createDataFrame(
        [
            (1, "click", "u", "c", "ai", t0, 0),
            (1, "click", "u", "c", "ai", t0, 1),  # replay: no double count
            (2, "click", "u", "c", "ai", t0, 2),
            (2, "click", "u", "c", "ai", t0 + dt.timedelta(minutes=5), 3),  # re-sent: newer time wins
        ],
        "event_id long, event_type string, user_id string, content_id string, topic string, event_timestamp timestamp, seq long",
    )
    dd = feat.dedupe_events(rows, arrival="seq")
    cf = feat.content_features(dd, NOW, 24).first()
    assert cf.clicks == 2
    assert cf.last_event_at == t0 + dt.timedelta(minutes=5)


def test_window_bounds_are_checked(spark):
    with pytest.raises(ValueError):
        feat.content_counts(_events(spark, _burst({"click": 1}, dt.datetime(2025, 11, 19))), NOW, 0)
    with pytest.raises(ValueError):
        feat.content_counts(_events(spark, _burst({"click": 1}, dt.datetime(2025, 11, 19))), NOW, 721)


def test_point_in_time_matches_brute_force(spark):
    import random

    rnd = random.Random(7)
    base = dt.datetime(2026, 4, 1)
    rows = []
    for i in range(400):
        ts = base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 5))
        rows.append((i, rnd.choice(C.EVENT_TYPES), "u", rnd.choice(["a", "b", "hot", "hot", "hot"]), "ai", ts))
    got = {r.event_id: r for r in feat.point_in_time_counts(_events(spark, rows), "content_id", 24).collect()}
    for eid, et, _, c, _, ts in rows:
        lo = ts - dt.timedelta(hours=24)
        expect = sum(1 for r in rows if r[3] == c and r[1] == "click" and lo < r[5] <= ts)
        assert got[eid].clicks == expect


def test_affinity_map_and_snapshot_as_of(spark):
    ut = spark.createDataFrame(
        [("u1", "ai", 3.0, None), ("u1", "devops", -1.0, None)],
        "user_id string, topic string, affinity_score double, last_event_at timestamp",
    )
    m = feat.affinity_map(ut).first().topic_affinity
    assert m == {"ai": 3.0, "devops": -1.0}
    snaps = spark.createDataFrame(
        [("c", dt.datetime(2026, 4, 1), 1), ("c", dt.datetime(2026, 4, 2), 2), ("c", dt.datetime(2026, 4, 3), 3)],
        "content_id string, snapshot_at timestamp, clicks int",
    )
    got = feat.snapshot_as_of(snaps, ["content_id"], "2026-04-02 12:00:00").first()
    assert got.clicks == 2


def test_pivoted_affinity_map_equals_two_step(spark):
    import random

    rnd = random.Random(5)
    now = dt.datetime(2025, 11, 19, 14)
    rows = []
    for i in range(600):
        ts = now - dt.timedelta(minutes=rnd.randrange(0, 60 * 30))
        topic = rnd.choice(list(C.TOPICS) + [None, "cooking"])
        rows.append((i, rnd.choice(C.EVENT_TYPES), f"u{rnd.randrange(20)}", "c", topic, ts))
    ev = _events(spark, rows)
    two_step = {r.user_id: r.topic_affinity for r in feat.affinity_map(feat.user_topic_affinity(ev, NOW, 24)).collect()}
    pivot = {r.user_id: r.topic_affinity for r in feat.affinity_map_pivot(ev, NOW, 24).collect()}
    assert pivot == two_step


def test_round6_is_python_round(spark):
    import random

    from rankflow.functions import round6

    rnd = random.Random(11)
    vals = [0.0078125, -0.0078125, 2.5e-6, 0.1254735, 0.430769500000001]
    for _ in range(20000):
        k = rnd.randrange(-10**7, 10**7)
        vals += [(k + 0.5) / 1e6, rnd.randrange(1, 3000) / rnd.randrange(1, 3000), rnd.uniform(-500, 500)]
    got = spark.createDataFrame([(v,) for v in vals], "x double").select("x", round6("x").alias("r")).collect()
    assert [r.r for r in got] == [round(r.x, 6) for r in got]
