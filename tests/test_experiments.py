"""Assignment buckets and attribution: golden values from the seed scenario."""

import datetime as dt
import random

from pyspark.sql import functions as F

from rankflow import constants as C
from rankflow.operators import attribution as attr
from rankflow.operators import experiments as exp

# fixed values: buckets that given ids must get
BUCKETS = [
    ("10000000-0000-0000-0000-000000000001", 2371),
    ("10000000-0000-0000-0000-000000000002", 2377),
    ("10000000-0000-0000-0000-000000000003", 1011),
    ("10000000-0000-0000-0000-000000000004", 6576),
    ("10000000-0000-0000-0000-000000000005", 6581),
]


def test_assignment_buckets_golden(spark):
    users = spark.createDataFrame([(i,) for i, _ in BUCKETS], "user_id string")
    got = {r.user_id: r for r in exp.assign(users, exp.variants_table(spark)).collect()}
    for uid, bucket in BUCKETS:
        first_half = bucket < 5000
        assert got[uid].assignment_bucket == bucket
        assert got[uid].variant_key == ("control" if first_half else "trending_boost")
        assert got[uid].strategy_name == (C.RULES_V1 if first_half else C.RULES_V2)


def test_variant_fallback_and_uneven_allocation(spark):
    rows = spark.createDataFrame([(b,) for b in (0, 2999, 3000, 9998, 9999)], "assignment_bucket int").withColumn(
        "experiment_key", F.lit("x")
    )
    v = exp.variants_table(spark, "x", (("a", C.RULES_V1, 3000), ("b", C.RULES_V2, 3000)))
    got = {r.assignment_bucket: r.variant_key for r in exp.resolve_variant(rows, v).collect()}
    # cumulative 3000 / 6000; the last variant also takes the unallocated rest
    assert got == {0: "a", 2999: "a", 3000: "b", 9998: "b", 9999: "b"}


NOW = "2025-06-30 12:00:00"


def _shop_scenario(spark):
    """Three pages of an invented garden shop, worked out by hand.

    p1 (control, 10:00): seeds, spade. p2 (control, 11:00): seeds again, for
    the same visitor. p3 (trending_boost, 09:30): pot, hose, soil.
    """
    day = dt.datetime(2025, 6, 30)
    at = lambda h, m=0: day + dt.timedelta(hours=h, minutes=m)
    pages = [
        ("p1", "control", C.RULES_V1, "ines", at(10)),
        ("p2", "control", C.RULES_V1, "ines", at(11)),
        ("p3", "trending_boost", C.RULES_V2, "olaf", at(9, 30)),
    ]
    headers = [(e, C.EXPERIMENT_KEY, v, s, u, t, t) for e, v, s, u, t in pages]
    shown = {"p1": ["seeds", "spade"], "p2": ["seeds"], "p3": ["pot", "hose", "soil"]}
    when = {e: t for e, _, _, _, t in pages}
    items = [(f"{e}/{c}", e, c, when[e]) for e, cs in shown.items() for c in cs]
    events = [
        (1, "ines", "seeds", "click", at(9, 59)),  # before any page: credited to none
        (2, "ines", "seeds", "click", at(10, 5)),  # p1
        (3, "ines", "seeds", "click", at(10, 6)),  # p1 again: counts once
        (4, "ines", "seeds", "save", at(11)),  # p2: a page counts from its own second on
        (5, "ines", "pot", "click", at(11, 30)),  # never shown to ines
        (6, "olaf", "pot", "watch_complete", at(20)),  # p3
        (7, "olaf", "hose", "click", at(9, 31)),  # p3
        (8, "olaf", "hose", "like", at(9, 32)),  # not an outcome
        (9, "olaf", "soil", "click", at(9, 33)),  # p3
    ]
    h = spark.createDataFrame(
        headers, "exposure_id string, experiment_key string, variant_key string, strategy_name string, user_id string, "
        "generated_at timestamp, created_at timestamp",
    )
    it = spark.createDataFrame(items, "item_id string, exposure_id string, content_id string, created_at timestamp")
    ev = spark.createDataFrame(events, "event_id long, user_id string, content_id string, event_type string, event_timestamp timestamp")
    return h, it, ev


def test_strategy_comparison_by_hand(spark):
    h, it, ev = _shop_scenario(spark)
    rows = attr.strategy_comparison(h, it, ev, NOW, 24).collect()
    assert [r.variant_key for r in rows] == ["control", "trending_boost"]
    c, t = rows
    assert (c.exposure_requests, c.item_exposures, c.unique_users, c.clicks, c.saves, c.completions) == (2, 3, 1, 1, 1, 0)
    assert (c.ctr, c.save_rate, c.completion_rate) == (0.333333, 0.333333, 0.0)
    assert (t.exposure_requests, t.item_exposures, t.unique_users, t.clicks, t.saves, t.completions) == (1, 3, 1, 2, 0, 1)
    assert (t.ctr, t.save_rate, t.completion_rate) == (0.666667, 0.0, 0.333333)
    best = {r.metric: (r.strategy_name, r.total_exposure_requests) for r in attr.best_strategy(attr.strategy_comparison(h, it, ev, NOW, 24)).collect()}
    assert best == {"ctr": (C.RULES_V2, 3), "save_rate": (C.RULES_V1, 3), "completion_rate": (C.RULES_V2, 3)}


def test_header_fields_on_the_items_need_no_join(spark):
    h, it, ev = _shop_scenario(spark)
    wide = it.join(h.drop("created_at"), "exposure_id")
    assert attr.strategy_comparison(h, wide, ev, NOW, 24).collect() == attr.strategy_comparison(h, it, ev, NOW, 24).collect()


def test_lookback_excludes_old_exposures_and_empty_result(spark):
    h, it, ev = _shop_scenario(spark)
    assert attr.strategy_comparison(h, it, ev, "2025-08-30 12:00:00", 168).count() == 0
    # two hours back only the page of 11:00 is left
    (only,) = attr.strategy_comparison(h, it, ev, NOW, 2).filter("exposure_requests > 0").collect()[:1]
    assert only.exposure_requests >= 1


def test_asof_join_matches_brute_force(spark):
    rnd = random.Random(3)
    base = dt.datetime(2026, 1, 1)
    right, left = [], []
    for i in range(300):
        right.append((rnd.choice("ab"), rnd.choice("xyz"), base + dt.timedelta(hours=rnd.randrange(0, 24 * 10)), f"r{i}"))
    for i in range(400):
        left.append((i, rnd.choice("ab"), rnd.choice("xyz"), base + dt.timedelta(hours=rnd.randrange(0, 24 * 12), minutes=rnd.randrange(60))))
    r = spark.createDataFrame(right, "u string, c string, t timestamp, rid string")
    lf = spark.createDataFrame(left, "lid long, u string, c string, ts timestamp")
    got = {row.lid: row.rid for row in attr.asof_join(lf, r, ["u", "c"], "ts", "t", ["rid"], [F.col("rid")], bucket_seconds=86400, how="left").collect()}
    for lid, u, c, ts in left:
        cands = [x for x in right if x[0] == u and x[1] == c and x[2] <= ts]
        expect = max(cands, key=lambda x: (x[2], x[3]))[3] if cands else None
        assert got[lid] == expect, (lid, got[lid], expect)
