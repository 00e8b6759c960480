"""Scoring and diversity reranking: window form and grouped greedy form
against a brute-force greedy loop written from the rule."""

import datetime as dt
import random

import pytest

from rankflow import constants as C
from rankflow.operators import rerank, scoring

NOW = "2025-11-19 14:00:00"
TOPICS = list(C.TOPICS)


def brute_greedy(items):
    """items: dicts with base, topic, category, published, cid. Returns cid order."""
    remaining, picked, order = list(items), [], []
    while remaining:
        best = None
        for it in remaining:
            t = sum(1 for p in picked if p["topic"] == it["topic"])
            c = sum(1 for p in picked if p["category"] == it["category"])
            pen = round(min(t * C.DIVERSITY_TOPIC_PENALTY + c * C.DIVERSITY_CATEGORY_PENALTY, C.MAX_DIVERSITY_PENALTY), 6)
            key = (round(it["base"] - pen, 6), it["base"], it["published"] or dt.datetime.min, str(it["cid"]))
            if best is None or key > best[0]:
                best = (key, it)
        picked.append(best[1])
        order.append(best[1]["cid"])
        remaining.remove(best[1])
    return order


def _random_lists(n_users, one_to_one, seed):
    rnd = random.Random(seed)
    rows = []
    for u in range(n_users):
        for i in range(rnd.randrange(1, 40)):
            topic = rnd.choice(TOPICS)
            cat = topic if one_to_one else rnd.choice(TOPICS)
            base = round(rnd.choice([0.3, 0.31, 0.5, 0.5, 0.52, 0.7]) + rnd.choice([0, 0.01, 0.17, 0.05]), 6)
            pub = dt.datetime(2026, 4, 1) + dt.timedelta(hours=rnd.choice([1, 2, 3])) if rnd.random() > 0.1 else None
            rows.append((u, i, topic, cat, base, pub))
    return rows


SCHEMA = "user_id long, content_id long, topic string, category string, base_score double, published_at timestamp"


def _expected(rows):
    by_user = {}
    for u, cid, t, c, b, p in rows:
        by_user.setdefault(u, []).append({"cid": cid, "topic": t, "category": c, "base": b, "published": p})
    return {u: brute_greedy(v) for u, v in by_user.items()}


def _order(df):
    out = {}
    for r in df.orderBy("user_id", "rank").collect():
        out.setdefault(r.user_id, []).append(r.content_id)
    return out


def test_window_form_equals_greedy_when_topic_is_category(spark):
    rows = _random_lists(60, True, 11)
    got = _order(rerank.rank_window(spark.createDataFrame(rows, SCHEMA)))
    assert got == _expected(rows)


def test_grouped_greedy_general_case(spark):
    rows = _random_lists(60, False, 12)
    got = _order(rerank.rank_greedy(spark.createDataFrame(rows, SCHEMA)))
    assert got == _expected(rows)


def test_auto_mode_detects_one_to_one(spark):
    assert rerank.topic_category_one_to_one(spark.createDataFrame(_random_lists(5, True, 1), SCHEMA))
    assert not rerank.topic_category_one_to_one(spark.createDataFrame(_random_lists(5, False, 1), SCHEMA))


def _candidates(spark, rows):
    return spark.createDataFrame(
        rows,
        "user_id string, content_id string, topic string, category string, published_at timestamp, "
        "user_topic_affinity double, ctr double, like_rate double, save_rate double, completion_rate double, "
        "skip_rate double, trending_score double, strategy_name string",
    )


def test_recency_order_clamp_and_breakdown(spark):
    now = dt.datetime(2025, 11, 19, 14)
    rows = [
        ("u", "new", "ai", "ai", now - dt.timedelta(hours=1), 1.7, 1.0, 2.0, 2.0, 1.0, 0.1, 10.0, "rules_v1"),
        ("u", "old", "ai", "ai", now - dt.timedelta(hours=96), -0.2, 0.1, 0.0, 0.0, 0.0, 0.9, 0.0, " rules_based.v1 "),
        ("u", "none", "ai", "ai", None, 0.5, 0.1, 0.0, 0.0, 0.0, 0.0, 0.0, "rules_v1"),
    ]
    s = {r.content_id: r for r in scoring.score(_candidates(spark, rows), scoring.strategies_table(spark), NOW).collect()}
    assert s["new"].c_recency > s["old"].c_recency > s["none"].c_recency == 0.0
    assert s["old"].c_recency == round(1 / (1 + 96 / 48), 6)
    assert s["new"].c_affinity == 1.0 and s["old"].c_affinity == 0.0  # clamped
    assert s["old"].strategy_name == "rules_v1"  # alias + trim
    assert s["new"].c_engagement == 1.0 and s["old"].c_engagement == 0.0
    assert s["new"].c_trending == round(10 / 35, 6)
    parts = s["new"]
    assert parts.base_score == round(round(parts.w_affinity + parts.w_recency + parts.w_engagement + parts.w_trending, 6) + parts.c_adjustment, 6)


def test_v2_boost_flips_order(spark):
    now = dt.datetime(2025, 11, 19, 14)
    # a: fresh, weak trending; b: older, strong trending
    base = [
        ("a", "ai", "ai", now - dt.timedelta(hours=2), 0.6, 0.2, 0.1, 0.1, 0.2, 0.0, 2.0),
        ("b", "devops", "devops", now - dt.timedelta(hours=200), 0.6, 0.2, 0.1, 0.1, 0.2, 0.0, 100.0),
    ]
    rows = [("v1", *r, "rules_v1") for r in base] + [("v2", *r, "rules_v2_with_trending_boost") for r in base]
    scored = scoring.score(_candidates(spark, rows), scoring.strategies_table(spark), NOW)
    ranked = _order(rerank.rank_window(scored))
    assert ranked["v1"][0] == "a"
    assert ranked["v2"][0] == "b"
    adj = {(r.user_id, r.content_id): r.c_adjustment for r in scored.collect()}
    assert adj[("v1", "b")] == 0.0 and adj[("v2", "b")] == 0.0525


@pytest.mark.parametrize("one_to_one", [True, False])
def test_no_penalty_mode_orders_by_base(spark, one_to_one):
    rows = _random_lists(10, one_to_one, 5)
    got = rerank.rank_window(spark.createDataFrame(rows, SCHEMA), apply_diversity_penalty=False)
    for r in got.collect():
        assert r.diversity_penalty == 0.0 and r.score == r.base_score
