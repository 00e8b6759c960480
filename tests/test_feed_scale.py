"""The feed over many users: partitions follow the users, items are scored once, users may span Arrow batches."""

import datetime as dt

from pyspark.sql import functions as F

from rankflow import constants as C
from rankflow.operators import candidates as cand
from rankflow.operators import feed, rerank, scoring
from test_ranking import NOW, SCHEMA, TOPICS, _expected, _order, _random_lists


def test_fanout_partitions_follow_the_users(spark):
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert feed.fanout_partitions(spark, spark.range(10)) == base
    assert feed.fanout_partitions(spark, spark.range(100 * feed.USERS_PER_TASK + 1)) == 101


def _pool(spark):
    rows = [
        (i, f"t{i}", TOPICS[i % 5] if i % 7 else "other", TOPICS[i % 3], dt.datetime(2025, 11, 1 + i % 9) if i % 11 else None, int(i % 2), int(i % 3 == 0), 1,
         (i % 10) / 9, (i % 4) / 7, (i % 5) / 11, (i % 6) / 5, (i % 8) / 13, i * 3.7)
        for i in range(40)
    ]
    return spark.createDataFrame(
        rows, "content_id long, title string, topic string, category string, published_at timestamp, in_recent int, in_trending int, in_topic int, "
        "ctr double, like_rate double, save_rate double, completion_rate double, skip_rate double, trending_score double")


def test_scores_of_the_pool_equal_scores_of_every_candidate(spark):
    pool = _pool(spark)
    names = [s[0] for s in C.STRATEGIES]
    users = spark.createDataFrame(
        [(u, [(t, (u * 7 + i) % 5 / 3) for i, t in enumerate(TOPICS)], TOPICS[u % 4 : u % 4 + 2], (names + [None])[u % 3]) for u in range(12)],
        "user_id long, affinity array<struct<topic: string, affinity: double>>, top_topics array<string>, strategy_name string",
    )
    priced = scoring.score_pool(pool, scoring.strategies_table(spark), NOW)
    assert priced.count() == 40 * (len(names) + 1)
    keyed = users.withColumn("strategy_key", F.coalesce("strategy_name", F.lit("")))
    got = scoring.user_scores(cand.generate(keyed, priced, on=("strategy_key",)))
    want = scoring.score(cand.generate(users, pool), scoring.strategies_table(spark), NOW)
    cols = ["user_id", "content_id", "source_flags", *[f"{k}_{c}" for k in "cw" for c in ("affinity", "recency", "engagement", "trending")], "c_adjustment", "base_score"]
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect())) and want.count() > 100


def test_pick_rises_in_the_order_of_ties(spark):
    rows = scoring.score_pool(_pool(spark), scoring.strategies_table(spark), NOW).filter("strategy_key = ''").collect()
    order = sorted(rows, key=lambda r: (r.published_at or dt.datetime.min, str(r.content_id)), reverse=True)
    assert [r.pick for r in order] == sorted(r.pick for r in rows)


def test_greedy_users_across_batches(spark):
    rows = _random_lists(40, False, 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = _order(rerank.rank_greedy(spark.createDataFrame(rows, SCHEMA)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == _expected(rows)


def test_rounding_of_arrays_is_exact():
    import numpy as np

    v = np.concatenate([np.arange(1, 4000) / 2e6, np.random.default_rng(1).normal(0, 1, 4000), [-0.35, 0.0, 2.5e-6, 1.0000005]])
    assert list(rerank._rounded(v)) == [round(x, 6) for x in v.tolist()]


def test_pages_behind_the_last_item_keep_their_total(spark):
    ranked = spark.createDataFrame([(1, r) for r in range(1, 4)] + [(2, r) for r in range(1, 26)], "user_id long, rank int")
    text = {c: F.lit(None).cast("string") for c in (*feed.ITEM_FIELDS[1:], "score_breakdown", "content_features", "experiment_key", "variant_key", "strategy_name")}
    pages = feed.page(ranked.withColumns(text), spark.range(1, 4).withColumnRenamed("id", "user_id"), 20, 20).collect()
    assert sorted((p.user_id, p.total_candidates, len(p["items"]), p.has_more) for p in pages) == [(1, 3, 0, False), (2, 25, 5, False), (3, 0, 0, False)]
