"""Vector searches where ids repeat and lengths mix: every valid row takes part, held against brute force."""

import numpy as np
import pytest

from rankflow.llm import kdtree, mih


def odd_rows():
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=6)) for i in range(300)]
    rows += [(i, rng.normal(size=4)) for i in range(0, 300, 2)]
    rows += [(100, rng.normal(size=6)) for _ in range(120)]
    rows += [(7, rows[3][1]), (100, rows[50][1]), (200, np.zeros(6))]
    rows += rows[90:110]
    return [(i, v.astype(np.float32).astype(float).tolist()) for i, v in rows]


def wanted(rows, every, k, score, larger):
    rows = list({(i, tuple(v)) for i, v in rows})
    out = []
    for q, x in rows:
        if q % every:
            continue
        near = [(score(np.array(x), np.array(v)), i) for i, v in rows if len(v) == len(x) and (i, v) != (q, x)]
        near.sort(key=lambda r: (-r[0] if larger else r[0], r[1]))
        out.append((q, [(i, s) for s, i in near[:k]]))
    return sorted(out)


def lists(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        out.setdefault((r.query_id, r.query_key), []).append((r.vec_id, r.score))
    return sorted((q, near) for (q, _), near in out.items())


@pytest.mark.parametrize("shard_rows", [60_000, 150])
def test_nearest_of_all_rows(spark, shard_rows):
    rows = odd_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    valid = [(i, v) for i, v in rows if any(v)]
    got = lists(mih.neighbours(df, shard_rows=shard_rows))
    want = wanted(valid, 100, 10, lambda a, b: float(np.sqrt(((a - b) ** 2).sum())), False)
    assert [(q, [i for i, _ in near]) for q, near in got] == [(q, [i for i, _ in near]) for q, near in want]
    assert np.allclose([s for _, near in got for _, s in near], [s for _, near in want for _, s in near], rtol=0, atol=1e-12)
    assert sum(q == 100 for q, _ in got) == 123


@pytest.mark.parametrize("shard_rows", [30_000, 150])
def test_products_of_all_rows(spark, shard_rows):
    rows = odd_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = lambda x: np.floor(256 * x).astype(np.int64)
    got = lists(kdtree.top_products(df, shard_rows=shard_rows))
    assert got == wanted(rows, 50, 5, lambda a, b: int(whole(a) @ whole(b)), True)
