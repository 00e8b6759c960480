"""Diversity reranking.

Greedy selection repeatedly takes the candidate with the highest
``(round(base - penalty, 6), base, published_at, content_id text)`` where
``penalty = min(0.12 * picked_same_topic + 0.05 * picked_same_category, 0.35)``.

* ``rank_window``: when topic and category map one to one, the penalty of
  the j-th item of its topic is a function of j alone, so greedy equals two
  window functions over the user's partition (no Python).
* ``rank_greedy``: the general case in numpy, many users at a time: each step
  picks the next item of every user of a batch. A user's candidate list is
  bounded (40 + 20 + 3 * 20 = 120 items).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions import id_text, round6, sql_double


def _tie_order(score_col: str, tie: str | None = None) -> list:
    """``tie`` names a number that rises in the order of the last two."""
    last = [F.col(tie)] if tie else [F.col("published_at").desc_nulls_last(), id_text("content_id").desc()]
    return [F.col(score_col).desc(), F.col("base_score").desc(), *last]


def penalty_expr(n_picked: str) -> F.Column:
    """K8 for a group already picked ``n`` times (column name) in both topic
    and category."""
    n = f"`{n_picked}`"
    t, c, cap = (sql_double(v) for v in (C.DIVERSITY_TOPIC_PENALTY, C.DIVERSITY_CATEGORY_PENALTY, C.MAX_DIVERSITY_PENALTY))
    return round6(f"least({n} * {t} + {n} * {c}, {cap})")


def rank_window(
    scored: DataFrame, apply_diversity_penalty: bool = True, key: str = "user_id", topic: str = "topic", tie: str | None = None
) -> DataFrame:
    """K9 (topic == category case) and K10 (no penalty). ``topic`` and ``tie``
    name columns that stand for the topic and for the order of equal scores."""
    if apply_diversity_penalty:
        # position inside the topic without a (user, topic) partitioning:
        # row number over (topic, score order) minus the topic's first row,
        # so every window here clusters by the user alone (one partitioning)
        by_topic = Window.partitionBy(key).orderBy(F.col(topic).asc_nulls_first(), *_tie_order("base_score", tie))
        topic_start = Window.partitionBy(key).orderBy(F.col(topic).asc_nulls_first())
        j = F.row_number().over(by_topic) - F.rank().over(topic_start)
        s = scored.withColumn("_j", j).withColumn("diversity_penalty", penalty_expr("_j")).drop("_j")
    else:
        s = scored.withColumn("diversity_penalty", F.lit(0.0))
    s = s.withColumn("score", round6("base_score - diversity_penalty"))
    return s.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*_tie_order("score", tie))))


def topic_category_one_to_one(items: DataFrame) -> bool:
    """True when every topic has one category and vice versa. Run it on a
    bounded frame (the candidate pool) — it returns a single boolean."""
    t = items.groupBy("topic").agg(F.countDistinct("category").alias("n")).agg(F.max("n")).first()[0]
    c = items.groupBy("category").agg(F.countDistinct("topic").alias("n")).agg(F.max("n")).first()[0]
    return (t or 0) <= 1 and (c or 0) <= 1


#: picks after which a penalty has reached its bound whatever else was picked
FULL = int(np.ceil(C.MAX_DIVERSITY_PENALTY / min(C.DIVERSITY_TOPIC_PENALTY, C.DIVERSITY_CATEGORY_PENALTY))) + 1
#: users that are ranked at a time
USERS = 512


def _penalties() -> np.ndarray:
    """K8 by how often topic and category were picked, ``FULL`` times at most."""
    t, c = C.DIVERSITY_TOPIC_PENALTY, C.DIVERSITY_CATEGORY_PENALTY
    return np.array([[round(min(i * t + j * c, C.MAX_DIVERSITY_PENALTY), 6) for j in range(FULL + 1)] for i in range(FULL + 1)])


def _rounded(v: np.ndarray) -> np.ndarray:
    """``functions.round6`` of an array."""
    p, c = v * 1e6, v * 134217729.0
    hi = c - (c - v)
    err = (hi * 1e6 - p) + (v - hi) * 1e6
    low = np.floor(p)
    return np.where((p - low == 0.5) & (err != 0), low + (np.sign(err) + 1) / 2, np.rint(p)) / 1e6


def _greedy(base: np.ndarray, topic: np.ndarray, category: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(penalty, score, rank) of all rows; ``sizes`` are the rows of each user,
    who come one after the other, each in falling order of equal scores.

    The items of a (topic, category) share a penalty at every step, so only the
    first one left of each is compared."""
    table, n = _penalties(), len(sizes)
    pairs, group = np.unique(topic.astype(np.int64) * (int(category.max()) + 1) + category, return_inverse=True)
    g_topic, g_category = np.divmod(pairs, int(category.max()) + 1)
    user, every = np.repeat(np.arange(n), sizes), np.arange(n)
    # rows by user and group; a stable sort keeps the order of equal scores
    rows = np.argsort(user * len(pairs) + group, kind="stable")
    left = np.bincount(user * len(pairs) + group, minlength=n * len(pairs))
    head = (np.cumsum(left) - left).reshape(n, -1)
    left = left.reshape(n, -1)
    live = left > 0
    row = np.append(rows, 0)[head]
    first = np.where(live, base[row], 0.0)
    n_topic, n_category = np.zeros((n, int(topic.max()) + 1), np.int64), np.zeros((n, int(category.max()) + 1), np.int64)
    penalties, scores, ranks = np.zeros(len(base)), np.zeros(len(base)), np.zeros(len(base), np.int32)
    for step in range(int(sizes.max())):
        penalty = table.take(n_topic[:, g_topic] * (FULL + 1) + n_category[:, g_category])
        value = np.where(live, _rounded(first - penalty), -np.inf)
        # of equal scores the row that comes first
        best = np.where(value == value.max(1)[:, None], row, len(base)).argmin(1)
        some = step < sizes
        u, g = every[some], best[some]
        at = row[u, g]
        penalties[at], scores[at], ranks[at] = penalty[u, g], value[u, g], step + 1
        n_topic[u, g_topic[g]] = np.minimum(n_topic[u, g_topic[g]] + 1, FULL)
        n_category[u, g_category[g]] = np.minimum(n_category[u, g_category[g]] + 1, FULL)
        head[u, g] += 1
        left[u, g] -= 1
        more = left[u, g] > 0
        live[u, g] = more
        u, g = u[more], g[more]
        row[u, g] = rows[head[u, g]]
        first[u, g] = base[row[u, g]]
    return penalties, scores, ranks


def _greedy_rows(topic: str, category: str):
    """Adds penalty, score and rank to rows that come user by user, ``_place`` 1 first."""

    def ranked(t: pa.Table) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(t.column("_place").to_numpy() == 1)
        sizes = np.diff(np.append(first, t.num_rows))
        code = [pc.dictionary_encode(t.column(c).combine_chunks(), null_encoding="encode").indices.to_numpy() for c in (topic, category)]
        if t.column("base_score").null_count:
            raise ValueError("a candidate without a base score has no greedy rank")
        base = t.column("base_score").to_numpy()
        found = []
        for lo in range(0, len(first), USERS):
            rows = slice(first[lo], first[lo + USERS] if lo + USERS < len(first) else t.num_rows)
            found.append(_greedy(base[rows], code[0][rows], code[1][rows], sizes[lo : lo + USERS]))
        out = t.drop_columns(["_place"])
        for name, values in zip(("diversity_penalty", "score", "rank"), zip(*found)):
            out = out.append_column(name, pa.array(np.concatenate(values)))
        yield from out.combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            starts = np.flatnonzero(batch.column("_place").to_numpy() == 1)
            if not len(starts):
                held.append(batch)
                continue
            # the last user of a batch may go on in the next one
            last = int(starts[-1])
            if held or last:
                yield from ranked(pa.Table.from_batches([*held, batch.slice(0, last)]))
            held = [batch.slice(last)]
        if held:
            yield from ranked(pa.Table.from_batches(held))

    return run


def rank_greedy(scored: DataFrame, key: str = "user_id", topic: str = "topic", category: str = "category", tie: str | None = None) -> DataFrame:
    """K9 general form: whole rows go through Python user by user, so the scored
    candidates are computed once and nothing is joined back; the window reuses
    the user partitioning. ``topic``, ``category`` and ``tie`` as in ``rank_window``."""
    schema = T.StructType(
        list(scored.schema.fields)
        + [
            T.StructField("diversity_penalty", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rank", T.IntegerType()),
        ]
    )
    place = F.row_number().over(Window.partitionBy(key).orderBy(*_tie_order("base_score", tie)))
    return scored.withColumn("_place", place).mapInArrow(_greedy_rows(topic, category), schema)
