"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement reads the raw shared tables (``events``, ``part``,
``customer``) and restates the operator in plain SQL: the same projections,
window bounds, rounding points and tie-breaks. Literals that must be
doubles are cast, because DuckDB reads ``0.1`` as a DECIMAL.
"""

from __future__ import annotations

import itertools

from .. import constants as C
from ..sources.tables import LOG_TOPICS, OPERATIONS, SERVICES

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
T = "[" + ", ".join(f"'{t}'" for t in C.TOPICS) + "]"
T_IN = "(" + ", ".join(f"'{t}'" for t in C.TOPICS) + ")"


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


_R6 = itertools.count()


def r6(expr: str, digits: int = 6) -> str:
    """Python's round(x, 6) (exact binary value, ties to even) in DuckDB SQL:
    ``round_even`` of the rounded product unless that product is exactly a
    half-integer, where the sign of its exact error (Dekker two-product)
    decides. ``x`` is bound once by a lambda."""
    v = f"_r{next(_R6)}"
    sc = dbl(10**digits)
    p = f"({v} * {sc})"
    c = f"({v} * {dbl(134217729.0)})"
    hi = f"({c} - ({c} - {v}))"
    err = f"((({hi} * {sc}) - {p}) + (({v} - {hi}) * {sc}))"
    tie = f"(({p} - floor({p})) = {dbl(0.5)})"
    m = f"CASE WHEN {tie} AND {err} <> 0 THEN floor({p}) + (sign({err}) + {dbl(1)}) / {dbl(2)} ELSE round_even({p}, 0) END"
    return f"(list_transform([CAST({expr} AS DOUBLE)], lambda {v}: ({m}) / {sc})[1])"


def rate(n: str, d: str) -> str:
    return f"(CASE WHEN ({d}) > 0 THEN {r6(f'CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE)')} ELSE {dbl(0)} END)"


def clamp(x: str) -> str:
    return f"greatest({dbl(0)}, least({dbl(1)}, {x}))"


def weighted(weights: dict, p: str = "") -> str:
    return "(" + " + ".join(f"CAST({p}{m} AS DOUBLE) * {dbl(w)}" for m, w in weights.items()) + ")"


def seconds_between(later: str, earlier: str) -> str:
    return f"(CAST(epoch_us({later}) - epoch_us({earlier}) AS DOUBLE) / {dbl(1_000_000)})"


def trending(now: str, window_hours: int, p: str = "") -> str:
    b = C.TRENDING_BONUS
    bonus = (
        f"({rate(p + 'clicks', p + 'impressions')} * {dbl(b['ctr'])}"
        f" + {rate(p + 'likes', f'greatest({p}clicks, 1)')} * {dbl(b['like'])}"
        f" + {rate(p + 'saves', f'greatest({p}clicks, 1)')} * {dbl(b['save'])}"
        f" + {rate(p + 'watch_completes', f'greatest({p}watch_starts, 1)')} * {dbl(b['completion'])})"
    )
    raw = f"greatest({weighted(C.TRENDING_WEIGHTS, p)} + {bonus}, {dbl(0)})"
    age = f"greatest({seconds_between(now, p + 'last_event_at')}, {dbl(0)})"
    decay = f"exp(-{age} / {dbl(max(window_hours * 3600, 1))})"
    return f"(CASE WHEN {p}last_event_at IS NULL THEN {r6(raw)} ELSE {r6(f'{raw} * {decay}')} END)"


def affinity(p: str = "") -> str:
    bonus = f"{rate(p + 'watch_completes', f'greatest({p}watch_starts, 1)')} * {dbl(C.AFFINITY_COMPLETION_BONUS)}"
    return r6(f"{weighted(C.AFFINITY_WEIGHTS, p)} + {bonus}")


def counts_sql() -> str:
    return ", ".join(f"CAST(count_if(event_type = '{et}') AS BIGINT) AS {m}" for et, m in C.METRIC_FOR_EVENT.items())


METRICS = ", ".join(C.METRICS)

# ---------------------------------------------------------------- base CTEs
INTERACTIONS = f"""
interactions AS (
  SELECT event_id,
         CASE event_type
           WHEN 'view' THEN CASE WHEN event_id % 3 = 0 THEN 'watch_start' ELSE 'impression' END
           WHEN 'click' THEN 'click'
           WHEN 'signup' THEN 'like'
           WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 'watch_complete' ELSE 'save' END
           WHEN 'error' THEN 'skip' END AS event_type,
         user_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS content_id,
         concat(CAST(user_id AS VARCHAR), '-', strftime(ts, '%Y%m%d')) AS session_id,
         {T}[CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 + 1] AS topic,
         CAST(CASE WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN 1 + event_id % 600 ELSE 0 END AS INTEGER)
           AS watch_duration_seconds,
         ts AS event_timestamp
  FROM events)"""


def content_cte(general_category: bool = False) -> str:
    cat = f"{T}[(p_partkey // 5) % 5 + 1]" if general_category else f"{T}[p_partkey % 5 + 1]"
    return f"""
content AS (
  SELECT p_partkey AS content_id,
         concat(p_name, ' ', CAST(p_partkey AS VARCHAR)) AS title,
         {T}[p_partkey % 5 + 1] AS topic,
         {cat} AS category,
         CASE WHEN p_partkey % 8 = 0 THEN 'draft' ELSE 'published' END AS status,
         CASE WHEN p_partkey % 8 <> 0 THEN {AS_OF} - to_hours(CAST(4 * p_partkey AS BIGINT)) END AS published_at,
         {AS_OF} - to_hours(CAST(CASE WHEN p_partkey % 8 = 0 THEN 7 * p_partkey + 6 ELSE 4 * p_partkey + 12 END AS BIGINT))
           AS created_at
  FROM part)"""


USERS = """
users AS (SELECT c_custkey AS user_id FROM customer)"""

TOPICS = "\ntopics AS (SELECT * FROM (VALUES " + ", ".join(f"({i + 1}, '{t}')" for i, t in enumerate(C.TOPICS)) + ") t(i, topic))"

PROFILES = f"""
profiles AS (
  SELECT u.user_id, t.topic, CAST((u.user_id * 7 + t.i * 13) % 101 AS DOUBLE) / {dbl(100)} AS preference
  FROM users u CROSS JOIN topics t WHERE u.user_id % 10 <> 9)"""


def window_filter(window_hours: int, as_of: str = AS_OF) -> str:
    return f"event_timestamp > {as_of} - INTERVAL {int(window_hours)} HOUR AND event_timestamp <= {as_of}"


def content_features_cte(window_hours: int, name: str = "cf", source: str = "interactions", as_of: str = AS_OF) -> str:
    return f"""
{name}_counts AS (
  SELECT content_id, {counts_sql()}, max(event_timestamp) AS last_event_at,
         arg_max(topic, event_timestamp) FILTER (WHERE topic IS NOT NULL) AS topic
  FROM {source} WHERE {window_filter(window_hours, as_of=as_of)} GROUP BY content_id),
{name}_r AS (
  SELECT content_id, topic, {int(window_hours)} AS window_hours, {METRICS},
         {rate('clicks', 'impressions')} AS ctr,
         {rate('likes', 'clicks')} AS like_rate,
         {rate('saves', 'clicks')} AS save_rate,
         {rate('skip_count', 'impressions')} AS skip_rate,
         {rate('watch_completes', 'watch_starts')} AS completion_rate,
         {trending(as_of, window_hours)} AS trending_score,
         last_event_at
  FROM {name}_counts),
{name} AS (
  SELECT *, greatest(ctr, like_rate, save_rate, skip_rate, completion_rate) > 1.0 AS rate_out_of_bounds FROM {name}_r)"""


def user_topic_cte(window_hours: int) -> str:
    return f"""
ut_counts AS (
  SELECT user_id, topic, {counts_sql()}, max(event_timestamp) AS _last
  FROM interactions WHERE {window_filter(window_hours)} AND topic IS NOT NULL GROUP BY user_id, topic),
ut AS (
  SELECT user_id, topic, {int(window_hours)} AS window_hours, {METRICS}, {affinity()} AS affinity_score,
         max(_last) OVER (PARTITION BY user_id) AS last_event_at
  FROM ut_counts)"""


def assignment_cte(source: str = "users") -> str:
    case_v, case_s, lo = [], [], 0
    for i, (v, s, bp) in enumerate(C.EXPERIMENT_VARIANTS):
        hi = lo + bp
        if i == len(C.EXPERIMENT_VARIANTS) - 1:
            case_v.append(f"ELSE '{v}'")
            case_s.append(f"ELSE '{s}'")
        else:
            case_v.append(f"WHEN b < {hi} THEN '{v}'")
            case_s.append(f"WHEN b < {hi} THEN '{s}'")
        lo = hi
    return f"""
assign_b AS (
  SELECT user_id,
         CAST(('0x' || substr(sha256('{C.EXPERIMENT_KEY}:' || CAST(user_id AS VARCHAR)), 1, 16))::UBIGINT % {C.BUCKET_SPACE} AS INTEGER) AS b
  FROM {source}),
assignments AS (
  SELECT '{C.EXPERIMENT_KEY}' AS experiment_key, CASE {' '.join(case_v)} END AS variant_key,
         CASE {' '.join(case_s)} END AS strategy_name, user_id, b AS assignment_bucket
  FROM assign_b)"""


EXPOSURES = f"""
seen AS (
  SELECT user_id, content_id, date_trunc('hour', event_timestamp) AS page_hour, event_timestamp
  FROM interactions WHERE event_type IN ('impression', 'watch_start')),
per_item AS (SELECT user_id, page_hour, content_id, min(event_timestamp) AS first_seen_at FROM seen GROUP BY ALL),
per_page AS (SELECT user_id, page_hour, min(first_seen_at) AS generated_at FROM per_item GROUP BY ALL),
items AS (
  SELECT concat(CAST(i.user_id AS VARCHAR), '-', strftime(i.page_hour, '%Y%m%d%H')) AS exposure_id,
         concat(CAST(i.user_id AS VARCHAR), '-', strftime(i.page_hour, '%Y%m%d%H'), ':', CAST(i.content_id AS VARCHAR)) AS item_id,
         i.user_id, i.content_id, p.generated_at, p.generated_at AS created_at
  FROM per_item i JOIN per_page p USING (user_id, page_hour)),
exposed_users AS (SELECT DISTINCT user_id FROM items),
{assignment_cte('exposed_users').strip()},
header AS (
  SELECT h.exposure_id, h.user_id, h.generated_at, h.generated_at AS created_at, a.experiment_key, a.variant_key, a.strategy_name
  FROM (SELECT exposure_id, user_id, min(generated_at) AS generated_at FROM items GROUP BY ALL) h
  JOIN assignments a USING (user_id)),
outcomes AS (
  SELECT event_id, user_id, content_id, event_type, event_timestamp
  FROM interactions WHERE event_type IN ('click', 'save', 'watch_complete'))"""


def comparison_ctes(lookback_hours: int) -> str:
    return f"""
h AS (SELECT * FROM header WHERE experiment_key = '{C.EXPERIMENT_KEY}' AND created_at >= {AS_OF} - INTERVAL {int(lookback_hours)} HOUR),
it AS (
  SELECT i.item_id, i.exposure_id, i.content_id, i.created_at, h.user_id, h.generated_at, h.variant_key, h.strategy_name
  FROM items i JOIN h USING (exposure_id)),
att AS (
  SELECT o.event_type, e.item_id
  FROM outcomes o ASOF JOIN it e
    ON o.user_id = e.user_id AND o.content_id = e.content_id AND o.event_timestamp >= e.generated_at),
flags AS (
  SELECT item_id,
         max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS clicked,
         max(CASE WHEN event_type = 'save' THEN 1 ELSE 0 END) AS saved,
         max(CASE WHEN event_type = 'watch_complete' THEN 1 ELSE 0 END) AS completed
  FROM att GROUP BY item_id),
per_item_s AS (
  SELECT strategy_name, count(*) AS item_exposures,
         CAST(coalesce(sum(clicked), 0) AS BIGINT) AS clicks,
         CAST(coalesce(sum(saved), 0) AS BIGINT) AS saves,
         CAST(coalesce(sum(completed), 0) AS BIGINT) AS completions
  FROM it LEFT JOIN flags USING (item_id) GROUP BY strategy_name),
per_page_s AS (
  SELECT strategy_name, arg_min(variant_key, (created_at, exposure_id)) AS variant_key,
         count(*) AS exposure_requests, count(DISTINCT user_id) AS unique_users
  FROM h GROUP BY strategy_name),
comparison AS (
  SELECT p.variant_key, p.strategy_name, p.exposure_requests,
         coalesce(i.item_exposures, 0) AS item_exposures, p.unique_users,
         coalesce(i.clicks, 0) AS clicks, coalesce(i.saves, 0) AS saves, coalesce(i.completions, 0) AS completions,
         {rate('coalesce(i.clicks, 0)', 'coalesce(i.item_exposures, 0)')} AS ctr,
         {rate('coalesce(i.saves, 0)', 'coalesce(i.item_exposures, 0)')} AS save_rate,
         {rate('coalesce(i.completions, 0)', 'coalesce(i.item_exposures, 0)')} AS completion_rate
  FROM per_page_s p LEFT JOIN per_item_s i USING (strategy_name))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


# ------------------------------------------------------------ feed chain
def _recency_order(p: str = "") -> str:
    return f"{p}published_at DESC NULLS LAST, {p}created_at DESC, CAST({p}content_id AS VARCHAR) DESC"


def feed_ctes(window_hours: int = C.FEATURE_WINDOW_HOURS, general_category: bool = False) -> list[str]:
    strat_rows = ", ".join(
        f"('{s[0]}', {dbl(s[1])}, {dbl(s[2])}, {dbl(s[3])}, {dbl(s[4])}, {dbl(s[5])}, {dbl(s[6])}, {dbl(s[7])})"
        for s in C.STRATEGIES
    )
    fcols = ", ".join(f"coalesce(cf.{m}, 0) AS {m}" for m in C.METRICS) + ", " + ", ".join(
        f"coalesce(cf.{c}, {dbl(0)}) AS {c}" for c in ("ctr", "like_rate", "save_rate", "skip_rate", "completion_rate", "trending_score")
    )
    w = C.ENGAGEMENT_WEIGHTS
    n_pen = "CAST(j - 1 AS DOUBLE)"
    return [
        INTERACTIONS,
        content_cte(general_category),
        USERS,
        TOPICS,
        PROFILES,
        content_features_cte(window_hours),
        user_topic_cte(window_hours),
        assignment_cte("users"),
        f"""
stats AS (
  SELECT user_id, max(greatest(affinity_score, {dbl(0)})) AS scale, count_if(topic IN {T_IN}) AS n_in
  FROM ut GROUP BY user_id),
eff AS (
  SELECT u.user_id, t.topic, t.i,
         CASE WHEN coalesce(s.scale, 0) > 0 AND coalesce(s.n_in, 0) > 0
              THEN {r6(f"{dbl(C.RUNTIME_AFFINITY_WEIGHT)} * coalesce({r6(f'greatest(r.affinity_score, {dbl(0)}) / s.scale')}, {dbl(0)}) + {dbl(C.PROFILE_AFFINITY_WEIGHT)} * coalesce(p.preference, {dbl(0)})")}
              ELSE {r6(f"coalesce(p.preference, {dbl(0)})")} END AS affinity
  FROM users u CROSS JOIN topics t
  LEFT JOIN stats s ON s.user_id = u.user_id
  LEFT JOIN ut r ON r.user_id = u.user_id AND r.topic = t.topic
  LEFT JOIN profiles p ON p.user_id = u.user_id AND p.topic = t.topic),
eff_ranked AS (
  SELECT e.*, CASE WHEN affinity > 0 THEN row_number() OVER (PARTITION BY user_id, affinity > 0 ORDER BY affinity DESC, topic DESC) END AS _r
  FROM eff e),
eff_top AS (
  SELECT user_id, topic, affinity, CAST(CASE WHEN _r <= {C.MAX_TOPIC_SOURCES} THEN _r ELSE 0 END AS INTEGER) AS topic_rank FROM eff_ranked),
published AS (SELECT * FROM content WHERE status = 'published'),
seed AS (
  SELECT *, row_number() OVER (ORDER BY {_recency_order()}) AS seq FROM published
  QUALIFY seq <= {C.TRENDING_SEED_LIMIT}),
seed_f AS (SELECT s.*, coalesce(cf.trending_score, {dbl(0)}) AS trending_score FROM seed s LEFT JOIN cf USING (content_id)),
seed_flags AS (
  SELECT content_id, title, topic, category, published_at, created_at,
         CAST(seq <= {C.RECENT_LIMIT} AS INTEGER) AS in_recent,
         CAST(row_number() OVER (ORDER BY trending_score DESC, coalesce(published_at, created_at) DESC,
                                 CAST(content_id AS VARCHAR) DESC) <= {C.TRENDING_SOURCE_LIMIT} AS INTEGER) AS in_trending,
         0 AS in_topic
  FROM seed_f),
per_topic AS (
  SELECT content_id, title, topic, category, published_at, created_at, 0 AS in_recent, 0 AS in_trending, 1 AS in_topic
  FROM published WHERE topic IN {T_IN}
  QUALIFY row_number() OVER (PARTITION BY topic ORDER BY {_recency_order()}) <= {C.TOPIC_CANDIDATE_LIMIT}),
pool AS (
  SELECT content_id, title, topic, category, published_at, created_at,
         max(in_recent) AS in_recent, max(in_trending) AS in_trending, max(in_topic) AS in_topic
  FROM (SELECT * FROM seed_flags WHERE in_recent = 1 OR in_trending = 1 UNION ALL SELECT * FROM per_topic)
  GROUP BY ALL),
pool_f AS (
  SELECT pool.*, {fcols}, cf.last_event_at
  FROM pool LEFT JOIN cf USING (content_id)),
strategies AS (
  SELECT * FROM (VALUES {strat_rows}) s(strategy_name, affinity_weight, recency_weight, engagement_weight,
                                         trending_weight, boost_threshold, boost_multiplier, max_adjustment)),
cands0 AS (
  SELECT u.user_id, p.*, coalesce(e.affinity, {dbl(0)}) AS user_topic_affinity, e.topic_rank > 0 AS is_top,
         a.experiment_key, a.variant_key, a.strategy_name,
         list_filter([CASE WHEN p.in_recent = 1 THEN 'recent' END,
                      CASE WHEN p.in_trending = 1 THEN 'trending' END,
                      CASE WHEN p.in_topic = 1 AND e.topic_rank > 0 THEN 'topic_affinity' END], lambda x: x IS NOT NULL) AS sources
  FROM users u CROSS JOIN pool_f p
  LEFT JOIN eff_top e ON e.user_id = u.user_id AND e.topic = p.topic
  LEFT JOIN assignments a ON a.user_id = u.user_id),
cands AS (SELECT * FROM cands0 WHERE len(sources) > 0),
scored0 AS (
  SELECT c.*, s.boost_threshold, s.boost_multiplier, s.max_adjustment,
         s.affinity_weight, s.recency_weight, s.engagement_weight, s.trending_weight,
         {r6(clamp('c.user_topic_affinity'))} AS c_affinity,
         CASE WHEN c.published_at IS NULL THEN {dbl(0)} ELSE {r6(clamp(
             f"{dbl(1)} / ({dbl(1)} + greatest({seconds_between(AS_OF, 'c.published_at')} / {dbl(3600)}, {dbl(0)}) / {dbl(C.RECENCY_HALF_LIFE_HOURS)})"))} END AS c_recency,
         {r6(clamp(f"{dbl(w['ctr'])} * c.ctr + {dbl(w['like_rate'])} * c.like_rate + {dbl(w['save_rate'])} * c.save_rate + {dbl(w['completion_rate'])} * c.completion_rate - {dbl(-w['skip_rate'])} * c.skip_rate"))} AS c_engagement,
         CASE WHEN c.trending_score <= 0 THEN {dbl(0)} ELSE {r6(clamp(f"c.trending_score / (c.trending_score + {dbl(C.TRENDING_SATURATION)})"))} END AS c_trending
  FROM cands c LEFT JOIN strategies s USING (strategy_name)),
scored1 AS (
  SELECT *,
         CASE WHEN c_trending <= boost_threshold THEN {dbl(0)} ELSE {r6('least((c_trending - boost_threshold) * boost_multiplier, max_adjustment)')} END AS c_adjustment,
         {r6('c_affinity * affinity_weight')} AS w_affinity,
         {r6('c_recency * recency_weight')} AS w_recency,
         {r6('c_engagement * engagement_weight')} AS w_engagement,
         {r6('c_trending * trending_weight')} AS w_trending
  FROM scored0),
scored AS (
  SELECT *, {r6(r6('w_affinity + w_recency + w_engagement + w_trending') + ' + c_adjustment')} AS base_score FROM scored1),
pen AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, topic ORDER BY base_score DESC, published_at DESC NULLS LAST,
                                                               CAST(content_id AS VARCHAR) DESC) AS j
  FROM scored),
ranked_d AS (
  SELECT *, {r6(f"least({n_pen} * {dbl(C.DIVERSITY_TOPIC_PENALTY)} + {n_pen} * {dbl(C.DIVERSITY_CATEGORY_PENALTY)}, {dbl(C.MAX_DIVERSITY_PENALTY)})")} AS diversity_penalty
  FROM pen),
ranked_s AS (SELECT *, {r6('base_score - diversity_penalty')} AS score FROM ranked_d),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, base_score DESC, published_at DESC NULLS LAST,
                                                      CAST(content_id AS VARCHAR) DESC) AS INTEGER) AS rank
  FROM ranked_s),
ranked_nd AS (
  SELECT * REPLACE ({dbl(0)} AS diversity_penalty, {r6(f'base_score - {dbl(0)}')} AS score),
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY base_score DESC, base_score DESC, published_at DESC NULLS LAST,
                                 CAST(content_id AS VARCHAR) DESC) AS INTEGER) AS rank
  FROM ranked_s)""",
    ]


def greedy_ctes() -> str:
    """K9 in general: each step of the recursion takes every user's best
    remaining candidate; the row carries what was picked and how often each
    topic and category was."""
    zeros = "[" + ", ".join("0" for _ in C.TOPICS) + "]"
    picked = lambda counts, of: f"p.{counts}[list_position({T}, g.{of})]"
    raw = f"CAST({picked('tc', 'topic')} AS DOUBLE) * {dbl(C.DIVERSITY_TOPIC_PENALTY)} + CAST({picked('cc', 'category')} AS DOUBLE) * {dbl(C.DIVERSITY_CATEGORY_PENALTY)}"
    more = lambda counts, of: f"list_transform({counts}, lambda x, i: x + CAST(i = list_position({T}, {of}) AS INTEGER))"
    return f"""
remaining AS (SELECT user_id, content_id, topic, category, base_score, published_at FROM scored),
picks(user_id, step, content_id, diversity_penalty, score, taken, tc, cc) AS (
  SELECT DISTINCT user_id, 0, CAST(NULL AS BIGINT), {dbl(0)}, {dbl(0)}, CAST([] AS BIGINT[]), {zeros}, {zeros} FROM remaining
  UNION ALL
  SELECT user_id, step + 1, content_id, pen, score, list_append(taken, content_id), {more('tc', 'topic')}, {more('cc', 'category')}
  FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, base_score DESC, published_at DESC NULLS LAST,
                                 CAST(content_id AS VARCHAR) DESC) AS best
    FROM (SELECT *, {r6('base_score - pen')} AS score
          FROM (SELECT p.user_id, p.step, p.taken, p.tc, p.cc, g.content_id, g.topic, g.category, g.base_score, g.published_at,
                       {r6(f'least({raw}, {dbl(C.MAX_DIVERSITY_PENALTY)})')} AS pen
                FROM picks p JOIN remaining g ON g.user_id = p.user_id AND NOT list_contains(p.taken, g.content_id)) a) b) c
  WHERE best = 1)"""


RANKED_COLS = (
    "user_id, content_id, topic, category, array_to_string(sources, ',') AS candidate_sources, "
    "user_topic_affinity, strategy_name, base_score, diversity_penalty, score, rank"
)


def page_sql(offset: int, limit: int, full: bool) -> str:
    cols = (
        "u.user_id, g.variant_key, g.strategy_name, 20 AS feed_limit, 0 AS feed_offset, "
        if full
        else "u.user_id, "
    )
    return with_(*feed_ctes()) + f"""
, g AS (
  SELECT user_id, count(*) AS total_candidates,
         any_value(variant_key) AS variant_key, any_value(strategy_name) AS strategy_name,
         CAST(count(*) FILTER (WHERE rank > {offset} AND rank <= {offset + limit}) AS INTEGER) AS item_count,
         coalesce(string_agg(CAST(content_id AS VARCHAR), ',' ORDER BY rank) FILTER (WHERE rank > {offset} AND rank <= {offset + limit}), '') AS content_ids
  FROM ranked GROUP BY user_id)
SELECT {cols}coalesce(g.total_candidates, 0) AS total_candidates,
       {offset + limit} < coalesce(g.total_candidates, 0) AS has_more,
       coalesce(g.item_count, 0) AS item_count, coalesce(g.content_ids, '') AS content_ids
FROM users u LEFT JOIN g USING (user_id)"""


# ------------------------------------------------------------- validation
DIRTY = f"""
dirty0 AS (
  SELECT i.*, c.copy FROM interactions i,
         UNNEST(CASE WHEN event_id % 50 = 5 THEN [0, 1] WHEN event_id % 50 = 6 THEN [0, 2] ELSE [0] END) AS c(copy)),
dirty AS (
  SELECT '{C.INTERACTION_SCHEMA_NAME}' AS schema_name, event_id,
         CASE WHEN event_id % 50 = 0 THEN 'share' WHEN event_id % 50 = 1 THEN 'watch_complete' ELSE event_type END AS event_type,
         user_id, content_id,
         CASE WHEN event_id % 50 = 3 THEN '' ELSE session_id END AS session_id,
         CASE WHEN event_id % 50 = 2 THEN '  Backend ' WHEN event_id % 50 = 4 THEN 'cooking' ELSE topic END AS topic,
         CASE WHEN event_id % 50 = 1 THEN 0 ELSE watch_duration_seconds END AS watch_duration_seconds,
         CASE WHEN copy = 2 THEN event_timestamp + INTERVAL 1 HOUR ELSE event_timestamp END AS event_timestamp,
         event_id * 4 + copy AS ingest_seq
  FROM dirty0),
validated0 AS (
  SELECT schema_name, event_id, event_type, user_id, content_id,
         nullif(trim(session_id), '') AS session_id, nullif(lower(trim(topic)), '') AS topic,
         CAST(coalesce(watch_duration_seconds, 0) AS INTEGER) AS watch_duration_seconds, event_timestamp, ingest_seq,
         length(trim(topic)) AS _tl, length(trim(session_id)) AS _sl
  FROM dirty),
validated AS (
  SELECT * EXCLUDE (_tl, _sl),
         concat_ws(';',
           CASE WHEN schema_name <> '{C.INTERACTION_SCHEMA_NAME}' THEN 'schema_name_invalid' END,
           CASE WHEN event_id IS NULL THEN 'event_id_invalid' END,
           CASE WHEN user_id IS NULL THEN 'user_id_invalid' END,
           CASE WHEN content_id IS NULL THEN 'content_id_invalid' END,
           CASE WHEN event_type IS NULL OR event_type NOT IN ({", ".join(f"'{e}'" for e in C.EVENT_TYPES)}) THEN 'event_type_unknown' END,
           CASE WHEN NOT (watch_duration_seconds BETWEEN 0 AND {C.MAX_WATCH_SECONDS}) THEN 'watch_duration_out_of_range' END,
           CASE WHEN _sl > {C.MAX_SESSION_CHARS} THEN 'session_id_too_long' END,
           CASE WHEN _tl > {C.MAX_TOPIC_CHARS} THEN 'topic_too_long' END,
           CASE WHEN event_type = 'watch_complete' AND watch_duration_seconds <= 0 THEN 'watch_complete_without_duration' END,
           CASE WHEN topic IS NOT NULL AND topic NOT IN {T_IN} THEN 'topic_unsupported' END,
           CASE WHEN event_timestamp IS NULL THEN 'event_timestamp_missing' END) AS errors
  FROM validated0)"""


def tags_list_sql() -> str:
    defaults = "CASE category " + " ".join(
        f"WHEN '{c}' THEN [{', '.join(repr(t) for t in tl)}]" for c, tl in C.CATEGORY_DEFAULT_TAGS.items()
    ) + " ELSE [] END"
    kws = "[" + ", ".join(f"CASE WHEN contains(lower(title), '{k}') THEN '{t}' END" for k, t in C.KEYWORD_TAGS) + "]"
    return f"list_concat({defaults}, list_filter({kws}, lambda x: x IS NOT NULL))"


CONTENT_TAGS = f"""
tag_raw AS (SELECT content_id, {tags_list_sql()} AS l FROM content),
content_tags AS (SELECT content_id, list_filter(l, lambda x, i: list_position(l, x) = i) AS tags FROM tag_raw)"""


def page_items(limit: int = C.PAGE_DEFAULT_LIMIT) -> str:
    return f"\npage AS (SELECT * FROM ranked WHERE rank <= {limit})"


def _ops_log() -> str:
    pick = lambda names, by: "[" + ", ".join(f"'{n}'" for n in names) + f"][({by}) % {len(names)} + 1]"
    return f"""
oplog AS (
  SELECT ts, {pick(SERVICES, 'event_id')} AS service, {pick(OPERATIONS, 'event_id // 3')} AS operation,
         {pick(LOG_TOPICS, 'event_id // 7')} AS topic,
         CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS outcome,
         value / CAST(100.0 AS DOUBLE) AS duration_seconds
  FROM events)"""


def _bucket(seconds: int) -> str:
    return f"make_timestamp(CAST(floor(epoch_us(ts) / {seconds * 1_000_000}) * {seconds * 1_000_000} AS BIGINT))"


def hist_sql() -> str:
    bounds = list(C.LATENCY_BUCKETS)
    idx = "CASE " + " ".join(f"WHEN duration_seconds <= {dbl(b)} THEN {i}" for i, b in enumerate(bounds)) + f" ELSE {len(bounds)} END"
    les = "[" + ", ".join(dbl(b) for b in bounds) + ", CAST('inf' AS DOUBLE)]"
    return with_(_ops_log()) + f"""
, per AS (SELECT service, {idx} AS _i, count(*) AS _n FROM oplog GROUP BY ALL),
grid AS (SELECT s.service, g.i AS _i FROM (SELECT DISTINCT service FROM oplog) s CROSS JOIN range(0, {len(bounds) + 1}) g(i)),
cum AS (
  SELECT g.service, ({les})[g._i + 1] AS le,
         sum(coalesce(p._n, 0)) OVER (PARTITION BY g.service ORDER BY g._i) AS cnt
  FROM grid g LEFT JOIN per p USING (service, _i)),
b AS (
  SELECT *, coalesce(lag(le) OVER (PARTITION BY service ORDER BY le), {dbl(0)}) AS prev_le,
         coalesce(lag(cnt) OVER (PARTITION BY service ORDER BY le), 0) AS prev_n,
         max(cnt) OVER (PARTITION BY service) AS total,
         max(CASE WHEN le <> CAST('inf' AS DOUBLE) THEN le END) OVER (PARTITION BY service) AS max_finite
  FROM cum)
SELECT service,
       round(CASE WHEN le = CAST('inf' AS DOUBLE) THEN max_finite
            ELSE prev_le + (le - prev_le) * CASE WHEN cnt > prev_n THEN ({dbl(0.95)} * total - prev_n) / (cnt - prev_n) ELSE {dbl(0)} END END, 6)
         AS quantile_seconds
FROM b WHERE cnt >= {dbl(0.95)} * total AND total > 0
QUALIFY row_number() OVER (PARTITION BY service ORDER BY le) = 1"""


def _feed(tail: str, extra: list[str] | None = None) -> str:
    return with_(*feed_ctes(), *(extra or [])) + tail


def _build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["content_features"] = with_(INTERACTIONS, content_features_cte(C.FEATURE_WINDOW_HOURS)) + "SELECT * FROM cf"
    q["content_features_30d"] = with_(INTERACTIONS, content_features_cte(C.FEATURE_WINDOW_MAX_HOURS)) + "SELECT * FROM cf"
    rates = ("ctr", "like_rate", "save_rate", "skip_rate", "completion_rate")
    wrong = ", ".join(f"CASE WHEN {r} < 0 OR {r} > 1 THEN '{r}_out_of_range' END" for r in rates)
    q["content_feature_validation"] = with_(INTERACTIONS, content_features_cte(C.FEATURE_WINDOW_HOURS)) + (
        f"SELECT content_id, {METRICS}, concat_ws(';', {wrong}) AS errors FROM cf"
    )
    q["content_features_strict"] = with_(INTERACTIONS, content_features_cte(C.FEATURE_WINDOW_HOURS)) + (
        f"SELECT * EXCLUDE (rate_out_of_bounds) FROM cf WHERE {' AND '.join(f'{r} BETWEEN 0 AND 1' for r in rates)}"
    )
    q["user_topic_affinity"] = with_(INTERACTIONS, user_topic_cte(C.FEATURE_WINDOW_HOURS)) + "SELECT * FROM ut"
    q["user_topic_affinity_30d"] = with_(INTERACTIONS, user_topic_cte(C.FEATURE_WINDOW_MAX_HOURS)) + "SELECT * FROM ut"
    w_us = C.FEATURE_WINDOW_HOURS * 3_600_000_000
    pit = ", ".join(
        f"CAST(sum(CASE WHEN event_type = '{et}' THEN 1 ELSE 0 END) OVER w AS BIGINT) AS {m}" for et, m in C.METRIC_FOR_EVENT.items()
    )
    q["point_in_time_features"] = with_(INTERACTIONS) + f"""
SELECT event_id, content_id, event_type, event_timestamp, {pit}
FROM interactions
WINDOW w AS (PARTITION BY content_id ORDER BY epoch_us(event_timestamp) RANGE BETWEEN {w_us - 1} PRECEDING AND CURRENT ROW)"""
    snap_src = f"""
snap_events AS (
  SELECT *, CASE WHEN event_timestamp = date_trunc('day', event_timestamp) THEN event_timestamp
                 ELSE date_trunc('day', event_timestamp) + INTERVAL 1 DAY END AS snapshot_at
  FROM interactions),
snap_counts AS (
  SELECT content_id, snapshot_at, {counts_sql()}, max(event_timestamp) AS last_event_at,
         arg_max(topic, event_timestamp) FILTER (WHERE topic IS NOT NULL) AS topic
  FROM snap_events GROUP BY content_id, snapshot_at),
latest AS (
  SELECT * FROM snap_counts WHERE snapshot_at <= TIMESTAMP '2024-01-20 12:00:00'
  QUALIFY row_number() OVER (PARTITION BY content_id ORDER BY snapshot_at DESC) = 1)"""
    q["daily_snapshot_as_of"] = with_(INTERACTIONS, snap_src) + f"""
SELECT content_id, snapshot_at, topic, {C.FEATURE_WINDOW_HOURS} AS window_hours, {METRICS},
       {rate('clicks', 'impressions')} AS ctr, {rate('likes', 'clicks')} AS like_rate, {rate('saves', 'clicks')} AS save_rate,
       {rate('skip_count', 'impressions')} AS skip_rate, {rate('watch_completes', 'watch_starts')} AS completion_rate,
       {trending('snapshot_at', C.FEATURE_WINDOW_HOURS)} AS trending_score, last_event_at
FROM latest"""
    q["experiment_assignments"] = with_(USERS, assignment_cte("users")) + "SELECT * FROM assignments"
    q["exposure_items"] = with_(INTERACTIONS, EXPOSURES) + """
SELECT i.exposure_id, i.item_id, i.user_id, i.content_id, i.generated_at, h.variant_key, h.strategy_name
FROM items i JOIN header h USING (exposure_id)"""
    q["attributed_outcomes"] = with_(INTERACTIONS, EXPOSURES) + """
, it AS (
  SELECT i.item_id, i.exposure_id, i.content_id, h.user_id, h.generated_at, h.variant_key, h.strategy_name
  FROM items i JOIN header h USING (exposure_id))
SELECT o.event_id, o.user_id, o.content_id, o.event_type, o.event_timestamp,
       e.item_id, e.exposure_id, e.generated_at, e.variant_key, e.strategy_name
FROM outcomes o ASOF JOIN it e
  ON o.user_id = e.user_id AND o.content_id = e.content_id AND o.event_timestamp >= e.generated_at"""
    q["experiment_comparison"] = with_(INTERACTIONS, EXPOSURES, comparison_ctes(C.FEATURE_WINDOW_MAX_HOURS)) + "SELECT * FROM comparison"
    q["experiment_comparison_7d"] = with_(INTERACTIONS, EXPOSURES, comparison_ctes(C.ANALYTICS_LOOKBACK_HOURS)) + "SELECT * FROM comparison"
    metrics = ("ctr", "save_rate", "completion_rate")
    unpivot = " UNION ALL ".join(
        f"SELECT variant_key, strategy_name, exposure_requests, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM comparison" for m in metrics
    )
    q["best_strategy"] = with_(INTERACTIONS, EXPOSURES, comparison_ctes(C.FEATURE_WINDOW_MAX_HOURS)) + f"""
, stacked AS ({unpivot})
SELECT metric, variant_key, strategy_name, value, CAST(sum(exposure_requests) OVER (PARTITION BY metric) AS BIGINT) AS total_exposure_requests
FROM stacked
QUALIFY row_number() OVER (PARTITION BY metric ORDER BY value DESC, variant_key, strategy_name) = 1"""
    q["effective_affinity"] = _feed("SELECT user_id, topic, affinity, topic_rank FROM eff_top")
    q["candidate_pool"] = _feed(
        "SELECT content_id, topic, category, published_at, in_recent, in_trending, in_topic, trending_score FROM pool_f"
    )
    q["feed_candidates"] = _feed(
        "SELECT user_id, content_id, topic, published_at, array_to_string(sources, ',') AS candidate_sources, "
        "user_topic_affinity, trending_score, completion_rate FROM ranked"
    )
    q["scored_candidates"] = _feed(
        "SELECT user_id, content_id, strategy_name, c_affinity AS affinity, c_recency AS recency, c_engagement AS engagement, "
        "c_trending AS trending, c_adjustment AS strategy_adjustment, base_score FROM ranked"
    )
    q["ranked_feed"] = _feed(f"SELECT {RANKED_COLS} FROM ranked")
    q["ranked_feed_no_diversity"] = _feed(f"SELECT {RANKED_COLS} FROM ranked_nd")
    cols = RANKED_COLS.replace("diversity_penalty, score, rank", "k.diversity_penalty, k.score, CAST(k.step AS INTEGER) AS rank")
    q["ranked_feed_general"] = with_(*feed_ctes(general_category=True), greedy_ctes()).replace("WITH ", "WITH RECURSIVE ", 1) + (
        f"SELECT {cols} FROM scored JOIN (SELECT user_id, content_id, diversity_penalty, score, step FROM picks WHERE step > 0) k "
        "USING (user_id, content_id)"
    )
    q["feed_pages"] = page_sql(0, C.PAGE_DEFAULT_LIMIT, True)
    q["feed_pages_second"] = page_sql(C.PAGE_DEFAULT_LIMIT, C.PAGE_DEFAULT_LIMIT, False)
    q["ranking_decisions"] = _feed(f"""
SELECT sha256(CAST(user_id AS VARCHAR) || '|' || '2024-01-31 00:00:00') AS decision_id,
       '{C.RANKING_DECISION_SCHEMA_NAME}' AS schema_name, user_id, any_value(strategy_name) AS strategy_name,
       count(*) AS candidate_count, CAST(count(*) AS INTEGER) AS ranked_count,
       arg_min(content_id, rank) AS top_content_id, arg_min(score, rank) AS top_score,
       {AS_OF} AS generated_at
FROM ranked GROUP BY user_id""")
    exp_id = "sha256(CAST(user_id AS VARCHAR) || '|' || '2024-01-31 00:00:00' || '|' || '0')"
    q["feed_exposure_items"] = _feed(f"""
SELECT {exp_id} || ':' || CAST(content_id AS VARCHAR) AS item_id, {exp_id} AS exposure_id, content_id, topic, category,
       rank, score, {AS_OF} AS created_at, user_id, variant_key, strategy_name
FROM ranked WHERE rank <= {C.PAGE_DEFAULT_LIMIT}""")
    q["feed_exposure_headers"] = _feed(f"""
SELECT {exp_id} AS exposure_id, any_value(experiment_key) AS experiment_key, any_value(variant_key) AS variant_key,
       any_value(strategy_name) AS strategy_name, user_id, {C.PAGE_DEFAULT_LIMIT} AS feed_limit, 0 AS feed_offset,
       'home-' || CAST(user_id AS VARCHAR) AS session_id,
       sha256('request|' || CAST(user_id AS VARCHAR) || '|2024-01-31 00:00:00|0') AS request_id,
       'home-feed' AS correlation_id, false AS cache_hit, {AS_OF} AS generated_at, {AS_OF} AS created_at
FROM ranked GROUP BY user_id""")
    q["exposure_validation"] = _feed(f"""
, stored AS (
  SELECT experiment_key, user_id,
         CASE WHEN user_id % 7 = 0 THEN CASE WHEN variant_key = 'control' THEN 'trending_boost' ELSE 'control' END ELSE variant_key END AS a_variant,
         CASE WHEN user_id % 7 = 0 THEN CASE WHEN strategy_name = '{C.RULES_V1}' THEN '{C.RULES_V2}' ELSE '{C.RULES_V1}' END ELSE strategy_name END AS a_strategy
  FROM assignments WHERE user_id % 11 <> 0),
hdr AS (
  SELECT {exp_id} AS exposure_id, user_id, any_value(experiment_key) AS experiment_key, any_value(variant_key) AS variant_key,
         any_value(strategy_name) AS strategy_name
  FROM ranked GROUP BY user_id)
SELECT h.exposure_id, h.user_id, h.variant_key, h.strategy_name, 20 AS feed_limit, 0 AS feed_offset, {AS_OF} AS generated_at,
       concat_ws(';',
         CASE WHEN s.a_variant IS NULL THEN 'assignment_missing' END,
         CASE WHEN s.a_variant IS NOT NULL AND s.a_variant <> h.variant_key THEN 'variant_mismatch' END,
         CASE WHEN s.a_strategy IS NOT NULL AND s.a_strategy <> h.strategy_name THEN 'strategy_mismatch' END) AS errors
FROM hdr h LEFT JOIN stored s ON s.experiment_key = h.experiment_key AND s.user_id = h.user_id""")
    q["stream_replay_features"] = with_(INTERACTIONS, content_features_cte(C.FEATURE_WINDOW_HOURS)) + f"""
SELECT printf('00000000-0000-0000-0000-%012d', content_id) AS content_id, topic, {METRICS},
       ctr, like_rate, save_rate, skip_rate, completion_rate, trending_score, last_event_at
FROM cf"""
    q["interaction_validation"] = with_(INTERACTIONS, DIRTY) + (
        "SELECT event_id, ingest_seq, event_type, topic, session_id, errors FROM validated"
    )
    q["dead_letters"] = with_(INTERACTIONS, DIRTY) + """
SELECT event_id, ingest_seq, 'validation_error' AS error_type, replace(errors, ';', '; ') AS error_message,
       1 AS attempts, 'feature-processor' AS failed_service
FROM validated WHERE errors <> ''"""
    q["deduplicated_interactions"] = with_(INTERACTIONS, DIRTY) + """
SELECT event_id, ingest_seq, event_type, topic, event_timestamp FROM validated WHERE errors = ''
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingest_seq) = 1"""
    q["idempotent_counts"] = with_(
        INTERACTIONS,
        DIRTY,
        """
latest_ev AS (
  SELECT * FROM validated WHERE errors = ''
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingest_seq DESC) = 1)""",
        content_features_cte(C.FEATURE_WINDOW_MAX_HOURS, "cf", "latest_ev"),
    ) + "SELECT * FROM cf"
    uuid = lambda c: f"printf('00000000-0000-0000-0000-%012d', {c})"
    q["stream_dirty_features"] = with_(
        INTERACTIONS, DIRTY, """
latest_ev AS (
  SELECT * FROM validated WHERE errors = ''
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingest_seq DESC) = 1)""",
        content_features_cte(C.FEATURE_WINDOW_HOURS, "cf", "latest_ev"),
    ) + f"""
SELECT {uuid('content_id')} AS content_id, topic, {METRICS},
       ctr, like_rate, save_rate, skip_rate, completion_rate, trending_score, last_event_at
FROM cf"""
    q["stream_dead_letters"] = with_(INTERACTIONS, DIRTY) + f"""
SELECT {uuid('event_id')} AS event_id, 'validation_error' AS error_type, replace(errors, ';', '; ') AS error_message,
       'interactions.events.v1' AS source_topic, CAST(user_id % 4 AS INTEGER) AS source_partition, ingest_seq AS source_offset,
       CAST(user_id AS VARCHAR) AS source_key, concat('r', CAST(event_id AS VARCHAR)) AS request_id, 1 AS attempts
FROM validated WHERE errors <> ''"""
    q["stream_audit"] = with_(INTERACTIONS, DIRTY) + f"""
SELECT {uuid('event_id')} AS event_id, event_type, {uuid('user_id')} AS user_id, {uuid('content_id')} AS content_id, topic, event_timestamp
FROM validated WHERE errors = ''
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingest_seq) = 1"""
    q["stream_continuous_features"] = q["stream_dirty_features"].replace(f"SELECT {uuid('content_id')} AS content_id", "SELECT content_id").replace(
        "last_event_at\nFROM cf", "last_event_at, true AS last_exact\nFROM cf"
    )
    q["stream_moving_window"] = q["stream_replay_features"]
    q["stream_flushes"] = with_(INTERACTIONS, DIRTY, """
arrived AS (
  SELECT *, event_id % 2 + CASE WHEN ingest_seq > event_id * 4 THEN 1 ELSE 0 END AS batch_id, user_id % 4 AS part FROM validated),
flushed AS (
  SELECT batch_id, count(*) FILTER (WHERE errors = '') AS processed, count(*) FILTER (WHERE errors <> '') AS failed,
         count(DISTINCT content_id) FILTER (WHERE errors = '') AS content_keys, count(DISTINCT user_id) FILTER (WHERE errors = '') AS user_keys,
         max(event_timestamp) FILTER (WHERE errors = '') AS last_processed_at
  FROM arrived GROUP BY batch_id),
ends AS (SELECT part, min(ingest_seq) AS low, max(ingest_seq) AS high FROM arrived GROUP BY part),
waiting AS (
  SELECT f.batch_id, e.part, greatest(e.high - coalesce(max(a.ingest_seq), e.low), 0) AS lag
  FROM flushed f CROSS JOIN ends e LEFT JOIN arrived a ON a.part = e.part AND a.batch_id <= f.batch_id
  GROUP BY f.batch_id, e.part, e.high, e.low)""") + f"""
SELECT CAST(f.batch_id AS INTEGER) AS batch_id, processed, failed, content_keys, user_keys, last_processed_at, {AS_OF} AS flushed_at, max(lag) AS most_lag
FROM flushed f JOIN waiting w USING (batch_id) GROUP BY ALL"""
    days = [f"({AS_OF} - INTERVAL {d} DAY)" for d in (2, 1, 0)]
    q["versioned_features"] = with_(INTERACTIONS, *[content_features_cte(C.FEATURE_WINDOW_HOURS, f"cf{i}", as_of=t) for i, t in enumerate(days)]) + f"""
, parts AS ({" UNION ALL ".join(f"SELECT {i} AS part, *, {t} AS updated_at FROM cf{i}" for i, t in enumerate(days))}),
both_reads AS (SELECT 'before' AS read, * FROM parts WHERE part < 2 UNION ALL SELECT 'after' AS read, * FROM parts)
SELECT read, content_id, topic, {METRICS}, trending_score, updated_at FROM both_reads
QUALIFY row_number() OVER (PARTITION BY read, content_id ORDER BY updated_at DESC) = 1"""
    q["duplicate_event_report"] = with_(INTERACTIONS, DIRTY) + """
SELECT event_id, count(*) AS occurrences, 'duplicate_in_batch' AS violation, 'event_id' AS field
FROM dirty GROUP BY event_id HAVING count(*) > 1"""
    def maps(fixture, bad_score: str) -> str:
        rows = ", ".join(f"({i}, '{k}', CAST({v} AS DOUBLE))" for i, pairs in enumerate(fixture) for k, v in pairs)
        return with_(USERS) + f"""
, entries AS (SELECT d, lower(trim(k)) AS k, v FROM (VALUES {rows}) t(d, k, v))
SELECT user_id, string_agg(k, ',' ORDER BY k) AS topics,
       concat_ws(';', CASE WHEN bool_or(k NOT IN {T_IN}) THEN 'topic_unsupported' END,
                 CASE WHEN bool_or(v IS NULL OR {bad_score}) THEN '{"score_not_finite" if "isnan" in bad_score else "score_out_of_range"}' END) AS errors
FROM users JOIN entries ON d = user_id % {len(fixture)} GROUP BY user_id"""

    from .registry import AFFINITY_FIXTURE, PREFERENCE_FIXTURE

    q["preference_validation"] = maps(PREFERENCE_FIXTURE, "v < 0 OR v > 1")
    q["affinity_validation"] = maps(AFFINITY_FIXTURE, "isnan(v) OR isinf(v)")
    q["content_validation"] = f"""
WITH raw AS (
  SELECT p_partkey AS content_id,
         trim(CASE p_partkey % 7 WHEN 0 THEN '  ab  ' WHEN 1 THEN repeat('long ', 101) ELSE concat(' ', p_name, ' ') END) AS title,
         nullif(trim(CASE p_partkey % 11 WHEN 0 THEN repeat('x', 2001) WHEN 1 THEN '   ' ELSE 'text' END), '') AS description,
         lower(trim(CASE p_partkey % 13 WHEN 0 THEN NULL WHEN 1 THEN repeat('t', 101) ELSE ' AI ' END)) AS topic,
         CASE WHEN p_partkey % 5 = 0 THEN 'sports' ELSE 'ai' END AS category,
         coalesce(CASE p_partkey % 9 WHEN 0 THEN 'gone' WHEN 1 THEN NULL ELSE 'published' END, 'draft') AS status
  FROM part)
SELECT content_id, CAST(length(title) AS INTEGER) AS title_chars, description IS NULL AS no_description, topic, status,
       concat_ws(';',
         CASE WHEN NOT (length(title) BETWEEN 5 AND 500) THEN 'title_length' END,
         CASE WHEN length(description) > 2000 THEN 'description_too_long' END,
         CASE WHEN topic IS NULL OR length(topic) > 100 THEN 'topic_invalid' END,
         CASE WHEN category NOT IN {T_IN} THEN 'category_unknown' END,
         CASE WHEN status NOT IN ('draft', 'published') THEN 'status_unknown' END) AS errors
FROM raw"""
    q["tag_validation"] = """
WITH raw AS (
  SELECT p_partkey AS tag_id,
         lower(trim(CASE p_partkey % 4 WHEN 0 THEN '   ' WHEN 1 THEN repeat('n', 256) ELSE concat('  ', upper(p_name)) END)) AS name
  FROM part)
SELECT tag_id, name, concat_ws(';', CASE WHEN NOT (length(name) BETWEEN 1 AND 255) THEN 'name_length' END,
                               CASE WHEN tag_id % 6 = 0 THEN 'description_too_long' END) AS errors
FROM raw"""
    q["candidate_validation"] = """
SELECT p_partkey AS content_id, 'trending,recent' AS candidate_sources,
       concat_ws(';',
         CASE WHEN p_partkey % 19 = 0 THEN 'features_of_another_item' END,
         CASE WHEN p_partkey % 10 IN (0, 1) THEN 'title_length' END,
         CASE WHEN p_partkey % 13 > 10 THEN 'affinity_out_of_range' END,
         CASE WHEN p_partkey % 17 = 0 THEN 'topic_empty' END) AS errors
FROM part"""
    q["publish_outbox"] = f"""
SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN ts WHEN event_id % 6 = 0 THEN {AS_OF} END AS published_at,
       event_id % 3 = 0 AND event_id % 6 <> 0 AS pending
FROM events"""
    q["keyed_records"] = with_(INTERACTIONS) + """
SELECT CAST(user_id AS VARCHAR) AS key,
       concat('{"content_id":', content_id, ',"event_id":', event_id, ',"event_type":"', event_type, '","topic":"', topic,
              '","user_id":', user_id, '}') AS value
FROM interactions"""
    pivot = ", ".join(f"max(affinity_score) FILTER (topic = '{t}') AS {t.replace('-', '_')}" for t in C.TOPICS)
    q["affinity_map_read"] = with_(INTERACTIONS, user_topic_cte(C.FEATURE_WINDOW_HOURS)) + (
        f"SELECT user_id, CAST(count(*) AS INTEGER) AS n_topics, {pivot} FROM ut GROUP BY user_id"
    )
    q["tag_resolution"] = with_(content_cte(), CONTENT_TAGS) + """
, names AS (SELECT DISTINCT unnest(tags) AS name FROM content_tags),
asked AS (
  SELECT content_id, min(pos) AS pos, name
  FROM (SELECT content_id, unnest([1, 2, 3, 4]) AS pos, unnest(['llm', 'none-' || CAST(content_id % 5 AS VARCHAR), topic, 'llm']) AS name FROM content)
  GROUP BY content_id, name)
SELECT a.content_id AS request_id, coalesce(string_agg(n.name, ',' ORDER BY pos), '') AS names,
       CAST(count(*) FILTER (n.name IS NULL) AS INTEGER) AS unknown
FROM asked a LEFT JOIN names n USING (name) GROUP BY a.content_id"""
    q["content_intake"] = with_(content_cte()) + f"""
, raw AS (
  SELECT content_id + 10000000 AS content_id,
         CASE WHEN content_id % 4 = 0 THEN title WHEN content_id % 4 = 1 THEN concat('repeated ', CAST(content_id // 40 AS VARCHAR))
              ELSE concat('fresh item ', CAST(content_id AS VARCHAR)) END AS title
  FROM content),
checked AS (
  SELECT *, concat_ws(';', CASE WHEN count(*) OVER (PARTITION BY title) > 1 THEN 'title_duplicate' END,
                      CASE WHEN title IN (SELECT title FROM content) THEN 'title_exists' END) AS errors
  FROM raw)
SELECT content_id, title, CASE WHEN errors = '' THEN {AS_OF} END AS published_at, errors FROM checked"""
    q["direct_attribution"] = with_(INTERACTIONS, EXPOSURES) + """
SELECT o.event_id, o.event_type, e.exposure_id, e.item_id
FROM outcomes o ASOF JOIN items e
  ON o.user_id = e.user_id AND o.content_id = e.content_id AND o.event_timestamp >= e.generated_at
WHERE o.event_id % 2 = 0"""
    q["feed_page_cache"] = _feed(f"""
SELECT user_id, any_value(experiment_key) AS experiment_key, any_value(variant_key) AS variant_key, count(*) AS total_candidates,
       {AS_OF} AS generated_at, {AS_OF} + INTERVAL {C.FEED_CACHE_TTL_SECONDS} SECOND AS expires_at
FROM ranked WHERE user_id % 5 <> 0 GROUP BY user_id""")
    order = _recency_order()
    q["content_listing"] = with_(content_cte()) + f"""
, f AS (SELECT * FROM content WHERE category = 'backend' AND status = 'published')
SELECT *, (SELECT count(DISTINCT content_id) FROM f) AS total FROM f ORDER BY {order} LIMIT 20 OFFSET 0"""
    q["content_listing_by_tag"] = with_(content_cte(), CONTENT_TAGS) + f"""
, f AS (SELECT c.* FROM content c WHERE content_id IN (SELECT content_id FROM content_tags WHERE list_contains(tags, 'llm')))
SELECT *, (SELECT count(DISTINCT content_id) FROM f) AS total FROM f ORDER BY {order} LIMIT 50 OFFSET 10"""
    q["content_tags"] = with_(content_cte(), CONTENT_TAGS) + "SELECT content_id, array_to_string(tags, ',') AS tags FROM content_tags"
    q["tag_listing"] = with_(content_cte(), CONTENT_TAGS) + """
, names AS (SELECT DISTINCT unnest(tags) AS name FROM content_tags)
SELECT substr(sha256(name), 1, 32) AS tag_id, name FROM names ORDER BY name LIMIT 100"""
    q["user_validation"] = with_(USERS) + f"""
, acc AS (
  SELECT c.c_custkey AS user_id, c.c_name AS username,
         lower(replace(c.c_name, '#', '_')) || '@' || lower(c.c_mktsegment) || '.example' AS email
  FROM customer c)
SELECT user_id, trim(username) AS username, lower(trim(email)) AS email,
       concat_ws(';',
         CASE WHEN NOT regexp_matches(trim(username), '{C.USERNAME_PATTERN}') THEN 'username_invalid' END,
         CASE WHEN NOT regexp_matches(lower(trim(email)), '{C.EMAIL_PATTERN}') THEN 'email_invalid' END) AS errors
FROM acc"""
    q["user_listing"] = f"""
WITH acc AS (
  SELECT c_custkey AS user_id, lower(replace(c_name, '#', '_')) AS username,
         {AS_OF} - to_hours(CAST(c_custkey * 97 % 8760 + 1 AS BIGINT)) AS created_at
  FROM customer)
SELECT user_id, username, created_at, user_id % 10 <> 9 AS has_profile,
       CAST(CASE WHEN user_id % 10 <> 9 THEN 5 ELSE 0 END AS INTEGER) AS n_preferences
FROM acc ORDER BY created_at DESC, CAST(user_id AS VARCHAR) DESC LIMIT 100"""
    q["content_lookup"] = with_(INTERACTIONS, content_cte()) + f"""
SELECT * FROM content WHERE content_id IN (
  SELECT content_id FROM interactions WHERE event_type = 'click' AND {window_filter(24)})"""
    q["catalog_after_patches"] = with_(content_cte()) + f"""
, patched AS (
  SELECT content_id, CASE WHEN content_id % 25 = 3 THEN upper(title) ELSE title END AS title,
         CASE WHEN content_id % 16 = 0 THEN 'published' WHEN content_id % 10 = 1 THEN 'draft' ELSE status END AS status,
         published_at
  FROM content)
SELECT content_id, title, status,
       CASE WHEN status = 'draft' THEN NULL WHEN status = 'published' AND published_at IS NULL THEN {AS_OF} ELSE published_at END AS published_at
FROM patched"""
    q["catalog_after_purge"] = with_(content_cte(), CONTENT_TAGS) + """
SELECT c.content_id, c.title, CAST(len(t.tags) AS BIGINT) AS n_tags
FROM content c JOIN content_tags t USING (content_id)
WHERE NOT (c.content_id % 97 = 0 OR c.content_id % 89 = 0)"""
    q["content_with_tags"] = with_(content_cte(), CONTENT_TAGS) + """
SELECT content_id, CAST(len(tags) AS INTEGER) AS n_tags, array_to_string(list_sort(tags), ',') AS tag_names FROM content_tags"""
    q["assignment_get_or_create"] = with_(USERS, assignment_cte("users")) + f"""
SELECT user_id, experiment_key,
       CASE WHEN user_id % 3 = 0 THEN -1 ELSE assignment_bucket END AS assignment_bucket,
       CASE WHEN user_id % 3 = 0 THEN 'trending_boost' ELSE variant_key END AS variant_key,
       CASE WHEN user_id % 3 = 0 THEN '{C.RULES_V2}' ELSE strategy_name END AS strategy_name,
       CASE WHEN user_id % 3 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' ELSE {AS_OF} END AS assigned_at
FROM assignments"""
    q["consumer_lag"] = """
SELECT 'interactions.events.v1' AS topic, CAST(user_id % 4 AS INTEGER) AS partition,
       CAST(greatest(count(*) - count_if(ts <= TIMESTAMP '2024-01-30 00:00:00'), 0) AS BIGINT) AS lag
FROM events GROUP BY ALL"""
    q["service_availability"] = with_(_ops_log()) + f"""
SELECT service, max(ts) AS last_seen,
       CAST(epoch_us({AS_OF}) - epoch_us(max(ts)) AS DOUBLE) / {dbl(1_000_000)} <= 300 AS up
FROM oplog GROUP BY service"""
    page = page_items()
    q["observed_affinity"] = _feed(
        """
SELECT u.user_id, t.topic, CAST(t.i - 1 AS INTEGER) AS topic_order, coalesce(a.v, CAST(0.0 AS DOUBLE)) AS observed_affinity
FROM (SELECT DISTINCT user_id FROM page) u CROSS JOIN topics t
LEFT JOIN (SELECT user_id, topic, round(avg(user_topic_affinity), 10) AS v FROM page GROUP BY ALL) a
  ON a.user_id = u.user_id AND a.topic = t.topic""",
        [page],
    )
    q["trending_rows"] = _feed(
        """
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY trending_score DESC, rank) AS INTEGER) AS position,
       content_id, trending_score, rank
FROM page QUALIFY position <= 8""",
        [page],
    )
    q["category_distribution"] = with_(content_cte()) + "SELECT category, count(*) AS value FROM content GROUP BY category"
    q["feed_summary"] = _feed(
        f"""
, lead AS (
  SELECT user_id, topic AS leading_topic FROM (
    SELECT user_id, topic, count(*) AS n, list_position({T}, topic) AS o FROM page GROUP BY ALL) x
  WHERE o > 0 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, o ASC) = 1)
SELECT s.*, l.leading_topic FROM (
  SELECT user_id, count(*) AS total_items, round(avg(score), 10) AS average_score,
         round(avg(trending_score), 10) AS average_trending, round(avg(completion_rate), 10) AS average_completion
  FROM page GROUP BY user_id) s LEFT JOIN lead l USING (user_id)""",
        [page],
    )
    q["session_event_types"] = with_(INTERACTIONS) + (
        "SELECT session_id, event_type, count(*) AS value FROM interactions GROUP BY session_id, event_type"
    )
    q["page_topic_mix"] = _feed("SELECT user_id, topic, count(*) AS items FROM page GROUP BY user_id, topic", [page])
    q["page_source_mix"] = _feed(
        "SELECT user_id, source, count(*) AS items FROM (SELECT user_id, unnest(sources) AS source FROM page) GROUP BY ALL",
        [page],
    )
    q["score_bands"] = _feed(
        "SELECT user_id, rank, content_id, score, completion_rate * CAST(100.0 AS DOUBLE) AS completion_percent, impressions "
        "FROM ranked WHERE rank <= 6"
    )
    q["engagement_percent"] = _feed(
        "SELECT user_id, content_id, " + ", ".join(
            f"{c} * CAST(100.0 AS DOUBLE) AS {c}_percent" for c in ("ctr", "like_rate", "save_rate", "completion_rate", "skip_rate")
        ) + " FROM page",
        [page],
    )
    comps = " UNION ALL ".join(
        f"SELECT user_id, content_id, '{n}' AS component, c_{c} AS raw, w_{c} AS weighted FROM page"
        for n, c in (("user_topic_affinity", "affinity"), ("recency", "recency"), ("engagement", "engagement"), ("trending", "trending"))
    )
    q["score_breakdown_long"] = _feed(comps, [page])
    q["action_state"] = with_(INTERACTIONS) + """
SELECT user_id, content_id, bool_or(event_type = 'click') AS clicked, bool_or(event_type = 'like') AS liked,
       bool_or(event_type = 'save') AS saved
FROM interactions GROUP BY user_id, content_id"""
    q["page_without_dismissed"] = _feed(
        """
SELECT user_id, content_id, rank, CAST(row_number() OVER (PARTITION BY user_id ORDER BY rank) AS INTEGER) AS position
FROM page p
WHERE NOT EXISTS (SELECT 1 FROM interactions i WHERE i.event_type = 'skip' AND i.user_id = p.user_id AND i.content_id = p.content_id)""",
        [page],
    )
    q["recent_session_events"] = with_(INTERACTIONS) + """
SELECT session_id, event_id, event_type, content_id, event_timestamp,
       CAST(row_number() OVER (PARTITION BY session_id ORDER BY event_timestamp DESC, event_id DESC) AS INTEGER) AS position
FROM interactions QUALIFY position <= 10"""
    b5 = _bucket(300)
    q["event_rate_5m"] = with_(_ops_log()) + f"""
SELECT {b5} AS window_start, {b5} + INTERVAL 5 MINUTE AS window_end, service, topic, outcome, count(*) AS events,
       count(*) / CAST(300.0 AS DOUBLE) AS rate_per_second
FROM oplog GROUP BY ALL"""
    q["event_rate_5m_sliding"] = with_(_ops_log()) + """
, w AS (
  SELECT date_trunc('minute', ts) - to_minutes(k) AS window_start, service, outcome
  FROM oplog, range(0, 5) r(k))
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, service, outcome, count(*) AS events,
       count(*) / CAST(300.0 AS DOUBLE) AS rate_per_second
FROM w GROUP BY ALL"""
    b15 = _bucket(900)
    q["event_increase_15m"] = with_(_ops_log()) + f"SELECT {b15} AS window_start, outcome, count(*) AS increase FROM oplog GROUP BY ALL"
    q["latency_p95"] = with_(_ops_log()) + """
SELECT service, outcome, round(quantile_cont(duration_seconds, 0.95), 6) AS p95_seconds, count(*) AS samples FROM oplog GROUP BY ALL"""
    q["latency_histogram_p95"] = hist_sql()
    q["processor_freshness"] = with_(INTERACTIONS, DIRTY) + """
SELECT count(*) FILTER (WHERE errors = '') AS processed, count(*) FILTER (WHERE errors <> '') AS failed,
       max(event_timestamp) FILTER (WHERE errors = '') AS last_processed_at,
       count(DISTINCT content_id) FILTER (WHERE errors = '') AS content_keys,
       count(DISTINCT user_id) FILTER (WHERE errors = '') AS user_keys
FROM validated"""
    return q


ORACLE: dict[str, str] = _build()
