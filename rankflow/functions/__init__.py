"""Column expressions shared by the operators.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``,
so it stays inside whole-stage codegen. Rounding follows the specified
order of operations: each documented intermediate is rounded to 6 digits
before it is used further.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value: str | _dt.datetime) -> Column:
    """A UTC timestamp literal (session time zone is pinned to UTC)."""
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp(F.lit(value))


def micros(c: ColumnOrName) -> Column:
    """Epoch microseconds of a timestamp (NTZ columns are read as UTC)."""
    return F.unix_micros(col(c).cast("timestamp"))


def seconds_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(1_000_000.0)


def minus_hours(ts: ColumnOrName, hours: ColumnOrName) -> Column:
    """``ts - hours`` with long arithmetic (no int interval overflow)."""
    return F.timestamp_micros(micros(ts) - col(hours).cast("long") * F.lit(3_600_000_000))


_SPLIT = 134217729.0  # 2**27 + 1: Dekker's splitting constant for doubles


def _round6_sql(x: str, digits: int = 6) -> str:
    sc = f"{float(10**digits)!r}D"
    v = f"({x})"
    p = f"({v} * {sc})"
    c = f"({v} * {_SPLIT!r}D)"
    hi = f"({c} - ({c} - {v}))"
    err = f"((({hi} * {sc}) - {p}) + (({v} - {hi}) * {sc}))"
    tie = f"(({p} - floor({p})) = 0.5D)"
    return f"((CASE WHEN {tie} AND {err} != 0.0D THEN floor({p}) + (signum({err}) + 1.0D) / 2.0D ELSE rint({p}) END) / {sc})"


def round6(x: str | Column, digits: int = 6) -> Column:
    """Round a double to ``digits`` decimals exactly like Python's ``round``:
    the exact binary value, ties to even. (Spark's ``round`` rounds the
    shortest decimal form half up, which differs on values that print with
    a trailing 5.)

    ``p = fl(x * 10**digits)`` is within half an ulp of the exact product, so
    ``rint(p)`` is right unless ``p`` is exactly a half-integer; then the sign
    of the exact error (Dekker's two-product; the scale splits exactly)
    decides between floor and ceiling, and a zero error is a true tie that
    ``rint`` already breaks to even.

    ``x`` is a column name or a small SQL expression over columns (it occurs
    ~20 times in the formula; stage larger ones in a prior select). It is
    built as one SQL expression: a single call into the JVM."""
    if isinstance(x, Column):
        raise TypeError("round6 takes a column name or SQL expression text")
    return F.expr(_round6_sql(x, digits))


def sql_double(v: float) -> str:
    """A double literal in Spark SQL text (plain ``0.7`` would be a DECIMAL)."""
    return f"{float(v)!r}D"


def ratio_sql(numerator: str, denominator: str) -> str:
    return f"(CASE WHEN ({denominator}) > 0 THEN CAST({numerator} AS DOUBLE) / CAST({denominator} AS DOUBLE) END)"


def ratio(numerator: str, denominator: str) -> Column:
    """Unrounded safe ratio of two SQL expressions (null when the
    denominator is not positive); stage it in a select and finish with
    ``rate_of``."""
    return F.expr(ratio_sql(numerator, denominator))


def rate_of_sql(ratio_col: str) -> str:
    return f"coalesce({_round6_sql(f'`{ratio_col}`')}, 0.0D)"


def rate_of(ratio_col: str) -> Column:
    """The staged ratio rounded to 6 digits, 0 when undefined."""
    return F.expr(rate_of_sql(ratio_col))


def rate(numerator: str, denominator: str) -> Column:
    """Safe ratio of two columns rounded to 6 digits in one expression. Only
    for final projections over few rows (the ratio is repeated inside the
    rounding); hot paths stage ``ratio`` and use ``rate_of``."""
    return F.when(F.col(denominator) > 0, round6(f"`{numerator}` / `{denominator}`")).otherwise(F.lit(0.0))


def clamp(x: ColumnOrName, lo: float = 0.0, hi: float = 1.0) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), col(x)))


def slug(c: ColumnOrName) -> Column:
    """trim + lower, empty -> null."""
    return F.nullif(F.lower(F.trim(col(c))), F.lit(""))


def blank_to_null(c: ColumnOrName) -> Column:
    """trim, empty -> null."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def weighted_sum_sql(weights: Mapping[str, float], prefix: str = "") -> str:
    """``sum(count * weight)`` as SQL text, in the weights' declared order
    (left-associative, so the float order is fixed)."""
    return "(" + " + ".join(f"CAST(`{prefix}{m}` AS DOUBLE) * {sql_double(w)}" for m, w in weights.items()) + ")"


def weighted_sum(weights: Mapping[str, float], prefix: str = "") -> Column:
    return F.expr(weighted_sum_sql(weights, prefix))


# quality-bonus ratios of the trending score: numerator, denominator, and
# whether the denominator is floored at 1
BONUS_RATIOS = {
    "_q_ctr": ("clicks", "impressions", False),
    "_q_blike": ("likes", "clicks", True),
    "_q_bsave": ("saves", "clicks", True),
    "_q_bcomp": ("watch_completes", "watch_starts", True),
}


def trending_ratios(p: str = "") -> list[Column]:
    """A9 stage 1: the four quality-bonus ratios (unrounded)."""
    out = []
    for k, (n, d, floor_one) in BONUS_RATIOS.items():
        den = f"greatest(`{p}{d}`, 1)" if floor_one else f"`{p}{d}`"
        out.append(ratio(f"`{p}{n}`", den).alias(p + k))
    return out


def trending_raw(p: str = "") -> Column:
    """A9 stage 2 (reads stage-1 ratio columns): the undecayed score."""
    b = C.TRENDING_BONUS
    bonus = (
        f"({rate_of_sql(p + '_q_ctr')} * {sql_double(b['ctr'])}"
        f" + {rate_of_sql(p + '_q_blike')} * {sql_double(b['like'])}"
        f" + {rate_of_sql(p + '_q_bsave')} * {sql_double(b['save'])}"
        f" + {rate_of_sql(p + '_q_bcomp')} * {sql_double(b['completion'])})"
    )
    return F.expr(f"greatest({weighted_sum_sql(C.TRENDING_WEIGHTS, p)} + {bonus}, 0.0D)")


def trending_decay(now: Column, window_hours: int, last_event_col: str = "last_event_at") -> Column:
    age = F.greatest(seconds_between(now, F.col(last_event_col)), F.lit(0.0))
    return F.exp(-age / F.lit(float(max(window_hours * 3600, 1))))


def trending_from(raw_col: str, decay_col: str, last_event_col: str = "last_event_at") -> Column:
    """A9 stage 3: decayed trending score from staged parts; no decay when
    there is no last event."""
    return F.when(F.col(last_event_col).isNull(), round6(raw_col)).otherwise(round6(f"`{raw_col}` * `{decay_col}`"))


def affinity_ratio(p: str = "") -> Column:
    """A10 stage 1: completion ratio for the bonus (unrounded)."""
    return ratio(f"`{p}watch_completes`", f"greatest(`{p}watch_starts`, 1)")


def affinity_raw(ratio_col: str, p: str = "") -> Column:
    """A10 stage 2: weighted sum + completion bonus (round it in stage 3)."""
    return F.expr(
        f"{weighted_sum_sql(C.AFFINITY_WEIGHTS, p)} + {rate_of_sql(ratio_col)} * {sql_double(C.AFFINITY_COMPLETION_BONUS)}"
    )


def recency_raw(published_at: ColumnOrName, now: Column, half_life_hours: float = C.RECENCY_HALF_LIFE_HOURS) -> Column:
    """K2 before rounding: ``clamp(1/(1+age_h/half_life))``; stage, then
    ``recency_from``."""
    age_h = F.greatest(seconds_between(now, published_at) / F.lit(3600.0), F.lit(0.0))
    return clamp(F.lit(1.0) / (F.lit(1.0) + age_h / F.lit(max(half_life_hours, 1.0))))


def recency_from(raw_col: str, published_at: ColumnOrName) -> Column:
    """K2: rounded recency; null publication -> 0."""
    return F.when(col(published_at).isNull(), F.lit(0.0)).otherwise(round6(raw_col))


def engagement_raw(prefix: str = "") -> Column:
    """K3 before rounding: clamped weighted rate blend."""
    p = prefix
    w = C.ENGAGEMENT_WEIGHTS
    return clamp(
        F.lit(w["ctr"]) * F.col(p + "ctr")
        + F.lit(w["like_rate"]) * F.col(p + "like_rate")
        + F.lit(w["save_rate"]) * F.col(p + "save_rate")
        + F.lit(w["completion_rate"]) * F.col(p + "completion_rate")
        - F.lit(-w["skip_rate"]) * F.col(p + "skip_rate")
    )


def trending_norm(raw: str, saturation: float = C.TRENDING_SATURATION) -> Column:
    """K4: ``x/(x+saturation)``, clamped, rounded; non-positive -> 0."""
    x = f"`{raw}`"
    s = sql_double(max(saturation, 1.0))
    return F.when(F.col(raw) <= 0, F.lit(0.0)).otherwise(round6(f"greatest(0.0D, least(1.0D, {x} / ({x} + {s})))"))


def strategy_adjustment(trending: str, threshold: str, multiplier: str, cap: str) -> Column:
    """Trending boost of a strategy (K5); arguments are column names."""
    t, thr, mul, cap_ = (f"`{c}`" for c in (trending, threshold, multiplier, cap))
    return F.when(F.col(trending) <= F.col(threshold), F.lit(0.0)).otherwise(round6(f"least(({t} - {thr}) * {mul}, {cap_})"))


def assignment_bucket(experiment_key: ColumnOrName, user_id: ColumnOrName, space: int = C.BUCKET_SPACE) -> Column:
    """First 8 bytes of sha256('key:user') as unsigned big-endian, mod ``space``."""
    digest = F.sha2(F.concat_ws(":", col(experiment_key).cast("string"), col(user_id).cast("string")), 256)
    as_unsigned = F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")
    return (as_unsigned % F.lit(space)).cast("int")


def canonical_strategy(name: ColumnOrName) -> Column:
    """trim + alias resolution; unsupported names -> null."""
    trimmed = F.trim(col(name))
    expr = trimmed
    for alias, target in C.STRATEGY_ALIASES.items():
        expr = F.when(trimmed == alias, F.lit(target)).otherwise(expr)
    supported = [s[0] for s in C.STRATEGIES]
    return F.when(expr.isin(supported), expr)


def topic_at(index: ColumnOrName, topics: Iterable[str] = C.TOPICS) -> Column:
    """``topics[index]`` (0-based) from a fixed list."""
    arr = F.array(*[F.lit(t) for t in topics])
    return F.try_element_at(arr, (col(index) + 1).cast("int"))


def id_text(c: ColumnOrName) -> Column:
    """Identifiers compare as text in every tie-break (ids are UUID text upstream)."""
    return col(c).cast("string")
