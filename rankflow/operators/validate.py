"""Record validation as boolean columns -> ``errors array<string>``.

A row is valid when ``size(errors) = 0``; the invalid branch becomes the
dead-letter envelope (V14). Nothing is validated one record at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions import blank_to_null, slug, ts_lit

INTERACTION_FIELDS = (
    "schema_name",
    "event_id",
    "event_type",
    "user_id",
    "content_id",
    "session_id",
    "topic",
    "watch_duration_seconds",
    "event_timestamp",
    "metadata",
)


def errors_of(*checks: tuple[Column, str]) -> Column:
    """Array of the messages whose check is true (null checks count as false)."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(m)) for c, m in checks]))


def _id_invalid(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name).isNull() | ~F.col(name).rlike(C.UUID_PATTERN)
    return F.col(name).isNull()


def interactions(df: DataFrame, now: str | None = None, raw_json_col: str | None = None) -> DataFrame:
    """V1-V5 (+ V7 topic check up front). Normalizes session (trim, empty ->
    null) and topic (trim, lower, empty -> null), applies defaults and adds
    ``errors``; lengths are measured after trimming. With ``raw_json_col``
    unknown top-level keys are reported, and values of a wrong type (present
    in the JSON but not parsed) are errors instead of taking the default."""
    cols = set(df.columns)
    out = df
    mistyped = [c for c in ("watch_duration_seconds", "event_timestamp") if raw_json_col and c in cols]
    wrong = {c: F.col(c).isNull() & F.get_json_object(F.col(raw_json_col), f"$.{c}").isNotNull() for c in mistyped}
    out = out.withColumns({f"_bad_{c}": w for c, w in wrong.items()}) if wrong else out
    if "schema_name" not in cols:
        out = out.withColumn("schema_name", F.lit(C.INTERACTION_SCHEMA_NAME))
    out = out.withColumn("schema_name", F.coalesce("schema_name", F.lit(C.INTERACTION_SCHEMA_NAME)))
    dur = F.col("watch_duration_seconds") if "watch_duration_seconds" in cols else F.lit(None).cast("int")
    out = out.withColumn("watch_duration_seconds", F.coalesce(dur, F.lit(0)).cast("int"))
    if now is not None:
        out = out.withColumn("event_timestamp", F.coalesce("event_timestamp", ts_lit(now)))
    if "metadata" in cols and isinstance(df.schema["metadata"].dataType, T.MapType):
        out = out.withColumn("metadata", F.coalesce("metadata", F.create_map().cast(df.schema["metadata"].dataType)))
    out = out.withColumn("session_id", blank_to_null("session_id")).withColumn("topic", slug("topic"))
    checks = [
        (F.col("schema_name") != C.INTERACTION_SCHEMA_NAME, "schema_name_invalid"),
        (_id_invalid(out, "event_id"), "event_id_invalid"),
        (_id_invalid(out, "user_id"), "user_id_invalid"),
        (_id_invalid(out, "content_id"), "content_id_invalid"),
        (F.col("event_type").isNull() | ~F.col("event_type").isin(*C.EVENT_TYPES), "event_type_unknown"),
        (~F.col("watch_duration_seconds").between(0, C.MAX_WATCH_SECONDS), "watch_duration_out_of_range"),
        (F.length("session_id") > C.MAX_SESSION_CHARS, "session_id_too_long"),
        (F.length("topic") > C.MAX_TOPIC_CHARS, "topic_too_long"),
        ((F.col("event_type") == "watch_complete") & (F.col("watch_duration_seconds") <= 0), "watch_complete_without_duration"),
        (F.col("topic").isNotNull() & ~F.col("topic").isin(*C.TOPICS), "topic_unsupported"),
        (F.col("event_timestamp").isNull(), "event_timestamp_missing"),
    ]
    if raw_json_col:
        extra = F.array_except(F.json_object_keys(F.col(raw_json_col)), F.array(*[F.lit(k) for k in INTERACTION_FIELDS]))
        checks.append((F.size(extra) > 0, "unknown_fields"))
    checks += [(F.col(f"_bad_{c}"), f"{c}_invalid") for c in mistyped]
    return out.withColumn("errors", errors_of(*checks)).drop(*[f"_bad_{c}" for c in mistyped])


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) branches of a validated frame."""
    ok = F.size("errors") == 0
    return validated.filter(ok), validated.filter(~ok)


def dead_letters(
    validated: DataFrame,
    service: str,
    occurred_at: str,
    source_topic: str = "interactions.events.v1",
    attempts: int = 1,
    payload_cols: Sequence[str] | None = None,
    error_type: str = "validation_error",
) -> DataFrame:
    """Dead-letter envelope for the rows with errors: where the record
    came from, its headers and trace ids, what failed and the payload."""
    bad = validated.filter(F.size("errors") > 0)
    cols = set(bad.columns)
    payload = [c for c in (payload_cols or INTERACTION_FIELDS) if c in cols]

    def opt(name: str, dtype: str) -> Column:
        """An envelope field under its stream name or its bare one."""
        found = next((c for c in (f"source_{name}", name) if c in cols), None)
        return F.col(found).cast(dtype) if found else F.lit(None).cast(dtype)

    headers = opt("headers", "array<struct<key: string, value: string>>")

    def header(name: str) -> Column:
        return F.try_element_at(F.filter(headers, lambda h: F.lower(h["key"]) == name), F.lit(1))["value"]

    return bad.select(
        F.lit(C.DEAD_LETTER_SCHEMA_NAME).alias("schema_name"),
        *[c for c in ("event_id", "ingest_seq") if c in cols],
        F.lit(source_topic).alias("source_topic"),
        opt("partition", "int").alias("source_partition"),
        opt("offset", "long").alias("source_offset"),
        opt("key", "string").alias("source_key"),
        headers.alias("headers"),
        header("x-request-id").alias("request_id"),
        header("x-correlation-id").alias("correlation_id"),
        F.lit(service).alias("failed_service"),
        F.lit(error_type).alias("error_type"),
        F.array_join("errors", "; ").alias("error_message"),
        F.to_json(F.struct(*payload)).alias("payload"),
        F.lit(int(max(attempts, 1))).alias("attempts"),
        ts_lit(occurred_at).alias("occurred_at"),
    )


def unique_violations(df: DataFrame, keys: Sequence[str], field: str, existing: DataFrame | None = None) -> DataFrame:
    """Keys occurring more than once in the batch, or already present in
    ``existing``. Counted with a partial aggregate, so a key with millions of
    copies is reduced map-side rather than gathered into one task."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("occurrences"))
    dup = counts.filter(F.col("occurrences") > 1).withColumn("violation", F.lit("duplicate_in_batch"))
    out = dup
    if existing is not None:
        clash = counts.join(existing.select(*keys).distinct(), list(keys), "left_semi").withColumn(
            "violation", F.lit("exists")
        )
        out = out.unionByName(clash)
    return out.withColumn("field", F.lit(field))


def content_feature_vectors(df: DataFrame, strict: bool = False) -> DataFrame:
    """Counts present and not negative, the five rates in [0, 1], the window
    within its bounds. ``strict`` leaves out the vectors with an error."""
    rates = ("ctr", "like_rate", "save_rate", "skip_rate", "completion_rate")
    errs = errors_of(
        *[(F.col(m).isNull() | (F.col(m) < 0), f"{m}_invalid") for m in C.METRICS],
        *[(F.col(r).isNull() | F.isnan(r) | (F.col(r) < 0) | (F.col(r) > 1), f"{r}_out_of_range") for r in rates],
        (
            F.col("window_hours").isNull() | ~F.col("window_hours").between(C.FEATURE_WINDOW_MIN_HOURS, C.FEATURE_WINDOW_MAX_HOURS),
            "window_hours_out_of_range",
        ),
    )
    out = df.withColumn("errors", errs)
    return out.filter(F.size("errors") == 0).drop("errors") if strict else out


def topic_preferences(df: DataFrame, col: str = "topic_preferences") -> DataFrame:
    """V6: keys trimmed + lower-cased (last wins on collision), non-empty,
    within the five topics; scores numeric in [0, 1]."""
    m = F.transform_keys(F.col(col), lambda k, v: F.lower(F.trim(k)))
    errs = errors_of(
        (~F.forall(F.map_keys(m), lambda k: (k != "") & k.isin(*C.TOPICS)), "topic_unsupported"),
        (~F.forall(F.map_values(m), lambda v: v.isNotNull() & (v >= 0) & (v <= 1)), "score_out_of_range"),
    )
    return df.withColumn(col, m).withColumn("errors", errs)


def topic_affinity(df: DataFrame, col: str = "topic_affinity") -> DataFrame:
    """V7: as V6 but any finite score."""
    m = F.transform_keys(F.col(col), lambda k, v: F.lower(F.trim(k)))
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    errs = errors_of(
        (~F.forall(F.map_keys(m), lambda k: (k != "") & k.isin(*C.TOPICS)), "topic_unsupported"),
        (~F.forall(F.map_values(m), finite), "score_not_finite"),
    )
    return df.withColumn(col, m).withColumn("errors", errs)


def content(df: DataFrame) -> DataFrame:
    """V8: title 5..500 after trim, description <= 2000 (blank -> null),
    topic 1..100 (slug), category in the five, status in two (default draft)."""
    out = (
        df.withColumn("title", F.trim("title"))
        .withColumn("description", blank_to_null("description") if "description" in df.columns else F.lit(None).cast("string"))
        .withColumn("topic", slug("topic"))
        .withColumn("status", F.coalesce(F.col("status"), F.lit("draft")) if "status" in df.columns else F.lit("draft"))
    )
    errs = errors_of(
        (~F.length("title").between(5, 500), "title_length"),
        (F.length("description") > 2000, "description_too_long"),
        (F.col("topic").isNull() | (F.length("topic") > 100), "topic_invalid"),
        (~F.col("category").isin(*C.CATEGORIES), "category_unknown"),
        (~F.col("status").isin(*C.CONTENT_STATUSES), "status_unknown"),
    )
    return out.withColumn("errors", errs)


def tags(df: DataFrame) -> DataFrame:
    """V9: name trim + lower 1..255, description <= 500."""
    out = df.withColumn("name", F.lower(F.trim("name")))
    errs = errors_of(
        (~F.length("name").between(1, 255), "name_length"),
        (F.length("description") > 500, "description_too_long") if "description" in df.columns else (F.lit(False), ""),
    )
    return out.withColumn("errors", errs)


def users(df: DataFrame) -> DataFrame:
    """Username trimmed + pattern, email trimmed + lower + syntax, bio <= 500."""
    out = df.withColumn("username", F.trim("username")).withColumn("email", F.lower(F.trim("email")))
    if "bio" in df.columns:
        out = out.withColumn("bio", blank_to_null("bio"))
    errs = errors_of(
        (~F.col("username").rlike(C.USERNAME_PATTERN), "username_invalid"),
        (~F.col("email").rlike(C.EMAIL_PATTERN), "email_invalid"),
        (F.length("bio") > 500, "bio_too_long") if "bio" in df.columns else (F.lit(False), ""),
    )
    return out.withColumn("errors", errs)
