"""Ingestion and de-duplication.

De-duplication by event id is an aggregate (``min_by`` on the arrival
order), not a window: copies of one id are reduced map-side, so an id
repeated millions of times never gathers into a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_first(batch: DataFrame, key: str = "event_id", arrival: str = "ingest_seq") -> DataFrame:
    """Exactly one row per ``key``: the first arrival; later copies are rejected."""
    others = [c for c in batch.columns if c != key]
    return batch.groupBy(key).agg(F.min_by(F.struct(*others), F.col(arrival)).alias("_r")).select(key, "_r.*")


def rejected_duplicates(batch: DataFrame, key: str = "event_id", arrival: str = "ingest_seq") -> DataFrame:
    """The copies ``dedupe_first`` rejects (arrival after the first)."""
    first = batch.groupBy(key).agg(F.min(arrival).alias("_first"))
    return batch.join(first, key).filter(F.col(arrival) > F.col("_first")).drop("_first")


def dedupe_new(batch: DataFrame, audit: DataFrame, key: str = "event_id", arrival: str = "ingest_seq") -> DataFrame:
    """I1 against the stored audit table: first arrival per key, minus keys
    already stored (anti-join)."""
    return dedupe_first(batch, key, arrival).join(audit.select(key), key, "left_anti")


def pending_publish(audit: DataFrame) -> DataFrame:
    """Persisted but not yet published rows."""
    return audit.filter(F.col("published_at").isNull())


def mark_published(audit: DataFrame, published: DataFrame, published_at: str, key: str = "event_id") -> DataFrame:
    """Set ``published_at`` for the keys just published (left join)."""
    p = published.select(key).distinct().withColumn("_pub", F.to_timestamp(F.lit(published_at)))
    return (
        audit.join(p, key, "left")
        .withColumn("published_at", F.coalesce("published_at", "_pub"))
        .drop("_pub")
    )
