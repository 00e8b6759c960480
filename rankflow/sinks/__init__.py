"""Sinks (S2-S8, S12).

Writes are idempotent by construction so that a re-run micro-batch (after
an executor or driver loss) leaves the same result: every batch writes its
own ``batch_id`` partition with dynamic partition overwrite, and "latest"
tables are versioned (``versions``): a batch adds a part with the rows it
recomputed, readers merge the parts of one version, and parts are folded in place.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import micros, ts_lit
from .versions import VersionedTable, compact, latest


def _overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, in whatever file system the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def expire_partitions(spark: SparkSession, path: str, column: str, first_kept: str) -> list[str]:
    """Drops the partitions of ``path`` whose ``column`` is below
    ``first_kept`` (a date); returns what was dropped."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    old = []
    for s in fs.listStatus(p) if fs.exists(p) else []:
        name = s.getPath().getName()
        if name.startswith(f"{column}=") and name.split("=", 1)[1] < first_kept:
            fs.delete(s.getPath(), True)
            old.append(name)
    return sorted(old)


EVENT_COLUMNS = ("event_id", "event_type", "user_id", "content_id", "topic", "event_timestamp")
EVENT_SCHEMA = (
    "event_id string, event_type string, user_id string, content_id string, topic string, event_timestamp timestamp, "
    "event_date date, batch_id int"
)


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a folder, read with the schema they were written with: a batch without a row leaves a folder without a file."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def append_events(events: DataFrame, path: str, batch_id: int) -> None:
    """What the rolling features read of a batch's events, by event date and batch."""
    out = events.select(*EVENT_COLUMNS, F.to_date("event_timestamp").alias("event_date"), F.lit(int(batch_id)).alias("batch_id"))
    _overwrite_partitions(out, path, ["event_date", "batch_id"])


def append_taken(copies: DataFrame, path: str, batch_id: int) -> None:
    """The stored copies (with their ``of_batch``) that a batch takes out since it sends their ids again, by the copies' event date."""
    out = copies.select(*EVENT_COLUMNS, "of_batch", "event_date", F.lit(int(batch_id)).alias("batch_id"))
    _overwrite_partitions(out, path, ["event_date", "batch_id"])


def append_filter(rows: DataFrame, path: str, batch_id: int) -> None:
    """The Bloom filter of a batch's ids (``id_index``)."""
    _overwrite_partitions(rows.withColumn("batch_id", F.lit(int(batch_id))), path, ["batch_id"])


FLUSH_SCHEMA = (
    "topic string, partition long, current_offset long, processed long, failed long, last_processed_at timestamp, "
    "flushed_at timestamp, content_keys long, user_keys long, batch_id int"
)


def append_flush(rows: DataFrame, content_keys: int, user_keys: int, path: str, batch_id: int, flushed_at: str) -> None:
    """What a flush did, by source partition, and how many keys it wrote."""
    named = {"flushed_at": ts_lit(flushed_at), "content_keys": F.lit(content_keys).cast("long"), "user_keys": F.lit(user_keys).cast("long")}
    _overwrite_partitions(rows.withColumns(named | {"batch_id": F.lit(int(batch_id))}), path, ["batch_id"])


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, replaced if it is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def append_audit(events: DataFrame, path: str, batch_id: int, created_at: str) -> None:
    """Immutable audit rows (normalized columns, metadata and whole
    payload as JSON, created / published times, trace headers) partitioned by
    event date and batch."""
    cols = [c for c in events.columns if c not in ("errors", "value")]
    out = events.select(
        *cols,
        F.to_json(
            F.struct(*[c for c in cols if not c.startswith("source_")]), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
        ).alias("event_payload"),
        ts_lit(created_at).alias("created_at"),
        F.lit(None).cast("timestamp").alias("published_at"),
        F.to_date("event_timestamp").alias("event_date"),
        F.lit(int(batch_id)).alias("batch_id"),
    )
    _overwrite_partitions(out, path, ["event_date", "batch_id"])


def to_keyed_json(df: DataFrame, key_col: str = "user_id", header_cols: dict[str, str] | None = None) -> DataFrame:
    """S3: keyed record with compact, key-sorted JSON value and headers, the
    shape a Kafka sink takes (``key``, ``value``, ``headers``)."""
    cols = sorted(c for c in df.columns)
    headers = F.array(
        *[F.struct(F.lit(k).alias("key"), F.lit(v).cast("binary").alias("value")) for k, v in (header_cols or {}).items()]
    )
    return df.select(
        F.col(key_col).cast("string").alias("key"),
        F.to_json(F.struct(*cols)).alias("value"),
        headers.alias("headers"),
    )


def write_keyed(df: DataFrame, path: str | None = None, topic: str | None = None, bootstrap_servers: str | None = None) -> None:
    """S3 delivery: Kafka when a broker is given, otherwise JSON files."""
    if bootstrap_servers:
        df.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save()
    else:
        df.select("key", "value").write.mode("append").json(path)


def write_dead_letters(dead: DataFrame, path: str, batch_id: int) -> None:
    """Dead letters of one micro-batch (overwrite of its partition)."""
    _overwrite_partitions(dead.withColumn("batch_id", F.lit(int(batch_id))), path, ["batch_id"])


def write_snapshots(content_features: DataFrame, user_features: DataFrame, root: str, snapshot_at: str, batch_id: int) -> None:
    """Append-only snapshots, one ``snapshot_at`` per flush."""
    for name, df in (("content_feature_snapshots", content_features), ("user_topic_feature_snapshots", user_features)):
        out = df.withColumn("snapshot_at", ts_lit(snapshot_at)).withColumn("batch_id", F.lit(int(batch_id)))
        _overwrite_partitions(out, os.path.join(root, name), ["batch_id"])


#: parts of a latest-value table before they are folded, and versions that readers may still use
LATEST_PARTS, LATEST_KEPT = 16, 2
BUCKETS = 64


def bucket_of(key: str) -> Column:
    """Groups of keys: parts are sorted by them, so that a reader of few keys skips most row groups."""
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def upsert_latest(new_rows: DataFrame, path: str, batch_id: int, keys: list[str] | None = None, order_col: str = "updated_at") -> int:
    """S7 / S8 write side: the rows a batch recomputed become a part of the
    table's next version; a replayed batch replaces its own part. With
    ``keys`` the parts of earlier batches are folded when there are many.
    Returns the version."""
    table = VersionedTable(new_rows.sparkSession, path)
    if keys and sum(p["batch"] < batch_id for p in table.manifest()["parts"]) >= LATEST_PARTS:
        compact_latest(new_rows.sparkSession, path, keys, order_col, batch_id)
        table.vacuum(LATEST_KEPT)
    rows = new_rows.withColumn("bucket", bucket_of(keys[0] if keys else new_rows.columns[0])).withColumn("version", F.lit(int(batch_id)))
    return table.append(rows.sortWithinPartitions("bucket"), batch_id)


def read_latest(
    spark: SparkSession,
    path: str,
    keys: list[str],
    order_col: str = "updated_at",
    as_of: str | None = None,
    window_hours: int | None = None,
    version: int | None = None,
    buckets: list[int] | None = None,
) -> DataFrame:
    """S7 / S8 read side: latest row per key over the parts of one version
    (the newest by default; partial ``max_by`` per key), of the keys in
    ``buckets`` only if given. With ``as_of`` and ``window_hours`` rows without
    an event in the window ending at ``as_of`` are left out (W4): keys that no
    batch has touched since, and the ones a batch emptied."""
    rows = VersionedTable(spark, path).read(version)
    if rows is None:
        raise FileNotFoundError(f"{path} has no version yet")
    if buckets is not None:
        rows = rows.where(F.col("bucket").isin(buckets))
    out = latest(rows, keys, order_col).drop("version", "bucket")
    if as_of is None:
        return out
    since = F.timestamp_micros(micros(ts_lit(as_of)) - F.lit(int(window_hours or 0) * 3_600_000_000))
    return out.filter(F.col("last_event_at") > since)


def emptied(stored: DataFrame, touched: DataFrame, fresh: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Zero rows for stored keys that the touched ones no longer have events for."""
    on = [c for c in touched.columns]
    gone = stored.filter(F.col("last_event_at").isNotNull()).join(touched, on, "left_semi").join(fresh.select(*keys), keys, "left_anti")
    zero = {c: F.lit(0).cast(fresh.schema[c].dataType) for c in metrics}
    return gone.withColumns(zero | {"last_event_at": F.lit(None).cast("timestamp")}).select(*fresh.drop("updated_at").columns)


def compact_latest(spark: SparkSession, path: str, keys: list[str], order_col: str = "updated_at", before: int | None = None) -> int:
    """Folds the parts of a latest-value table (of batches before ``before``) into one, in place; returns the version."""
    return compact(VersionedTable(spark, path), lambda df: latest(df, keys, order_col).sortWithinPartitions("bucket"), before)


def read_affinity_map(latest_affinity: DataFrame) -> DataFrame:
    """The long (user, topic, score) table read back as one map per user;
    empty scores are ignored."""
    return latest_affinity.filter(F.col("affinity_score").isNotNull()).groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(F.struct("topic", "affinity_score"))).alias("topic_affinity")
    )


def read_content_features(latest: DataFrame, items: DataFrame) -> DataFrame:
    """Content vectors for items, typed zero defaults for missing ones
    (the item's own topic is kept)."""
    from ..operators.features import attach_features

    return attach_features(items, latest)


__all__ = [
    "append_audit",
    "append_events",
    "append_filter",
    "append_flush",
    "append_taken",
    "bucket_of",
    "emptied",
    "exists",
    "expire_partitions",
    "stored",
    "to_keyed_json",
    "write_keyed",
    "write_dead_letters",
    "write_snapshots",
    "write_text",
    "upsert_latest",
    "read_latest",
    "compact_latest",
    "read_affinity_map",
    "read_content_features",
]
