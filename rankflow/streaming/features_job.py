"""The interaction stream -> rolling features job.

One streaming query: ``read -> parse -> foreachBatch(process_batch)``.
Inside a micro-batch the batch operators are reused:

1. validate (V1) and split; invalid rows and unparsable records go to the
   dead-letter sink (S5, W7) with their envelope;
2. of the valid rows, the first arrival of every id not seen before goes to
   the audit table (S2, I1), the last arrival of every id to the event store.
   Bloom filters of the ids of each batch (``sinks.id_index``) name the earlier
   batches to open;
3. stored copies of ids that came again are taken out (I2): a narrow table
   beside the event store names them, by their own event date;
4. the hourly counts of the keys concerned are changed (``slices``), and the
   touched keys' vectors (A13, A1..A11) made from the slices of the window
   ending at ``as_of``; events are read only for its broken hours and for
   slices that lost an event;
5. snapshots (S6) and the latest-value tables (S7, S8) are written, with zero
   rows for keys that lost their last event (W4), and dates older than twice
   the window are dropped from the event store (W3), whatever the date on
   which they came.

Every write is keyed by ``batch_id`` (partition overwrite, or the batch's part
of a versioned table), so a replayed batch after a failure writes the same
again: the checkpoint only advances after ``process_batch`` returns (W6).
Steps 4 and 5 are tried ``MAX_ATTEMPTS`` times; then the batch's rows are
dead-lettered (W7).
"""

from __future__ import annotations

import datetime as _dt
import os
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .. import constants as C
from .. import sinks
from ..functions import micros, ts_lit
from ..operators import features as feat
from ..operators import ingest, validate
from ..session import checkpoint_dir
from ..sinks import id_index
from ..sinks.versions import VersionedTable
from . import slices


#: windows that the event store keeps, and tries of a batch's features
RETENTION_WINDOWS = 2
MAX_ATTEMPTS = 3


def _utc_now() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def process_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    window_hours: int = C.FEATURE_WINDOW_HOURS,
    as_of: Callable[[DataFrame], str] | None = None,
    service: str = "feature-processor",
) -> None:
    now = _utc_now()
    # the micro-batch feeds several writes: keep it (memory, spilling to
    # disk); a lost executor recomputes it from the replayable source
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    seq = [F.col(c) for c in ("source_partition", "source_offset") if c in batch.columns] or [F.monotonically_increasing_id()]
    raw = "value" if "value" in batch.columns else None
    checked = validate.interactions(batch.withColumn("ingest_seq", F.struct(*seq)), now=now, raw_json_col=raw)
    # unparsable records have no fields at all: make that explicit
    checked = checked.withColumn(
        "errors",
        F.when(F.col("event_id").isNull() & F.col("event_type").isNull(), F.array(F.lit("malformed_record"))).otherwise(
            F.col("errors")
        ),
    )
    valid = checked.filter(F.size("errors") == 0).drop("errors")
    invalid = checked.filter(F.size("errors") > 0)
    payload = ["value", *validate.INTERACTION_FIELDS]

    sinks.write_dead_letters(
        validate.dead_letters(invalid, service, now, payload_cols=payload), os.path.join(root, "dead_letters"), batch_id
    )
    t = as_of(valid) if as_of else now
    added, taken, keys = _store(valid, root, batch_id, now)
    for attempt in range(1, MAX_ATTEMPTS + 1):
        try:
            _update_features(valid, added, taken, root, batch_id, t, window_hours)
            break
        except Exception as e:  # noqa: BLE001 - reported with the rows it concerns
            if attempt == MAX_ATTEMPTS:
                failed = valid.withColumn("errors", F.array(F.lit(f"{type(e).__name__}: {e}"[:1000])))
                sinks.write_dead_letters(
                    validate.dead_letters(failed, service, now, attempts=attempt, payload_cols=payload, error_type="processing_error"),
                    os.path.join(root, "dead_letters_processing"), batch_id,
                )
    sinks.append_flush(_flushed(checked), keys.content_keys, keys.user_keys, os.path.join(root, "flushes"), batch_id, t)
    added.unpersist()
    batch.unpersist()


def _flushed(checked: DataFrame) -> DataFrame:
    """Per source partition of a batch, how far it was read and what came of the records."""
    envelope = {"topic": "source_topic", "partition": "source_partition", "offset": "source_offset"}
    cols = [(F.col(c) if c in checked.columns else F.lit(None)).cast("string" if n == "topic" else "long").alias(n) for n, c in envelope.items()]
    ok = F.size("errors") == 0
    rows = checked.select(*cols, "event_timestamp", ok.alias("ok"))
    return rows.groupBy("topic", "partition").agg(
        F.max("offset").alias("current_offset"),
        F.count_if("ok").alias("processed"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.max(F.when(F.col("ok"), F.col("event_timestamp"))).alias("last_processed_at"),
    )


def _store(valid: DataFrame, root: str, batch_id: int, now: str) -> tuple[DataFrame, DataFrame | None, Row]:
    """Steps 2 and 3: (events added, kept; stored copies taken out, read back from their table; number of keys)."""
    spark = valid.sparkSession
    added = feat.dedupe_events(valid.select(*sinks.EVENT_COLUMNS, "ingest_seq"), "ingest_seq").persist(StorageLevel.MEMORY_AND_DISK)
    filters = os.path.join(root, "id_filters")
    earlier = sinks.stored(spark, filters, id_index.SCHEMA).filter(F.col("batch_id") < int(batch_id))
    batches = id_index.may_hold(added, "event_id", earlier)

    # One audit row per id, for ever
    fresh = ingest.dedupe_first(valid, "event_id", "ingest_seq")
    if batches:
        audited = sinks.stored(spark, os.path.join(root, "audit"), "event_id string, event_date date, batch_id int")
        fresh = fresh.join(audited.filter(F.col("batch_id").isin(batches)).select("event_id"), "event_id", "left_anti")
    sinks.append_audit(fresh, os.path.join(root, "audit"), batch_id, now)

    # The copies in the store that the batch replaces
    taken = None
    if batches:
        events = sinks.stored(spark, os.path.join(root, "events"), sinks.EVENT_SCHEMA).filter(F.col("batch_id").isin(batches))
        copies = events.withColumnRenamed("batch_id", "of_batch").join(added.select("event_id"), "event_id", "left_semi")
        gone = _taken(spark, root).filter(F.col("batch_id") < int(batch_id)).select("event_id", "of_batch")
        sinks.append_taken(copies.join(gone, ["event_id", "of_batch"], "left_anti"), os.path.join(root, "taken"), batch_id)
        taken = _taken(spark, root).filter(F.col("batch_id") == int(batch_id))
    sinks.append_events(added, os.path.join(root, "events"), batch_id)
    keys = added.agg(
        F.count("*").alias("ids"), F.countDistinct("content_id").alias("content_keys"), F.countDistinct("user_id").alias("user_keys")
    ).first()
    sinks.append_filter(id_index.blooms(added, "event_id", keys.ids), filters, batch_id)
    return added, taken, keys


def _taken(spark: SparkSession, root: str) -> DataFrame:
    return sinks.stored(spark, os.path.join(root, "taken"), f"{sinks.EVENT_SCHEMA}, of_batch int")


def events_between(spark: SparkSession, root: str, lo: str, hi: str) -> DataFrame:
    """The stored events in ``(lo, hi]`` that no later arrival replaced: each id by its last arrival."""
    dates = F.col("event_date").between(F.to_date(ts_lit(lo)), F.to_date(ts_lit(hi)))
    store = sinks.stored(spark, os.path.join(root, "events"), sinks.EVENT_SCHEMA).filter(
        dates & (F.col("event_timestamp") > ts_lit(lo)) & (F.col("event_timestamp") <= ts_lit(hi))
    )
    gone = _taken(spark, root).filter(dates).select("event_id", F.col("of_batch").alias("batch_id"))
    return store.join(gone, ["event_id", "batch_id"], "left_anti")


def current_events(spark: SparkSession, root: str, as_of: str, window_hours: int) -> DataFrame:
    """Events of the window, each id by its last arrival (an id whose last
    arrival lies outside the window does not count)."""
    lo = _dt.datetime.fromisoformat(as_of) - _dt.timedelta(hours=int(window_hours))
    return events_between(spark, root, lo.strftime("%Y-%m-%d %H:%M:%S.%f"), as_of)


def _update_features(
    valid: DataFrame, added: DataFrame, taken: DataFrame | None, root: str, batch_id: int, t: str, window_hours: int
) -> None:
    spark = added.sparkSession
    oldest = slices.to_micros(t) // slices.HOUR - RETENTION_WINDOWS * window_hours
    made, old, lost = [], added.select(*sinks.EVENT_COLUMNS).limit(0), None
    if taken is not None:
        old = taken.select(*sinks.EVENT_COLUMNS)
        lost = old.agg(F.min(micros("event_timestamp")).alias("lo"), F.max(micros("event_timestamp")).alias("hi")).first()
    for key, name, keys, scores in (
        ("content_id", "content_features_latest", ["content_id"], [*feat.FEATURE_COLUMNS]),
        ("user_id", "user_topic_affinity_latest", ["user_id", "topic"], ["affinity_score"]),
    ):
        rows = slices.changes(added, old, key)
        if lost is not None and lost.lo is not None:
            # the slices that lost an event are read again, whole
            span = slices.to_text(lost.lo - slices.HOUR), slices.to_text(lost.hi + slices.HOUR)
            rows = slices.with_resets(rows, key, events_between(spark, root, *span))
        table = VersionedTable(spark, os.path.join(root, f"{key}_slices"))
        slices.append(table, rows, key, batch_id, oldest)
        # the keys of all arrivals, also of those that a later one in the batch replaced
        touched = feat.touched_keys(valid.select(key).union(old.select(key)), [key]).persist(StorageLevel.MEMORY_AND_DISK)
        buckets = [r.b for r in touched.select(sinks.bucket_of(key).alias("b")).distinct().collect()]
        counts = slices.counts(table, touched, buckets, key, t, window_hours, lambda lo, hi: events_between(spark, root, lo, hi))
        if key == "content_id":
            fresh = feat.with_content_rates(feat.fold_topics(counts, [key]), t, window_hours)
        else:
            fresh = feat.with_affinity(feat.latest_of_user(counts.filter(F.col("topic").isNotNull())), window_hours)
        path = os.path.join(root, name)
        fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
        if VersionedTable(spark, path).version():
            known = sinks.read_latest(spark, path, keys, buckets=buckets)
            fresh = fresh.unionByName(sinks.emptied(known, touched, fresh, keys, [*C.METRICS, *scores]))
        made.append(fresh.withColumn("updated_at", ts_lit(t)).persist(StorageLevel.MEMORY_AND_DISK))
    content, users = made
    sinks.write_snapshots(content, users, root, t, batch_id)
    sinks.upsert_latest(content, os.path.join(root, "content_features_latest"), batch_id, ["content_id"])
    sinks.upsert_latest(users, os.path.join(root, "user_topic_affinity_latest"), batch_id, ["user_id", "topic"])
    for df in (content, users):
        df.unpersist()
    first_kept = (_dt.datetime.fromisoformat(t) - _dt.timedelta(hours=RETENTION_WINDOWS * window_hours)).date().isoformat()
    for name in ("events", "taken"):
        sinks.expire_partitions(spark, os.path.join(root, name), "event_date", first_kept)


class ProgressTable(StreamingQueryListener):
    """Every progress report of the queries it is told of, kept as text under ``path`` (one file a batch)."""

    def __init__(self, spark: SparkSession, path: str, run_ids: set[str] | None = None):
        self.spark, self.path, self.run_ids = spark, path, run_ids

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.run_ids is None or str(p.runId) in self.run_ids:
            sinks.write_text(self.spark, f"{self.path}/{p.runId}-{p.batchId:012d}.json", p.json)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def start(
    stream: DataFrame,
    root: str,
    window_hours: int = C.FEATURE_WINDOW_HOURS,
    as_of: Callable[[DataFrame], str] | None = None,
    trigger: dict | None = None,
    checkpoint: str | None = None,
    query_name: str | None = "interaction_features",
) -> StreamingQuery:
    """Start the job. ``trigger`` defaults to the snapshot flush interval
    (15 s); pass ``{"availableNow": True}`` to drain and stop. The checkpoint
    goes under the cluster's shared ``spark.checkpoint.dir`` unless given."""
    spark: SparkSession = stream.sparkSession
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), query_name or "interaction_features")
    trig = trigger or {"processingTime": f"{C.SNAPSHOT_FLUSH_SECONDS} seconds"}
    # O6 counters on the stream itself: reported per trigger in
    # ``query.lastProgress["observedMetrics"]`` without an extra job
    observed = stream.observe(
        "interaction_stream",
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("event_id").isNull()).alias("unparsed"),
        F.max("event_timestamp").alias("last_event_at"),
    )
    writer = observed.writeStream.queryName(query_name) if query_name else observed.writeStream
    return (
        writer
        .option("checkpointLocation", ckpt)
        .trigger(**trig)
        .foreachBatch(lambda df, bid: process_batch(df, bid, root, window_hours, as_of))
        .start()
    )


def max_broker_time(valid: DataFrame) -> str:
    """An ``as_of`` policy for landed broker records: the newest broker time in the batch."""
    v = valid.agg(F.max(micros("source_timestamp"))).first()[0]
    return slices.to_text(v or 0)


def max_event_time(valid: DataFrame) -> str:
    """An ``as_of`` policy for replays: the newest event time seen so far in
    the batch (event-time features, reproducible)."""
    v = valid.agg(F.max("event_timestamp")).first()[0]
    return (v or _dt.datetime(1970, 1, 1)).strftime("%Y-%m-%d %H:%M:%S.%f")
