"""W1 in its continuous form: rolling vectors that follow every batch of events, in keyed state.

Two stateful steps (``transformWithState``, state in RocksDB):

1. by event id: the id's last arrival. A new id is one change (+1); an id that
   comes again takes its stored copy out (-1) and adds the new one. An id is
   forgotten when nothing came for it for twice the window (W3). The ids are kept
   on ``PAGES`` pages by their hash, so that a batch asks the store for a page of
   ids, not for every id;
2. by content: slices of one minute, ``((s - 1) min, s min]``, and topic, each with
   its counts per metric and its latest ``LAST`` distinct event times. The state grows
   with the minutes in which a key has events, not with the events, so a hot
   key stays bounded. Slices are read and written by the hour. A timer drops
   slices older than twice the window (W4).

Every batch gives the vectors of the contents that it changed, as of ``as_of``
or the content's newest event; window edges are cut at whole minutes. A
latest time is exact until all of a slice's ``LAST`` latest times are taken
back; from then on the slice's end stands for it and ``last_exact`` is false.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import constants as C
from .. import sinks
from ..functions import micros, ts_lit
from ..operators import features as feat
from ..session import ship_code
from .slices import to_micros

MINUTE, HOUR_MS = 60_000_000, 3_600_000
#: pages of event ids: with 36 million ids a page holds about 550, some 50 KB
PAGES = 1 << 16
#: minutes of slices that are stored together
HOUR = 60
#: distinct latest times that a slice keeps
LAST = 64
#: windows after which ids and slices are dropped
KEPT_WINDOWS = 2
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
METRICS = tuple(C.METRICS)
METRIC_AT = {e: METRICS.index(m) for e, m in C.METRIC_FOR_EVENT.items()}
CHANGE = "content_id string, topic string, event_type string, us long, sign int"
# JSON texts: the state's client goes through every element of an array in Python
PAGE = "copies string"
SLICES = "slices string"
VECTOR = "content_id string, topic string, " + ", ".join(f"{m} long" for m in METRICS) + ", last_us long, last_exact boolean"


# the worker that reads the state's layout on the driver does not get shipped code: the steps travel whole
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class LastArrival(StatefulProcessor):
    """Changes to the events that count: one copy per id, the last that arrived.

    A page is a list of [id, time of its last update, copy]."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        # a page that nothing came for goes as a whole
        self.page = handle.getValueState("page", PAGE, ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # of several arrivals of an id in one batch only the last one matters
        arrived: dict = {}
        for r in rows:
            if r.event_id not in arrived or r.seq > arrived[r.event_id][0]:
                arrived[r.event_id] = (r.seq, r.content_id, r.topic, r.event_type, r.us)
        now = timerValues.getCurrentProcessingTimeInMs()
        stored = self.page.get()
        known = {e[0]: e for e in json.loads(stored[0]) if e[1] + self.ttl_ms > now} if stored else {}
        changed = []
        for event_id, new in arrived.items():
            old = known[event_id][2] if event_id in known else None
            if old is not None and old[0] >= new[0]:
                continue
            known[event_id] = (event_id, now, new)
            changed += [(old, -1), (new, 1)] if old is not None else [(new, 1)]
        if changed:
            self.page.update((json.dumps(list(known.values()), separators=(",", ":")),))
        for copy, sign in changed:
            yield Row(content_id=copy[1], topic=copy[2], event_type=copy[3], us=copy[4], sign=sign)

    def close(self) -> None:
        pass


class Slice:
    """Counts of one minute and topic, and its latest times with how many events they have."""

    def __init__(self, counts=None, times=(), numbers=(), complete=True, exact=True):
        self.counts = list(counts) if counts else [0] * len(METRIC_AT)
        self.times = dict(zip(times, numbers))
        #: whether all times are kept; whether the latest one is known
        self.complete, self.exact = complete, exact

    def change(self, metric: int, us: int, sign: int) -> None:
        self.counts[metric] += sign
        # a time below the kept ones was left out before
        if us in self.times or self.complete or us > min(self.times, default=us):
            n = self.times.get(us, 0) + sign
            self.times[us] = n
            if n == 0:
                del self.times[us]
        if len(self.times) > LAST:
            del self.times[min(self.times)]
            self.complete = False
        if not self.times and any(self.counts):
            self.exact = False

    def state(self) -> tuple:
        times = sorted(self.times, reverse=True)
        return self.counts, times, [self.times[t] for t in times], self.complete, self.exact


class MinuteSlices(StatefulProcessor):
    """A content's counts by minute and topic; gives its vector after every batch of changes."""

    def __init__(self, window_us: int, as_of_us: int | None):
        self.window_us, self.as_of_us = window_us, as_of_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.hours = handle.getMapState("hours", "hour long", SLICES)
        self.newest = handle.getValueState("newest", "us long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        changes: dict[int, dict[tuple[int, str], list]] = {}
        known = self.newest.get()
        newest = known[0] if known else None
        for r in rows:
            # a topic is never the empty text
            at = (-(-r.us // MINUTE), r.topic or "")
            changes.setdefault(at[0] // HOUR, {}).setdefault(at, []).append((METRIC_AT[r.event_type], r.us, r.sign))
            newest = r.us if newest is None else max(newest, r.us)
        stored = {k[0] for k in self.hours.keys()}
        for hour, slices in changes.items():
            held = self._read(hour) if hour in stored else {}
            for at, changed in slices.items():
                found = held.setdefault(at, Slice())
                # what is added comes first, so that no count runs below zero
                for metric, us, sign in sorted(changed, key=lambda c: -c[2]):
                    found.change(metric, us, sign)
                if not any(found.counts):
                    del held[at]
            self._write(hour, held, stored)
        self.newest.update((newest,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.window_us // 1000)
        yield self._vector(key[0], newest if self.as_of_us is None else self.as_of_us, stored)

    def _read(self, hour: int) -> dict[tuple[int, str], Slice]:
        return {(minute, topic): Slice(*state) for minute, topic, state in json.loads(self.hours.getValue((hour,))[0])}

    def _write(self, hour: int, held: dict[tuple[int, str], Slice], stored: set[int]) -> None:
        """Stores an hour, or drops it if nothing is left; ``stored`` are the hours that the state has."""
        if held:
            rows = [(*at, s.state()) for at, s in held.items()]
            self.hours.updateValue((hour,), (json.dumps(rows, separators=(",", ":")),))
            stored.add(hour)
        elif hour in stored:
            self.hours.removeKey((hour,))
            stored.discard(hour)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Nothing came for a window: slices that no vector will need again go."""
        oldest = self.newest.get()[0] - KEPT_WINDOWS * self.window_us
        stored = {k[0] for k in self.hours.keys()}
        for hour in [h for h in stored if h * HOUR * MINUTE <= oldest]:
            self._write(hour, {at: s for at, s in self._read(hour).items() if at[0] * MINUTE > oldest}, stored)
        return iter([])

    def _vector(self, content: str, as_of: int, stored: set[int]) -> Row:
        lo, hi = -(-(as_of - self.window_us) // MINUTE) + 1, as_of // MINUTE
        total, last, exact = [0] * len(METRIC_AT), {}, True
        # the newest first: of a topic only the slice with its latest time says whether that is exact
        for hour in sorted((h for h in stored if lo // HOUR <= h <= hi // HOUR), reverse=True):
            for (minute, topic), found in sorted(self._read(hour).items(), key=lambda h: h[0], reverse=True):
                if not lo <= minute <= hi:
                    continue
                total = [a + b for a, b in zip(total, found.counts)]
                time = max(found.times) if found.exact else minute * MINUTE
                if time > last.get(topic, 0):
                    last[topic] = time
                    exact = exact and found.exact
        named = [(t, topic) for topic, t in last.items() if topic]
        values = dict(zip(METRICS, total))
        return Row(content_id=content, topic=max(named)[1] if named else None, **values, last_us=max(last.values(), default=None), last_exact=exact)

    def close(self) -> None:
        pass


def changes(arrivals: DataFrame, window_hours: int) -> DataFrame:
    """Step 1. ``arrivals``: valid events (event_id, content_id, topic, event_type, event_timestamp) with their order of arrival ``seq``."""
    page = F.pmod(F.xxhash64("event_id"), F.lit(PAGES)).alias("page")
    rows = arrivals.select(page, "event_id", F.col("seq").cast("long").alias("seq"), "content_id", "topic", "event_type", micros("event_timestamp").alias("us"))
    ttl = KEPT_WINDOWS * int(window_hours) * HOUR_MS
    return rows.groupBy("page").transformWithState(LastArrival(ttl), CHANGE, "Append", "ProcessingTime")


def vectors(changed: DataFrame, window_hours: int = C.FEATURE_WINDOW_HOURS, as_of: str | None = None) -> DataFrame:
    """Step 2: counts, topic and latest time of every content that a batch changed."""
    step = MinuteSlices(int(window_hours) * 60 * MINUTE, None if as_of is None else to_micros(as_of))
    return changed.groupBy("content_id").transformWithState(step, VECTOR, "Append", "ProcessingTime")


def with_rates(rows: DataFrame, as_of: str, window_hours: int) -> DataFrame:
    """Feature vectors (A7-A9) of the counts that the state gives."""
    counts = rows.withColumn("last_event_at", F.timestamp_micros("last_us"))
    exact = rows.select("content_id", "last_exact")
    return feat.with_content_rates(counts, as_of, window_hours).join(exact, "content_id")


def drain(rows: DataFrame, path: str, checkpoint: str, as_of: str, window_hours: int = C.FEATURE_WINDOW_HOURS) -> None:
    """Runs the stream over what is there; every batch upserts its vectors into the latest-value table at ``path``."""
    spark = rows.sparkSession
    configure(spark)
    # steps with timers would go on with empty batches for ever
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")

    def put(batch: DataFrame, batch_id: int) -> None:
        # read more than once below: without this every read would run the second step again
        batch = batch.persist()
        try:
            sinks.upsert_latest(with_rates(batch, as_of, window_hours).withColumn("updated_at", ts_lit(as_of)), path, batch_id, ["content_id"])
        finally:
            batch.unpersist()

    q = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(put).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def configure(spark: SparkSession) -> None:
    """Keyed state with several columns per key needs the RocksDB store."""
    ship_code(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
