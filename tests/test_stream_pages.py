"""Keyed state over many events: a step is one micro-batch, read by several tasks; the state is asked for pages, not for events."""

import os
from types import SimpleNamespace

import duckdb
from pyspark.sql import functions as F

from rankflow.plans import oracle, registry
from rankflow.streaming import continuous
from test_oracle import _rows


def _events(spark, path):
    """600 events in three files."""
    i = F.col("id")
    events = spark.range(600).select(
        i.alias("event_id"), F.timestamp_micros(F.lit(1706659200000000) - i * 950_000_000).cast("timestamp_ntz").alias("ts"), (i % 7).alias("user_id"),
        F.element_at(F.array(*[F.lit(t) for t in ("view", "click", "signup", "purchase", "error")]), (i % 5 + 1).cast("int")).alias("event_type"),
        F.lit(1.0).alias("value"), F.concat(F.lit('{"k": '), (i % 11).cast("string"), F.lit("}")).alias("props"),
    )
    events.repartition(3).write.parquet(path)


def test_a_step_of_the_continuous_form_is_one_micro_batch(spark, tmp_path, monkeypatch):
    root, sf = tmp_path / "stream", tmp_path / "sf"
    _events(spark, f"{sf}/events.parquet")
    monkeypatch.setattr(registry, "_stream_root", lambda _: str(root))
    monkeypatch.setattr(registry, "STREAM_FILES", 1)
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        got = registry.q_stream_continuous_features(spark, str(sf)).toPandas()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len([f for f in os.listdir(root / "in") if f.endswith(".parquet")]) == 3 * 2
    assert sorted(f for f in os.listdir(root / "ckpt" / "commits") if f.isdigit()) == ["0", "1"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet/*.parquet')")
    assert len(got) > 5 and _rows(got) == _rows(con.execute(oracle.ORACLE["stream_continuous_features"]).df())


class _State:
    """A state variable that counts its requests."""

    def __init__(self):
        self.value, self.asked = None, 0

    def get(self):
        self.asked += 1
        return self.value

    def update(self, value):
        self.asked += 1
        self.value = value


def _arrive(step, now, *rows):
    row = lambda i, seq, c: SimpleNamespace(event_id=i, seq=seq, content_id=c, topic=None, event_type="click", us=seq)
    out = step.handleInputRows((0,), iter([row(*r) for r in rows]), SimpleNamespace(getCurrentProcessingTimeInMs=lambda: now))
    return [(r.content_id, r.us, r.sign) for r in out]


def test_a_page_of_ids_costs_two_requests():
    step, state = continuous.LastArrival(100), _State()
    step.init(SimpleNamespace(getValueState=lambda *a, **k: state))
    assert len(_arrive(step, 0, *[(f"e{i}", i, "c") for i in range(500)])) == 500 and state.asked == 2
    # a later copy takes the stored one out, of several only the last counts, an earlier one changes nothing
    assert _arrive(step, 50, ("e7", 900, "d"), ("e7", 901, "f"), ("e8", 3, "x"), (None, 902, "n")) == [("c", 7, -1), ("f", 901, 1), ("n", 902, 1)]
    assert _arrive(step, 60, ("None", 5, "g"), (None, 903, "n")) == [("g", 5, 1), ("n", 902, -1), ("n", 903, 1)]
    # ids that nothing came for are forgotten one by one
    assert _arrive(step, 120, ("e9", 950, "c"), ("e7", 951, "h")) == [("c", 950, 1), ("f", 901, -1), ("h", 951, 1)]
