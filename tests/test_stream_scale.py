"""The moving stream of a table in several files: a step is one micro-batch, read by several tasks."""

import os

import duckdb
from pyspark.sql import functions as F

from rankflow.plans import oracle, registry
from test_oracle import _rows


def test_a_step_of_the_moving_window_has_a_file_per_partition(spark, tmp_path, monkeypatch):
    root, sf = tmp_path / "stream", tmp_path / "sf"
    i = F.col("id")
    events = spark.range(600).select(
        i.alias("event_id"), F.timestamp_micros(F.lit(1706659200000000) - i * 950_000_000).cast("timestamp_ntz").alias("ts"), (i % 7).alias("user_id"),
        F.element_at(F.array(*[F.lit(t) for t in ("view", "click", "signup", "purchase", "error")]), (i % 5 + 1).cast("int")).alias("event_type"),
        F.lit(1.0).alias("value"), F.concat(F.lit('{"k": '), (i % 11).cast("string"), F.lit("}")).alias("props"),
    )
    events.repartition(3).write.parquet(f"{sf}/events.parquet")
    monkeypatch.setattr(registry, "_stream_root", lambda _: str(root))
    # a file of its own for every partition, however small
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        got = registry.q_stream_moving_window(spark, str(sf)).toPandas()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    steps = registry.MOVING_DAYS + 1
    assert len([f for f in os.listdir(root / "in") if f.endswith(".parquet")]) == 3 * steps
    assert sorted(f for f in os.listdir(root / "ckpt" / "commits") if f.isdigit()) == [str(b) for b in range(steps)]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet/*.parquet')")
    assert len(got) == 11 and _rows(got) == _rows(con.execute(oracle.ORACLE["stream_moving_window"]).df())
