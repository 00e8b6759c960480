"""Spark session helpers.

``configure`` only sets runtime SQL options that every operator relies on
(UTC session time zone, AQE with skew handling, map-key de-duplication) and
is safe to call on a session someone else built. ``local_session`` builds a
session for tests and the benchmark; on a cluster the caller's session is
used as is.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # partial aggregation stays on for hot keys (one content may carry a third of all events)
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Make the package importable in Python workers (the general
    rerank runs there): zip it once per application and add it with
    ``addPyFile``, which Spark distributes to every executor (the usual
    ``--py-files`` route). The zip is built on the driver only."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import shutil

    import rankflow

    pkg_dir = os.path.dirname(os.path.abspath(rankflow.__file__))
    out_dir = tempfile.mkdtemp(prefix="rankflow-pyfiles-")
    archive = shutil.make_archive(
        os.path.join(out_dir, "rankflow"), "zip", root_dir=os.path.dirname(pkg_dir), base_dir="rankflow"
    )
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime options the operators assume and ship the package
    to the Python workers. Idempotent."""
    for key, value in _RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship_code(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session that names none (tests, local runs) gets a private
    folder; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="rankflow-ckpt-")
    sc.setCheckpointDir(local)
    return local


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "rankflow") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("RANKFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def materialize(df, eager: bool = True):
    """Cut the lineage of a shared intermediate with a reliable checkpoint in
    the cluster's checkpoint folder (never a local checkpoint): later
    branches read the written data instead of recomputing its plan."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
