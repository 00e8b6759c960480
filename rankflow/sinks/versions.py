"""Versioned tables: a manifest names the live parts of a table.

A commit writes its rows as a new folder of Parquet and then publishes the
next manifest, a small file that lists the live folders; until it is there
nobody sees the rows, afterwards everybody does. Readers follow one manifest,
so a compaction or an erasure under a running query changes nothing for it.
A batch that is written again replaces its own part. Two writers that
publish the same number: the second one starts again from the new manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: tries of a commit that other writers overtake
TRIES = 20


class VersionedTable:
    """A table under ``path``: ``data/<part>`` and ``_versions/<number>.json``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._fs = self._file(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _file(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join(parts))

    def versions(self) -> list[int]:
        folder = self._file(self.path, "_versions")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def version(self) -> int:
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """The parts of a version (the newest by default); no parts before the first commit."""
        number = self.version() if version is None else version
        if number == 0:
            return {"version": 0, "schema": None, "parts": []}
        stream = self._fs.open(self._file(self.path, "_versions", f"{number:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, version: int | None = None, batches_before: int | None = None) -> DataFrame | None:
        """The rows of a version, or None before the first commit; ``batches_before`` leaves out later batches."""
        m = self.manifest(version)
        if m["schema"] is None:
            return None
        schema = T.StructType.fromJson(m["schema"])
        parts = [p["name"] for p in m["parts"] if batches_before is None or p["batch"] < batches_before]
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{p}" for p in parts])

    def write_part(self, rows: DataFrame, batch: int) -> dict:
        """Writes a part that no manifest names yet."""
        name = f"batch-{batch:012d}-{uuid.uuid4().hex[:12]}"
        rows.write.parquet(f"{self.path}/data/{name}")
        return {"name": name, "batch": batch}

    def append(self, rows: DataFrame, batch: int) -> int:
        """Commits the rows of a batch, in the place of what the batch wrote before."""
        part = self.write_part(rows, batch)
        return self.commit(lambda parts: [p for p in parts if p["batch"] != batch] + [part], rows.schema)

    def replace(self, old: list[str], rows: DataFrame, batch: int) -> int:
        """Commits ``rows`` in the place of the named parts; parts that came meanwhile stay."""
        part = self.write_part(rows, batch)
        return self.commit(lambda parts: [p for p in parts if p["name"] not in set(old)] + [part], rows.schema)

    def commit(self, change: Callable[[list[dict]], list[dict]], schema: T.StructType) -> int:
        for _ in range(TRIES):
            m = self.manifest()
            new = {"version": m["version"] + 1, "schema": json.loads(schema.json()), "parts": change(m["parts"])}
            if self._publish(new):
                return new["version"]
        raise RuntimeError(f"{self.path}: other writers published {TRIES} versions meanwhile")

    def _publish(self, manifest: dict) -> bool:
        final = self._file(self.path, "_versions", f"{manifest['version']:012d}.json")
        draft = self._file(self.path, "_versions", f".draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            return False
        return True

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes manifests but the newest ``keep``, and the parts that only they named; returns the parts."""
        every = self.versions()
        live = {p["name"] for v in every[-keep:] for p in self.manifest(v)["parts"]}
        # parts that are being written for the next version are in no manifest at all
        gone = sorted({p["name"] for v in every[:-keep] for p in self.manifest(v)["parts"]} - live)
        for name in gone:
            self._fs.delete(self._file(self.path, "data", name), True)
        for v in every[:-keep]:
            self._fs.delete(self._file(self.path, "_versions", f"{v:012d}.json"), False)
        return gone


def latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row per key (partial ``max_by``), with its ``version``."""
    others = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*others), F.struct(F.col(order), F.col("version")))
    return rows.groupBy(*keys).agg(last.alias("_r")).select(*keys, "_r.*").select(*rows.columns)


def compact(table: VersionedTable, fold: Callable[[DataFrame], DataFrame], before: int | None = None) -> int:
    """Folds the parts of batches before ``before`` (all by default) into one, in place; returns the version."""
    m = table.manifest()
    parts = [p for p in m["parts"] if before is None or p["batch"] < before]
    if len(parts) < 2:
        return m["version"]
    rows = table.spark.read.schema(T.StructType.fromJson(m["schema"])).parquet(*[f"{table.path}/data/{p['name']}" for p in parts])
    return table.replace([p["name"] for p in parts], fold(rows), max(p["batch"] for p in parts))
