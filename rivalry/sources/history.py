"""Append-only storage of SCD type-2 snapshots.

Layout::

    root/open/v-...                                 the open rows of a version
    root/closed/run=<attempt>/period=<month>/...    rows that a run has closed, by the month of their closing; written once
    root/_manifest/...                              versioned table: folders of a version, with the times they cover

A run joins the open rows with the source.  The rows that it closes become a new
folder, the open ones the next version's; closed history is never read for that
(but for the last closing of keys that reappear, key columns only) nor written
again.  One manifest version is the switch, as for other tables: readers go on
with the version they opened, and a run that dies leaves the old one.

A read as of a time opens the open rows and those closed folders whose interval
(first start, last closing) holds the time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rivalry.operators.snapshot import _ts, as_of, snapshot
from rivalry.plans.guard import materialize
from rivalry.sources.store import VersionedTable

MANIFEST = "path string, first timestamp_ntz, last timestamp_ntz, rows long"


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.manifests = VersionedTable(spark, f"{self.root}/_manifest")

    def version(self) -> int | None:
        return self.manifests.current_version()

    def folders(self, version: int | None = None) -> tuple[str, DataFrame]:
        """The folder of the open rows, and (path, first, last, rows) of the closed ones."""
        rows = self.manifests.read(version)
        return rows.where("first IS NULL").first()["path"], rows.where("first IS NOT NULL")

    def run(self, source: DataFrame, keys: list[str], run_ts, **config) -> int:
        """One snapshot run over ``source`` (see ``operators.snapshot.snapshot``); returns the new version."""
        base = self.version()
        if base is None:
            result, known = snapshot(None, source, keys, run_ts, **config), []
        else:
            path, closed = self.folders(base)
            known = [tuple(r) for r in closed.collect()]
            live = self.spark.read.parquet(path)
            result = snapshot(live, source, keys, run_ts, history=self._closed(live.schema, known), **config)
        result = materialize(result, "snapshot-run")
        attempt = uuid.uuid4().hex
        fresh = self._append(result.where("valid_to IS NOT NULL"), attempt)
        path = f"{self.root}/open/v-{attempt}"
        result.where("valid_to IS NULL").write.parquet(path)
        rows = [*known, *fresh, (path, None, None, None)]
        return self.manifests.publish(self.spark.createDataFrame(rows, MANIFEST).coalesce(1), expect=base)

    def _append(self, closed: DataFrame, attempt: str) -> list[tuple]:
        """Write rows that have been closed, by month; their folders and intervals."""
        folder = f"{self.root}/closed/run={attempt}"
        by = closed.withColumn("period", F.date_format("valid_to", "yyyy-MM"))
        found = by.groupBy("period").agg(F.min("valid_from").alias("first"), F.max("valid_to").alias("last"),
                                         F.count(F.lit(1)).alias("rows")).collect()
        if found:
            by.write.partitionBy("period").parquet(folder)
        return [(f"{folder}/period={r['period']}", r["first"], r["last"], r["rows"]) for r in found]

    def _closed(self, schema: T.StructType, entries: list[tuple]) -> DataFrame:
        if not entries:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[e[0] for e in entries])

    def read(self, version: int | None = None) -> DataFrame:
        """Every row of a version."""
        path, closed = self.folders(version)
        live = self.spark.read.parquet(path)
        return live.unionByName(self._closed(live.schema, [tuple(r) for r in closed.collect()]))

    def current(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self.folders(version)[0])

    def as_of(self, at, version: int | None = None) -> DataFrame:
        """Rows valid at a time; only closed folders whose interval holds it are listed."""
        path, closed = self.folders(version)
        live = self.spark.read.parquet(path)
        near = closed.where((F.col("first") <= _ts(at)) & (_ts(at) < F.col("last"))).collect()
        return as_of(live.unionByName(self._closed(live.schema, [tuple(r) for r in near])), at)
