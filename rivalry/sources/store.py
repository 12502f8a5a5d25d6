"""Versioned tables with atomic publish; partition columns of date-partitioned facts.

Versioned table layout::

    root/v-<n>-<attempt>/...   immutable parquet versions (one folder per write attempt)
    root/_versions/<n>         marker naming the attempt folder published as version n

A writer first writes its attempt folder completely, then a marker under a
name of its own, and links that as ``_versions/<n>`` only if there is none yet
(``put_if_absent``); readers take the highest marker and read the folder it
names.  Readers therefore see the old or the new version, never half of one;
two writers racing for the same ``n`` cannot both win; and a failed write
attempt leaves an unpublished folder that a retry ignores.  A writer that has
read version ``n`` publishes with ``expect=n`` and fails if another version has
come since.

Date-partitioned facts (``sources/partitioned.py``) publish manifests of
partition folders in this way.  The partition column is named after its unit —
``day`` (the date itself, the default) or ``month`` (``trunc(date, 'MM')``).
The merge key contains ``date`` and never changes, so a row never moves between
partitions.  With daily increments, ``day`` keeps a rewrite to the increment's
own days; ``month`` rewrites whole months but makes fewer, larger partitions
for small tables.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.globStatus(p)) and len(fs.globStatus(p)) > 0


def file_state(spark: SparkSession, path: str) -> tuple[int, int]:
    """Modification time and length of a file, to tell whether it has changed."""
    p, fs = _fs(spark, path)
    status = fs.getFileStatus(p)
    return status.getModificationTime(), status.getLen()


class Conflict(RuntimeError):
    """Another writer has published first."""


def put_if_absent(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file with all of its content at once; ``Conflict`` if it exists.

    The content is written under a name of its own first.  File systems that
    refuse to rename onto an existing file (HDFS and its like) decide the race
    by the rename; on a local one a hard link does.
    """
    jvm = spark.sparkContext._jvm
    final, fs = _fs(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{final.getParent().toString()}/_{uuid.uuid4().hex}.tmp")
    out = fs.create(draft, False)
    try:
        out.writeUTF(text)
    finally:
        out.close()
    try:
        if fs.getUri().getScheme() == "file":
            local = [jvm.java.nio.file.Paths.get(p.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.String, 0))
                     for p in (final, draft)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(
                fs.makeQualified(draft), fs.makeQualified(final), none)
    except Py4JJavaError as e:
        if "AlreadyExists" not in e.java_exception.getClass().getName():
            raise
        raise Conflict(f"{path} has been published by another writer") from None
    finally:
        fs.delete(draft, False)


class VersionedTable:
    """Copy-on-write table: each publish writes a new immutable version."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _markers(self) -> list[tuple[int, bool]]:
        """``(version, complete)`` of every marker: one without content is not a version."""
        p, fs = _fs(self.spark, f"{self.root}/_versions")
        if not fs.exists(p):
            return []
        return sorted((int(st.getPath().getName()), st.getLen() > 0) for st in fs.listStatus(p)
                      if st.getPath().getName().isdigit())

    def current_version(self) -> int | None:
        versions = self.versions()
        return versions[-1] if versions else None

    def versions(self) -> list[int]:
        """All published versions."""
        return [n for n, complete in self._markers() if complete]

    def version_path(self, n: int) -> str:
        p, fs = _fs(self.spark, f"{self.root}/_versions/{n}")
        stream = fs.open(p)
        try:
            name = stream.readUTF()
        finally:
            stream.close()
        return f"{self.root}/{name}"

    def read(self, version: int | None = None) -> DataFrame:
        n = self.current_version() if version is None else version
        if n is None:
            raise FileNotFoundError(f"table {self.root} has no published version")
        return self.spark.read.parquet(self.version_path(n))

    def publish(self, df: DataFrame, expect: int | None = -1) -> int:
        """Write ``df`` as the next version, then publish it atomically.

        ``expect``: the version that ``df`` was made from (None: the table had
        none); if it is no longer the current one, nothing is published and
        ``Conflict`` is raised.
        """
        n = max([0, *(k for k, _ in self._markers())]) + 1
        name = f"v-{n:08d}-{uuid.uuid4().hex[:12]}"
        df.write.mode("errorifexists").parquet(f"{self.root}/{name}")
        if expect != -1 and self.current_version() != expect:
            raise Conflict(f"{self.root} has left version {expect}")
        put_if_absent(self.spark, f"{self.root}/_versions/{n}", name)
        return n

    def forget(self, keep: int) -> list[int]:
        """Drop all but the last ``keep`` versions; returns those dropped."""
        old = self.versions()[:-keep] if keep > 0 else []
        for n in old:
            folder = self.version_path(n)
            for path in (f"{self.root}/_versions/{n}", folder):
                p, fs = _fs(self.spark, path)
                fs.delete(p, True)
        return old


UNITS = ("day", "month")


def partition_value(date_col: Column, unit: str = "day") -> Column:
    if unit == "day":
        return date_col.cast("date")
    if unit == "month":
        return F.trunc(date_col, "MM")
    raise ValueError(f"unknown partition unit {unit!r}")


def with_partition(df: DataFrame, unit: str = "day", date_col: str = "date") -> DataFrame:
    return df.withColumn(unit, partition_value(F.col(date_col), unit))


def clustered(df: DataFrame, unit: str = "day", date_col: str = "date", files: int | None = None,
              tie_cols: tuple[str, ...] = ("home_team", "away_team")) -> DataFrame:
    """Add the partition column and range-partition by (partition, date, key columns).

    Each write task then covers a contiguous key range — a few partitions —
    instead of writing a file into every partition it happens to hold, and a
    partition holding a large share of the rows is split over many tasks
    because the range key continues into the (unique) match key.
    """
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = with_partition(df, unit, date_col)
    ties = [c for c in tie_cols if c in keyed.columns]
    return keyed.repartitionByRange(n, unit, date_col, *ties)
