"""Load flows: historical full refresh and the daily incremental upsert."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivalry.operators.quality import gate
from rivalry.operators.upsert import UPDATE_COLS, merge_upsert
from rivalry.plans.guard import materialize
from rivalry.schemas import FACT_COLS, GAMES_COLS, MARK_COLS
from rivalry.sources.csv import read_games_csv
from rivalry.sources.payload import (flatten_payloads, latest_per_key, payload_report, read_payloads,
                                     requested_date)
from rivalry.sources.partitioned import LOCAL_PARTITIONS, PartitionedTable, partitions_of, read_partitioned
from rivalry.sources.store import Conflict, clustered, with_partition


# Partitions above which a MERGE's output is clustered before it is written.
CLUSTER_ABOVE = 100


def full_refresh(spark: SparkSession, csv_path: str, table_root: str, unit: str = "day") -> int:
    """Historical load: strict CSV -> new date-partitioned version, published atomically.

    The write consumes every column, so FAILFAST validates every row before
    anything becomes visible.
    """
    games = read_games_csv(spark, csv_path)
    return PartitionedTable(spark, table_root, unit).replace(games)


def processing_date(run_date: _dt.date) -> _dt.date:
    """A run with logical date ``d`` loads the games of ``d - 1``."""
    return run_date - _dt.timedelta(days=1)


def of_run(payloads: DataFrame, run_date: _dt.date | None) -> DataFrame:
    """The payloads requested for the processing date of a run (all without a run date).

    Documents whose own date is missing or unreadable belong to every run, so
    that the gate counts them; without the gate their games have no date.
    """
    if run_date is None:
        return payloads
    asked = requested_date(payloads)
    return payloads.filter(asked.isNull() | (asked == F.lit(processing_date(run_date))))


def stage_from_payloads(payloads: DataFrame) -> DataFrame:
    """Finished games of a batch of payloads, one row per game key, with the marks of their request and landing."""
    return latest_per_key(flatten_payloads(payloads), marks=True)


# What orders two rows of a key: request, landing, and for one document the values.
NEWER_BY = [*MARK_COLS, *[c for c in GAMES_COLS if c in UPDATE_COLS]]


def upsert_into(spark: SparkSession, table_path: str, stage: DataFrame, latest: bool = False, attempts: int = 5) -> int:
    """MERGE ``stage`` into a date-partitioned table; returns partitions rewritten.

    Only the partitions present in the stage are read (chosen in the manifest
    by the distinct stage partition values — a handful for an increment) and
    only those are written anew.  The stage is written to the shared folder
    first (measured once, lineage cut).  The new folders become visible
    together, by one switch; if another writer has replaced one of these
    partitions meanwhile, the MERGE is made again from what it left.  An empty
    stage writes nothing.

    With ``latest`` a row is updated only by a stage row of a request and
    landing that are not older than those it carries, so the order in which
    stages arrive does not matter.  Without it the stage always wins.
    """
    table = PartitionedTable(spark, table_path)
    marks = [F.col(c) if c in stage.columns else F.lit(None).cast(table.schema[c].dataType).alias(c) for c in MARK_COLS]
    staged = materialize(with_partition(stage.select(*GAMES_COLS, *marks), table.unit), "stage")
    n_parts = staged.select(table.unit).distinct().count()
    if not n_parts:
        return 0
    rows = staged.count()
    for attempt in range(attempts):
        base = table.version()
        target = partitions_of(spark, table_path, staged, max_local=LOCAL_PARTITIONS, version=base)
        merged = merge_upsert(target.select(*FACT_COLS), staged.select(*FACT_COLS), stage_rows=rows,
                              update_cols=[*UPDATE_COLS, *MARK_COLS], newer_by=NEWER_BY if latest else None)
        # Clustered by partition and key, so a backfill's task writes few partitions.
        out = with_partition(merged, table.unit) if n_parts <= CLUSTER_ABOVE else clustered(merged, table.unit)
        fresh = table.write(out)
        try:
            table.commit(base, fresh)
            return n_parts
        except Conflict:
            if attempt == attempts - 1:
                raise
    return n_parts


def daily_load(spark: SparkSession, payload_path: str, table_path: str,
               multiline: bool = False, strict: bool = True, run_date: _dt.date | None = None) -> int:
    """Extract (landed payloads) -> transform -> MERGE into the fact table.

    With ``strict`` the payload data tests run first and a failure stops the
    load before anything is written.  ``run_date`` is the run's logical date:
    only the payloads requested for its processing date are loaded.
    """
    payloads = of_run(read_payloads(spark, payload_path, multiline), run_date)
    if strict:
        gate(payload_report(payloads))
    return upsert_into(spark, table_path, stage_from_payloads(payloads))


def read_table(spark: SparkSession, table_path: str, version: int | None = None) -> DataFrame:
    return read_partitioned(spark, table_path, version).select(*GAMES_COLS)
