"""Incremental model refresh: recompute only the seasons an increment touches.

Every model is keyed by (team, season), so a MERGE can only change the
groups of the seasons it writes — the stage rows' seasons and the seasons
the matched target rows had before the update (``season`` is updatable).
Those seasons are recomputed from the fact table and replace their groups;
all other groups are carried over from the published models.

The fact table is partitioned by date, not season, so each touched
season's rows are located through ``season_ranges`` (season, first_date,
last_date), a small table kept alongside the models: the recompute reads
only the partitions inside those date ranges.  Ranges only ever widen when
merged with a stage, so they always cover every dated row of their season; the
partition of rows without a date is always read.  A NULL season is a group
like any other.

A cycle keeps a log (``Cycle``): before its MERGE it writes down its stage, the
seasons that it is about to touch and the date ranges that will cover them, and
after each step how far it has come.  Every step can be made again with the
same result, so whatever a dead cycle has left undone is done before the next
one starts (``recover``).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivalry.plans import delta
from rivalry.plans.guard import bounded_broadcast, materialize
from rivalry.plans.refresh import build_models
from rivalry.schemas import GAME_KEY, GAMES_COLS
from rivalry.sources.partitioned import PartitionedTable, partitions_of, read_partitioned
from rivalry.sources.store import VersionedTable, _fs, partition_value

RANGES = "season_ranges"
LOG = "cycle_log"
# How far a cycle has come; each is written down once the step before it is whole.
PHASES = ("announced", "merged", "refreshed", "done")
# Date ranges listed in one predicate; more are merged into their envelope.
MAX_RANGES = 64
MODEL_NAMES = ("team_season_stats", "close_game_season_stats", "team_season_biggest_win_loss")


def season_ranges(games: DataFrame) -> DataFrame:
    return games.groupBy("season").agg(F.min("date").alias("first_date"),
                                       F.max("date").alias("last_date"))


def widen_ranges(ranges: DataFrame, stage: DataFrame) -> DataFrame:
    both = ranges.unionByName(season_ranges(stage))
    return both.groupBy("season").agg(F.min("first_date").alias("first_date"),
                                      F.max("last_date").alias("last_date"))


def touched_seasons(spark: SparkSession, table_path: str, stage: DataFrame) -> DataFrame:
    """Seasons a MERGE of ``stage`` can change.

    Evaluated before the upsert: afterwards the matched rows' old seasons are
    gone.  The stage keys are broadcast after a size check and the fact scan is
    pruned to the stage's partitions.
    """
    keys, _ = bounded_broadcast(stage.select(*GAME_KEY))
    old = partitions_of(spark, table_path, stage).join(keys, GAME_KEY, "left_semi").select("season")
    seasons, _ = bounded_broadcast(old.unionByName(stage.select("season")).distinct())
    return seasons


def publish_all(spark: SparkSession, fact: DataFrame, root: str) -> None:
    """Full build: models and season ranges from the whole fact table."""
    for name, df in build_models(fact).items():
        VersionedTable(spark, f"{root}/{name}").publish(df)
    VersionedTable(spark, f"{root}/{RANGES}").publish(season_ranges(fact))


def publish_from(spark: SparkSession, table_path: str, root: str) -> None:
    """Full build from a fact table, and the state that later refreshes go on from (``delta``)."""
    table = PartitionedTable(spark, table_path)
    version = table.version()
    fact = table.read(version).select(*GAMES_COLS)
    publish_all(spark, fact, root)
    delta.write_state(spark, root, delta.full_state(fact), version)


def refresh_seasons(spark: SparkSession, table_path: str, root: str, seasons: DataFrame,
                    stage: DataFrame | None = None) -> list:
    """Recompute the models for ``seasons`` and republish; returns the seasons."""
    if stage is not None:
        publish_ranges(spark, root, stage)
    todo, _ = bounded_broadcast(seasons.distinct())
    names = [r["season"] for r in todo.collect()]
    if not names:
        return []
    wanted = todo.withColumnRenamed("season", "_s")
    touched = F.col("season").eqNullSafe(F.col("_s"))
    fresh = build_models(rows_of_seasons(spark, table_path, root, todo))
    for name in MODEL_NAMES:
        table = VersionedTable(spark, f"{root}/{name}")
        kept = table.read().join(wanted, touched, "left_anti")
        table.publish(kept.unionByName(fresh[name]))
    return names


def rows_of_seasons(spark: SparkSession, table_path: str, root: str, seasons: DataFrame) -> DataFrame:
    """The fact rows of ``seasons`` (distinct), from the partitions inside their date ranges and that without a date."""
    table = PartitionedTable(spark, table_path)
    unit = table.unit
    ranges = VersionedTable(spark, f"{root}/{RANGES}").read()
    wanted = seasons.withColumnRenamed("season", "_s")
    touched = F.col("season").eqNullSafe(F.col("_s"))
    spans = merged_spans(ranges.join(wanted, touched, "left_semi")
                         .select("first_date", "last_date").filter("first_date IS NOT NULL").distinct())
    # The date ranges stand on the partition column, so the scan lists only
    # the partitions inside them, and the one of rows without a date.
    in_ranges = F.col(unit).isNull()
    for first, last in spans:
        in_ranges = in_ranges | F.col(unit).between(partition_value(F.lit(first), unit),
                                                    partition_value(F.lit(last), unit))
    low_high = [(first_of(first, unit), last) for first, last in spans]
    near = table.read(keep=lambda v: v is None or any(a <= v <= b for a, b in low_high))
    return near.filter(in_ranges).join(wanted, touched, "left_semi").select(*GAMES_COLS)


def refresh_models(spark: SparkSession, table_path: str, root: str, seasons: DataFrame) -> list:
    """Bring the models up to the fact table; returns ``seasons``.

    With a state (``publish_from``) only the partitions that have changed since
    are read; without one the seasons are computed anew.
    """
    def rows(of):
        return rows_of_seasons(spark, table_path, root, of)
    if not delta.refresh_delta(spark, table_path, root, rows):
        return refresh_seasons(spark, table_path, root, seasons)
    return [r["season"] for r in seasons.distinct().collect()]


def first_of(day, unit: str):
    """The value of the partition that holds ``day``."""
    return day if unit == "day" else day.replace(day=1)


def publish_ranges(spark: SparkSession, root: str, stage: DataFrame) -> DataFrame:
    """Publish the season ranges widened by ``stage``; ranges too wide do no harm, so a MERGE may follow or not."""
    table = VersionedTable(spark, f"{root}/{RANGES}")
    ranges = materialize(widen_ranges(table.read(), stage.select("season", "date")), "ranges")
    table.publish(ranges)
    return ranges


def merged_spans(spans: DataFrame, most: int = MAX_RANGES) -> list[tuple]:
    """The date ranges with overlaps merged; their envelope if more than ``most`` are different."""
    rows = spans.limit(most + 1).collect()
    if len(rows) > most:
        rows = spans.agg(F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date")).collect()
    merged: list[tuple] = []
    for first, last in sorted((r["first_date"], r["last_date"]) for r in rows):
        if merged and first <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(last, merged[-1][1])
        else:
            merged.append((first, last))
    return merged


def read_models(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: VersionedTable(spark, f"{root}/{name}").read() for name in MODEL_NAMES}


def current_fact(spark: SparkSession, table_path: str) -> DataFrame:
    return read_partitioned(spark, table_path).select(*GAMES_COLS)


@dataclass(frozen=True)
class Cycle:
    """The logged state of a cycle."""

    phase: str
    stage: str | None
    run_ts: str | None
    seasons: DataFrame


def read_log(spark: SparkSession, root: str) -> Cycle | None:
    """The last cycle, if there is one."""
    table = VersionedTable(spark, f"{root}/{LOG}")
    if table.current_version() is None:
        return None
    rows = table.read()
    head = rows.filter("not is_season").first()
    return Cycle(head["phase"], head["stage"], head["run_ts"], rows.filter("is_season").select("season"))


def write_log(spark: SparkSession, root: str, phase: str, seasons: DataFrame, stage: str | None, run_ts) -> Cycle:
    """Publish a cycle's state as one version: a row for the cycle and one for each season, with its date range."""
    ranges = VersionedTable(spark, f"{root}/{RANGES}").read().withColumnRenamed("season", "_s")
    own = seasons.join(ranges, F.col("season").eqNullSafe(F.col("_s")), "left").select(
        F.lit(True).alias("is_season"), "season", "first_date", "last_date")
    head = spark.createDataFrame([(False, phase, stage, None if run_ts is None else str(run_ts))],
                                 "is_season boolean, phase string, stage string, run_ts string")
    VersionedTable(spark, f"{root}/{LOG}").publish(head.unionByName(own, allowMissingColumns=True))
    return read_log(spark, root)


def pending_seasons(spark: SparkSession, root: str) -> DataFrame | None:
    """Seasons that a cycle has announced and not yet refreshed."""
    last = read_log(spark, root)
    return last.seasons if last and PHASES.index(last.phase) < PHASES.index("refreshed") else None


def announce(spark: SparkSession, root: str, seasons: DataFrame, stage: DataFrame | None = None,
             stage_path: str | None = None, run_ts=None) -> DataFrame:
    """Log ``seasons`` and those still pending as what the next refresh must cover; ``stage``: what will be merged, so
    that the date ranges cover it before it is."""
    if stage is not None:
        publish_ranges(spark, root, stage)
    before = pending_seasons(spark, root)
    every = (seasons if before is None else seasons.unionByName(before)).distinct()
    return write_log(spark, root, "announced", every, stage_path, run_ts).seasons


def advance(spark: SparkSession, table_path: str, root: str, until: str = "done") -> list:
    """Take the logged cycle from where it is to phase ``until``; returns the seasons refreshed on the way.

    A step that was made but not logged is made again: the MERGE of the same
    stage leaves the same rows, a refresh the same models, and a snapshot run
    over unchanged models adds nothing.
    """
    from rivalry.plans.loads import upsert_into
    from rivalry.plans.refresh import test_and_snapshot
    names: list = []
    cycle = read_log(spark, root)
    while cycle is not None and PHASES.index(cycle.phase) < PHASES.index(until):
        if cycle.phase == "announced" and cycle.stage is not None:
            upsert_into(spark, table_path, spark.read.parquet(cycle.stage))
        elif cycle.phase == "merged":
            names = refresh_models(spark, table_path, root, cycle.seasons)
        elif cycle.phase == "refreshed":
            test_and_snapshot(spark, root, MODEL_NAMES, cycle.run_ts)
        phase = PHASES[PHASES.index(cycle.phase) + 1]
        stage = cycle.stage
        cycle = write_log(spark, root, phase, cycle.seasons, stage if phase == "merged" else None, cycle.run_ts)
        if phase == "refreshed" and stage is not None:
            p, fs = _fs(spark, stage)
            fs.delete(p, True)
    return names


def recover(spark: SparkSession, table_path: str, root: str) -> list:
    """Finish the cycle that the log shows unfinished; returns the seasons refreshed.

    Models that fail their data tests are no reason to stop: the load that
    follows may be what mends them, and its cycle tests them again.
    """
    from rivalry.operators.quality import QualityGateError
    last = read_log(spark, root)
    if last is None or last.phase == "done":
        return []
    names = advance(spark, table_path, root, "refreshed")
    if last.run_ts is not None:
        try:
            advance(spark, table_path, root)
        except QualityGateError:
            pass
    return names


def daily_cycle(spark: SparkSession, payload_path: str, table_path: str, root: str, run_ts,
                multiline: bool = False, run_date=None, until: str = "done") -> list:
    """One scheduled day: load the landed payloads, refresh, test, snapshot.

    What an earlier cycle left undone is done first.  Then: payloads -> staged
    rows (data tests first) -> stage, touched seasons and their date ranges
    logged -> MERGE into the fact table -> touched seasons recomputed -> data
    tests on the models (gate) -> SCD2 snapshot runs.  Returns the refreshed
    seasons.  ``until``: the phase to stop after, for a scheduler that runs the
    steps one by one (``advance`` takes the next).
    """
    from rivalry.operators.quality import gate
    from rivalry.plans.loads import of_run, stage_from_payloads
    from rivalry.sources.payload import payload_report, read_payloads
    recovered = recover(spark, table_path, root)
    payloads = of_run(read_payloads(spark, payload_path, multiline), run_date)
    gate(payload_report(payloads))
    # Beside the log, not in the application's work folder: it must outlive a dead application.
    path = f"{root}/cycle_stage/{uuid.uuid4().hex}"
    stage_from_payloads(payloads).write.parquet(path)
    stage = spark.read.parquet(path)
    announce(spark, root, touched_seasons(spark, table_path, stage), stage, path, run_ts)
    names = advance(spark, table_path, root, until)
    return [*names, *[n for n in recovered if n not in names]]
