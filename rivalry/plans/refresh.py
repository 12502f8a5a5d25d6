"""Model refresh: build -> data tests (gate) -> snapshots, in that order.

The season models and the margin extremes come from one aggregation pass over
the fact table (``operators.models.season_pass``); only its result, a row per
team and season, is written and shared.  The rows of the extremes take a
second, column-pruned pass.  No copy of the fact is written.  Models and snapshots are published as new
versions of versioned tables (atomic switch); snapshot runs read the
previous snapshot version and write the next.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivalry.operators import models as M
from rivalry.operators import quality as Q
from rivalry.operators.results import team_results
from rivalry.operators.snapshot import snapshot
from rivalry.plans.guard import materialize
from rivalry.schemas import CLOSE_GAME_STATS_COLS, TEAM_SEASON_STATS_COLS
from rivalry.sources.store import VersionedTable

# Snapshot configurations of the reference.
SNAPSHOTS = {
    "snapshot_team_season_stats": dict(
        model="team_season_stats", keys=["team", "season"], strategy="check",
        check_cols=["team", "season", "total_games", "total_wins", "total_losses",
                    "win_percentage", "avg_ppg", "avg_ppg_in_wins", "avg_ppg_in_losses",
                    "avg_points_allowed", "avg_points_allowed_in_wins",
                    "avg_points_allowed_in_losses"]),
    "snapshot_close_game_season_stats": dict(
        model="close_game_season_stats", keys=["team", "season"], strategy="check",
        check_cols=["team", "season", "total_close_games", "close_game_wins",
                    "close_game_losses", "avg_points_scored_close_games",
                    "avg_points_allowed_close_games", "avg_ppg_in_close_wins",
                    "avg_ppg_in_close_losses"]),
    "snapshot_team_season_biggest_win_loss": dict(
        model="team_season_biggest_win_loss", keys=["team", "opponent_team", "date"],
        strategy="timestamp", updated_at="date", hard_deletes=True),
}


def build_models(games: DataFrame) -> dict[str, DataFrame]:
    results = team_results(games)
    seasons = materialize(M.season_pass(results), "season_pass")
    return {
        "team_season_stats": seasons.select(*TEAM_SEASON_STATS_COLS),
        "close_game_season_stats": (seasons.filter(F.col("total_close_games") > 0)
                                    .select(*CLOSE_GAME_STATS_COLS)),
        "team_season_biggest_win_loss": M.biggest_win_loss(
            results, extremes=seasons.select(*M.KEYS, "biggest_win", "biggest_loss")),
    }


def refresh(spark: SparkSession, games: DataFrame, root: str, run_ts) -> dict[str, int]:
    """Build, test and snapshot; returns the published version per table."""
    models = build_models(games)
    # The three builds are independent jobs over the same written input:
    # submit them together so small model jobs share the cluster.
    with ThreadPoolExecutor(max_workers=len(models)) as pool:
        futures = {name: pool.submit(VersionedTable(spark, f"{root}/{name}").publish, df)
                   for name, df in models.items()}
        published = {name: f.result() for name, f in futures.items()}
    published.update(test_and_snapshot(spark, root, list(models), run_ts))
    return published


def test_and_snapshot(spark: SparkSession, root: str, model_names, run_ts) -> dict[str, int]:
    """Data tests on the published models (gate), then one SCD2 run per snapshot."""
    built = {name: VersionedTable(spark, f"{root}/{name}").read() for name in model_names}
    Q.gate(Q.report(built))
    published = {}
    for snap_name, cfg in SNAPSHOTS.items():
        table = VersionedTable(spark, f"{root}/{snap_name}")
        previous = table.read() if table.current_version() is not None else None
        snap = snapshot(previous, built[cfg["model"]], cfg["keys"], run_ts,
                        strategy=cfg["strategy"], check_cols=cfg.get("check_cols"),
                        updated_at=cfg.get("updated_at"), hard_deletes=cfg.get("hard_deletes", False),
                        materialize_source=False)  # models are published tables already
        published[snap_name] = table.publish(snap)
    return published


def summary(spark: SparkSession, root: str, names) -> DataFrame:
    """``(artifact, rows, open_rows)`` for published tables (open = valid_to IS NULL)."""
    parts = []
    for name in names:
        df = VersionedTable(spark, f"{root}/{name}").read()
        open_rows = (F.sum(F.when(F.col("valid_to").isNull(), 1).otherwise(0))
                     if "valid_to" in df.columns else F.count(F.lit(1)))
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"), open_rows.cast("bigint").alias("open_rows"))
                       .select(F.lit(name).alias("artifact"), "rows", "open_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
