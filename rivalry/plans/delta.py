"""Season models kept up to date by what has changed in the fact table.

The state is a row per (team, season): counts and sums, from which both season
models follow exactly, and the best and worst margin.  A fact version names its
partition folders (``sources/partitioned``), so two versions differ in the
partitions whose folders differ: their rows of the old version are taken away
from the sums and those of the new one added, and no other partition is read.

Margins are not sums.  If a group's extreme did not lie in the changed
partitions, it is that or a larger one of the new rows; if it did and the new
rows hold one that is not smaller, it is theirs.  Only if an extreme has left
are the group's rows read again, from the partitions of its season.

The rows that hold the extremes are carried over outside the changed
partitions, taken from the new rows inside them, and read again for the groups
whose extreme has left.  The state is published last and names the fact version
it belongs to, so a refresh that died is made again from the same start, with
the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivalry.functions.rounding import round_ratio
from rivalry.operators.models import KEYS, biggest_win_loss, margin_extremes
from rivalry.operators.results import close_contest, team_results
from rivalry.plans.guard import materialize
from rivalry.schemas import BIGGEST_WIN_LOSS_COLS, CLOSE_GAME_STATS_COLS, GAMES_COLS, TEAM_SEASON_STATS_COLS
from rivalry.sources.partitioned import PartitionedTable
from rivalry.sources.store import VersionedTable, partition_value

STATE = "season_state"


def parts(max_margin: int = 5) -> dict:
    """What a participant's row adds to its group's counts and sums."""
    pts, opp = F.col("points_scored"), F.col("opponent_score")
    win, loss = F.col("result") == "win", F.col("result") == "loss"
    close = F.coalesce(close_contest(pts, opp, max_margin), F.lit(False))
    one = lambda c: F.when(c, 1).otherwise(0)
    of = lambda c, x: F.when(c, x).otherwise(0)
    known = {"games": F.lit(1), "wins": one(win), "losses": one(loss),
             "pts": F.coalesce(pts, F.lit(0)), "pts_n": one(pts.isNotNull()),
             "opp": F.coalesce(opp, F.lit(0)), "opp_n": one(opp.isNotNull()),
             "win_pts": of(win, pts), "loss_pts": of(loss, pts), "win_opp": of(win, opp), "loss_opp": of(loss, opp),
             "close": one(close), "close_wins": one(close & win), "close_losses": one(close & loss),
             "close_pts": of(close, pts), "close_opp": of(close, opp),
             "close_win_pts": of(close & win, pts), "close_loss_pts": of(close & loss, pts)}
    return {name: c.cast("long") for name, c in known.items()}


def summed(games: DataFrame, sign: int, tag: str) -> DataFrame:
    """Per (team, season): the parts' sums times ``sign``, and the margins' extremes as ``best_<tag>``, ``worst_<tag>``."""
    margin = F.col("points_scored") - F.col("opponent_score")
    return team_results(games).groupBy(*KEYS).agg(
        *[(F.sum(c) * sign).alias(name) for name, c in parts().items()],
        F.max(margin).alias(f"best_{tag}"), F.min(margin).alias(f"worst_{tag}"))


def full_state(games: DataFrame) -> DataFrame:
    return summed(games, 1, "s").withColumnsRenamed({"best_s": "best", "worst_s": "worst"})


def season_models(state: DataFrame) -> dict[str, DataFrame]:
    """``team_season_stats`` and ``close_game_season_stats`` from the state."""
    c, ratio = F.col, lambda num, den, digits=2: round_ratio(F.col(num), F.col(den), digits)
    stats = state.select(
        *KEYS, c("games").alias("total_games"), c("wins").alias("total_wins"), c("losses").alias("total_losses"),
        ratio("wins", "games", 3).alias("win_percentage"), ratio("pts", "pts_n").alias("avg_ppg"),
        ratio("win_pts", "wins").alias("avg_ppg_in_wins"), ratio("loss_pts", "losses").alias("avg_ppg_in_losses"),
        ratio("opp", "opp_n").alias("avg_points_allowed"), ratio("win_opp", "wins").alias("avg_points_allowed_in_wins"),
        ratio("loss_opp", "losses").alias("avg_points_allowed_in_losses"))
    close = state.where("close > 0").select(
        *KEYS, c("close").alias("total_close_games"), c("close_wins").alias("close_game_wins"),
        c("close_losses").alias("close_game_losses"), ratio("close_pts", "close").alias("avg_points_scored_close_games"),
        ratio("close_opp", "close").alias("avg_points_allowed_close_games"),
        ratio("close_win_pts", "close_wins").alias("avg_ppg_in_close_wins"),
        ratio("close_loss_pts", "close_losses").alias("avg_ppg_in_close_losses"))
    return {"team_season_stats": stats.select(*TEAM_SEASON_STATS_COLS),
            "close_game_season_stats": close.select(*CLOSE_GAME_STATS_COLS)}


def merged_state(state: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """The state once the rows ``before`` are replaced by ``after``, with ``left``: whether an extreme has left, so that
    ``best`` and ``worst`` are not known."""
    rows = (state.withColumnsRenamed({"best": "best_s", "worst": "worst_s"})
            .unionByName(summed(before, -1, "b"), allowMissingColumns=True)
            .unionByName(summed(after, 1, "a"), allowMissingColumns=True))
    every = rows.groupBy(*KEYS).agg(
        *[F.sum(n).alias(n) for n in parts()],
        *[f(f"{n}_{tag}").alias(f"{n}_{tag}") for n, f in (("best", F.max), ("worst", F.min)) for tag in "sba"])
    lost_best = (F.col("best_b") == F.col("best_s")) & F.coalesce(F.col("best_a") < F.col("best_s"), F.lit(True))
    lost_worst = (F.col("worst_b") == F.col("worst_s")) & F.coalesce(F.col("worst_a") > F.col("worst_s"), F.lit(True))
    return every.where("games > 0").select(
        *KEYS, *parts(), F.greatest("best_s", "best_a").alias("best"), F.least("worst_s", "worst_a").alias("worst"),
        F.coalesce(lost_best | lost_worst, F.lit(False)).alias("left"))


def same_group(own: DataFrame, groups: DataFrame, how: str) -> DataFrame:
    """Join on team and season, NULL being a value like any other; columns of ``own``, then the others of ``groups``."""
    right = groups.withColumnsRenamed({k: f"_{k}" for k in KEYS})
    return own.join(right, F.col("team").eqNullSafe(F.col("_team")) & F.col("season").eqNullSafe(F.col("_season")), how)


def write_state(spark: SparkSession, root: str, state: DataFrame, version: int) -> None:
    VersionedTable(spark, f"{root}/{STATE}").publish(state.withColumn("fact_version", F.lit(version).cast("long")))


def read_state(spark: SparkSession, root: str) -> tuple[DataFrame, int] | None:
    """The state and the fact version it belongs to; None if there is none, or no rows to tell the version."""
    table = VersionedTable(spark, f"{root}/{STATE}")
    if table.current_version() is None:
        return None
    state = table.read()
    head = state.select("fact_version").first()
    return (state.drop("fact_version"), head["fact_version"]) if head else None


def changed_partitions(table: PartitionedTable, old: int, new: int):
    """The entries of the partitions that differ between two versions: before, after."""
    was, now = table.entries(old), table.entries(new)
    values = [v for v in {*was, *now} if was.get(v) != now.get(v)]
    return [was[v] for v in values if v in was], [now[v] for v in values if v in now]


def refresh_delta(spark: SparkSession, table_path: str, root: str, rows_of_seasons) -> bool:
    """Bring the published models from the state's fact version to the current one; False if they need a full build.

    ``rows_of_seasons``: a function from a frame of seasons to their fact rows, for groups whose extreme has left.
    """
    table = PartitionedTable(spark, table_path)
    known, new = read_state(spark, root), table.version()
    if known is None or new is None or known[1] not in table.manifests.versions():
        return False
    state, old = known
    gone, come = changed_partitions(table, old, new)
    before, after = (table.read_entries(e).select(*GAMES_COLS, table.unit) for e in (gone, come))
    merged = materialize(merged_state(state, before.select(*GAMES_COLS), after.select(*GAMES_COLS)), "season-state")
    lost = merged.where("left").select(*KEYS)
    some_lost = not lost.isEmpty()
    if some_lost:
        own = materialize(same_group(team_results(rows_of_seasons(lost.select("season").distinct())), lost, "left_semi"), "lost-extremes")
        found = margin_extremes(own)
        again = (same_group(merged.where("left").drop("best", "worst"), found, "left").drop("_team", "_season")
                 .withColumnsRenamed({"biggest_win": "best", "biggest_loss": "worst"}))
        merged = materialize(merged.where("not left").unionByName(again.select(*merged.columns)), "season-state")
    bounds = merged.select(*KEYS, F.col("best").alias("biggest_win"), F.col("worst").alias("biggest_loss"))
    extremes = VersionedTable(spark, f"{root}/team_season_biggest_win_loss")
    # Rows outside the changed partitions; those of a group whose extreme has left come from its rows.
    values = [e.value for e in {e.value: e for e in [*gone, *come]}.values()]
    touched = partition_value(F.col("date"), table.unit)
    inside = touched.isin([v for v in values if v is not None]) if any(v is not None for v in values) else F.lit(False)
    inside = F.coalesce(inside, F.lit(None in values))
    kept = same_group(extremes.read().where(~inside), merged.where("not left"), "inner")
    kept = kept.where(F.col("point_margin").isin(F.col("best"), F.col("worst"))).withColumn(
        "margin_type", F.when(F.col("point_margin") == F.col("best"), "biggest_win").otherwise("biggest_loss"))
    parts_ = [kept.select(*BIGGEST_WIN_LOSS_COLS), biggest_win_loss(team_results(after.select(*GAMES_COLS)), extremes=bounds)]
    if some_lost:
        parts_.append(biggest_win_loss(own, extremes=bounds))
    rows = parts_[0]
    for p in parts_[1:]:
        rows = rows.unionByName(p)
    extremes.publish(rows.distinct())
    for name, df in season_models(merged).items():
        VersionedTable(spark, f"{root}/{name}").publish(df)
    write_state(spark, root, merged.drop("left"), new)
    return True
