"""Model builds from the contest table (the warehouse's output tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rivalry.operators import models as M
from rivalry.operators.results import close_contest, team_results


def build_team_season_stats(games: DataFrame) -> DataFrame:
    return M.team_season_stats(team_results(games))


def build_close_game_season_stats(games: DataFrame, max_margin: int = 5) -> DataFrame:
    # |home - away| <= k is symmetric, so filter contests before the unpivot:
    # the parquet scan and the unpivot then only see close contests.
    close = games.filter(close_contest(F.col("home_score"), F.col("away_score"), max_margin))
    return M.close_game_season_stats(team_results(close), max_margin)


def build_biggest_win_loss(games: DataFrame) -> DataFrame:
    return M.biggest_win_loss(team_results(games))
