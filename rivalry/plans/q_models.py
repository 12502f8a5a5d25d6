"""Queries over the season models (unpivot, stats, close games, extremes)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivalry.functions.rounding import round_ratio
from rivalry.operators import models as M
from rivalry.operators.results import outcome, point_margin, team_results
from rivalry.plans import fixtures as X
from rivalry.plans import oracle as O
from rivalry.plans.catalog import register
from rivalry.plans.models import (build_close_game_season_stats, build_biggest_win_loss,
                                  build_team_season_stats)

G = {"games": O.GAMES}
GT = {"games": O.GAMES, "team_results": O.team_results_sql("games")}


@register("derive_games", O.with_ctes("SELECT * FROM games", **G))
def q_derive_games(spark, sf_dir):
    """The match fact itself, derived from lineitem (the other queries read it as a stored table)."""
    return X.derive_games(spark, sf_dir)


@register("team_results", O.with_ctes("SELECT * FROM team_results", **GT))
def q_team_results(spark, sf_dir):
    return team_results(X.games(spark, sf_dir))


@register("outcome_null_scores", O.with_ctes(
    "SELECT * FROM team_results", games_base=O.GAMES, games=O.GAMES_NULLABLE,
    team_results=O.team_results_sql("games")))
def q_outcome_null_scores(spark, sf_dir):
    return team_results(X.games_nullable(spark, sf_dir))


@register("team_season_stats", O.with_ctes(O.team_season_stats_sql("team_results"), **GT))
def q_team_season_stats(spark, sf_dir):
    return build_team_season_stats(X.games(spark, sf_dir))


@register("team_season_stats_nullable", O.with_ctes(
    O.team_season_stats_sql("team_results"), games_base=O.GAMES, games=O.GAMES_NULLABLE,
    team_results=O.team_results_sql("games")))
def q_team_season_stats_nullable(spark, sf_dir):
    return build_team_season_stats(X.games_nullable(spark, sf_dir))


@register("close_game_season_stats", O.with_ctes(O.close_game_stats_sql("team_results"), **GT))
def q_close_game_season_stats(spark, sf_dir):
    return build_close_game_season_stats(X.games(spark, sf_dir))


@register("close_games", O.with_ctes(
    "SELECT team, season, date, opponent_team, home_away_status, result, points_scored, "
    "opponent_score, points_scored - opponent_score AS point_margin FROM team_results "
    "WHERE ABS(points_scored - opponent_score) <= 5", **GT))
def q_close_games(spark, sf_dir):
    g = X.games(spark, sf_dir)
    close = g.filter(F.abs(F.col("home_score") - F.col("away_score")) <= 5)
    return M.close_games(team_results(close)).select(
        "team", "season", "date", "opponent_team", "home_away_status", "result",
        "points_scored", "opponent_score", "point_margin")


@register("point_margin", O.with_ctes(
    "SELECT team, season, date, opponent_team, points_scored - opponent_score AS point_margin "
    "FROM team_results", **GT))
def q_point_margin(spark, sf_dir):
    r = team_results(X.games(spark, sf_dir))
    return point_margin(r).select("team", "season", "date", "opponent_team", "point_margin")


_DRAW_FLAGS = "SUM(CASE WHEN result = 'draw' THEN 1 ELSE 0 END)"
_DRAW_POINTS = "SUM(CASE WHEN result = 'draw' THEN points_scored ELSE 0 END)"


@register("safe_ratio", O.with_ctes(
    f"SELECT team, season, CAST({_DRAW_FLAGS} AS BIGINT) AS draws, "
    f"{O.rnd(_DRAW_POINTS, _DRAW_FLAGS, 2)} AS avg_ppg_in_draws "
    "FROM team_results GROUP BY team, season", **GT))
def q_safe_ratio(spark, sf_dir):
    """SUM(x) / NULLIF(SUM(flag), 0): groups without a draw give NULL, not 0."""
    draw = F.col("result") == "draw"
    sums = (team_results(X.games(spark, sf_dir)).groupBy("team", "season")
            .agg(F.sum(F.when(draw, 1).otherwise(0)).alias("draws"),
                 F.sum(F.when(draw, F.col("points_scored")).otherwise(0)).alias("_points")))
    return sums.select("team", "season", "draws",
                       round_ratio(F.col("_points"), F.col("draws"), 2).alias("avg_ppg_in_draws"))


@register("margin_extremes", O.with_ctes(
    "SELECT team, season, MAX(points_scored - opponent_score) AS biggest_win, "
    "MIN(points_scored - opponent_score) AS biggest_loss FROM team_results GROUP BY team, season", **GT))
def q_margin_extremes(spark, sf_dir):
    return M.margin_extremes(team_results(X.games(spark, sf_dir)))


@register("biggest_win_loss", O.with_ctes(O.biggest_win_loss_sql("team_results"), **GT))
def q_biggest_win_loss(spark, sf_dir):
    return build_biggest_win_loss(X.games(spark, sf_dir))


@register("biggest_win_loss_shuffle", O.with_ctes(O.biggest_win_loss_sql("team_results"), **GT))
def q_biggest_win_loss_shuffle(spark, sf_dir):
    """Same result through the shuffle-join branch (aggregate over the broadcast bound)."""
    return M.biggest_win_loss(team_results(X.games(spark, sf_dir)), max_broadcast_rows=0)
