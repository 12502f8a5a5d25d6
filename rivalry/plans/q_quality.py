"""Queries over the data-quality tests."""

from __future__ import annotations

from rivalry.operators import quality as Q
from rivalry.plans import fixtures as X
from rivalry.plans import oracle as O
from rivalry.plans.catalog import register
from rivalry.plans.models import (build_biggest_win_loss, build_close_game_season_stats,
                                  build_team_season_stats)

MODELS = {"games": O.GAMES, "team_results": O.team_results_sql("games"),
          "team_season_stats": O.team_season_stats_sql("team_results"),
          "close_game_season_stats": O.close_game_stats_sql("team_results"),
          "team_season_biggest_win_loss": O.biggest_win_loss_sql("team_results")}


def _not_null_sql() -> str:
    parts = [f"SELECT '{m}' AS model, 'not_null' AS test, '{c}' AS columns, "
             f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {m}"
             for m, cols in Q.NOT_NULL_TESTS.items() for c in cols]
    return "\nUNION ALL\n".join(parts)


def _unique_sql() -> str:
    parts = [f"SELECT '{m}' AS model, 'unique_combination_of_columns' AS test, '{','.join(cols)}' AS columns, "
             f"CAST((SELECT COUNT(*) FROM (SELECT {', '.join(cols)} FROM {m} GROUP BY {', '.join(cols)} "
             f"HAVING COUNT(*) > 1)) AS BIGINT) AS failures"
             for m, cols in Q.UNIQUE_TESTS.items()]
    return "\nUNION ALL\n".join(parts)


def _models(spark, sf_dir):
    g = X.games(spark, sf_dir)
    return {"team_season_stats": build_team_season_stats(g),
            "close_game_season_stats": build_close_game_season_stats(g),
            "team_season_biggest_win_loss": build_biggest_win_loss(g)}


@register("dq_not_null", O.with_ctes(_not_null_sql(), **MODELS))
def q_dq_not_null(spark, sf_dir):
    return Q.report(_models(spark, sf_dir), unique_tests={})


@register("dq_unique", O.with_ctes(_unique_sql(), **MODELS))
def q_dq_unique(spark, sf_dir):
    return Q.report(_models(spark, sf_dir), not_null_tests={})


@register("dq_report", O.with_ctes(_not_null_sql() + "\nUNION ALL\n" + _unique_sql(), **MODELS))
def q_dq_report(spark, sf_dir):
    return Q.gate(Q.report(_models(spark, sf_dir)))


@register("dq_unique_results", O.with_ctes(
    "SELECT 'team_results' AS model, 'unique_combination_of_columns' AS test, "
    "'team,opponent_team,date' AS columns, CAST(COUNT(*) AS BIGINT) AS failures FROM "
    "(SELECT team, opponent_team, date FROM team_results GROUP BY ALL HAVING COUNT(*) > 1)", **MODELS))
def q_dq_unique_results(spark, sf_dir):
    """The uniqueness test finding real duplicates: a pair can meet twice on one date."""
    from rivalry.operators.results import team_results
    return Q.unique_combination("team_results", team_results(X.games(spark, sf_dir)),
                                ["team", "opponent_team", "date"])
