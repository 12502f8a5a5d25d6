import datetime as dt

import pytest

from conftest import games_df
from rivalry.operators import models as M
from rivalry.operators.results import team_results
from rivalry.plans.models import build_close_game_season_stats


def stats_of(spark, rows, team="A"):
    out = {r.team: r for r in M.team_season_stats(team_results(games_df(spark, rows))).collect()}
    return out[team]


def test_counts_and_null_draws(spark):
    s = stats_of(spark, [("2020-01-01", "s", "A", "B", 100, 90),
                         ("2020-01-02", "s", "A", "B", 80, 90),
                         ("2020-01-03", "s", "A", "B", 85, None)])
    assert (s.total_games, s.total_wins, s.total_losses) == (3, 1, 1)
    assert s.win_percentage == 0.333
    # AVG skips NULL opponent score but keeps own points
    assert s.avg_ppg == round((100 + 80 + 85) / 3, 2) == 88.33
    assert s.avg_points_allowed == 90.0


def test_no_rows_in_class_is_null(spark):
    s = stats_of(spark, [("2020-01-01", "s", "A", "B", 100, 90)])
    assert s.avg_ppg_in_losses is None and s.avg_points_allowed_in_losses is None
    assert s.avg_ppg_in_wins == 100.0


def test_rounding_half_away_from_zero(spark):
    # 9 / 8 = 1.125 -> 1.13 (banker's rounding would give 1.12)
    rows = [(f"2020-01-0{i}", "s", "A", "B", 1, 0) for i in range(1, 8)]
    rows.append(("2020-01-08", "s", "A", "B", 2, 0))
    s = stats_of(spark, rows)
    assert s.avg_ppg == 1.13
    # 1/16 = 0.0625 -> 0.063
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), "s", "A", "B", 0, 1) for i in range(15)]
    rows.append((dt.date(2020, 2, 1), "s", "A", "B", 1, 0))
    assert stats_of(spark, rows).win_percentage == 0.063


def test_round_ratio_exact_negative_and_zero(spark):
    from pyspark.sql import functions as F
    from rivalry.functions.rounding import round_ratio, round_ratio_sql
    df = spark.createDataFrame([(-9, 8), (9, -8), (5, 0), (0, 3), (1, 3)], "n long, d long")
    got = [r[0] for r in df.select(round_ratio(F.col("n"), F.col("d"), 2)).collect()]
    assert got == [-1.13, -1.13, None, 0.0, 0.33]
    got2 = [r[0] for r in df.select(F.expr(round_ratio_sql("n", "d", 2))).collect()]
    assert got2 == got


def test_close_games_draw_counts_but_not_win_or_loss(spark):
    g = games_df(spark, [("2020-01-01", "s", "A", "B", 100, 100),
                         ("2020-01-02", "s", "A", "B", 100, 96),
                         ("2020-01-03", "s", "A", "B", 100, 80),
                         ("2020-01-04", "s", "A", "B", 100, None)])
    r = {x.team: x for x in build_close_game_season_stats(g).collect()}["A"]
    assert (r.total_close_games, r.close_game_wins, r.close_game_losses) == (2, 1, 0)
    assert r.avg_ppg_in_close_losses is None
    assert r.avg_ppg_in_close_wins == 100.0


@pytest.mark.parametrize("max_rows", [None, 0])
def test_extremes_ties_labels_and_signs(spark, max_rows):
    g = games_df(spark, [("2020-01-01", "s", "A", "B", 100, 90),
                         ("2020-01-02", "s", "A", "C", 100, 90),
                         ("2020-01-03", "s", "A", "B", 95, 94),
                         ("2020-01-04", "s", "D", "E", 90, 99),
                         ("2020-01-05", "s", None, "E", 90, 80)])
    out = M.biggest_win_loss(team_results(g), max_broadcast_rows=max_rows).collect()
    a = sorted((r.margin_type, r.opponent_team, r.point_margin) for r in out if r.team == "A")
    assert a == [("biggest_loss", "B", 1), ("biggest_win", "B", 10), ("biggest_win", "C", 10)]
    # single game: max = min -> labelled biggest_win only
    d = [(r.margin_type, r.point_margin) for r in out if r.team == "D"]
    assert d == [("biggest_win", -9)]
    # NULL team vanishes from the join form
    assert all(r.team is not None for r in out)
    assert len(out) == len(set(out))


def test_extremes_plan_broadcasts_checked_aggregate(spark):
    g = games_df(spark, [("2020-01-01", "s", "A", "B", 100, 90)])
    plan = M.biggest_win_loss(team_results(g))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
