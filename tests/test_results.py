from pyspark.sql import functions as F

from conftest import games_df
from rivalry.operators.results import team_results


def test_unpivot_two_rows_per_game_roles_swapped(spark):
    g = games_df(spark, [("2020-01-01", "2019-2020", "A", "B", 100, 90)])
    rows = {r["home_away_status"]: r for r in team_results(g).collect()}
    assert set(rows) == {"home", "away"}
    h, a = rows["home"], rows["away"]
    assert (h.team, h.opponent_team, h.result, h.points_scored, h.opponent_score) == ("A", "B", "win", 100, 90)
    assert (a.team, a.opponent_team, a.result, a.points_scored, a.opponent_score) == ("B", "A", "loss", 90, 100)


def test_null_score_is_draw_and_equal_is_draw(spark):
    g = games_df(spark, [("2020-01-01", "s", "A", "B", None, 90),
                         ("2020-01-02", "s", "A", "B", 80, 80)])
    res = [r.result for r in team_results(g).collect()]
    assert res == ["draw"] * 4


def test_column_order_contract(spark):
    g = games_df(spark, [("2020-01-01", "s", "A", "B", 1, 2)])
    assert team_results(g).columns == ["date", "season", "team", "opponent_team", "home_away_status",
                                       "result", "points_scored", "opponent_score"]


def test_invariants_on_fixture(spark):
    from conftest import SF_SMALL
    from rivalry.plans.fixtures import games
    g = games(spark, SF_SMALL)
    r = team_results(g)
    n = g.count()
    assert r.count() == 2 * n
    agg = r.agg(F.sum("points_scored").alias("s"), F.sum("opponent_score").alias("a"),
                F.sum(F.when(F.col("result") == "win", 1).otherwise(0)).alias("w"),
                F.sum(F.when(F.col("result") == "loss", 1).otherwise(0)).alias("l")).first()
    assert agg.s == agg.a and agg.w == agg.l


def test_single_scan_of_games(spark, tmpdir_spark):
    path = tmpdir_spark("games")
    games_df(spark, [("2020-01-01", "s", "A", "B", 1, 2)]).write.parquet(path)
    plan = team_results(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "Generate inline" in plan
