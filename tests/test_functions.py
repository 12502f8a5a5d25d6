import datetime as dt

from pyspark.sql import functions as F

from rivalry.functions import dates as D
from rivalry.functions import text as T


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_season_normalize_cases(spark):
    got = col_values(spark, ["2016", "2016-2017", "20x", "+2016", " 2016 ", "-5", "2_016", "2__016", "_2016", None],
                     T.normalize_season)
    assert got == ["2016-2017", "2016-2017", None, "2016-2017", "2016-2017", "-5", "2016-2017", None, None, None]


def test_season_label_and_of_date(spark):
    assert col_values(spark, [2016], T.season_label, "int") == ["2016-2017"]
    got = col_values(spark, [dt.date(2020, 9, 30), dt.date(2020, 10, 1)], T.season_of_date, "date")
    assert got == ["2019-2020", "2020-2021"]


def test_date_parse_cases(spark):
    got = col_values(spark, ["2024-1-5", "2024-01-05", "zz", "2024-02-30", "24-01-05", "2024-13-01", "2024-02-29",
                             "2024-01- 5", "2024- 1-05", " 2024-01-05"], D.parse_ymd)
    assert got == [dt.date(2024, 1, 5), dt.date(2024, 1, 5), None, None, None, None, dt.date(2024, 2, 29),
                   dt.date(2024, 1, 5), None, None]


def test_previous_date_offset_rule(spark):
    starts = ["2024-01-05T07:59:00.000Z", "2024-01-05T08:00:00.000Z", "2024-01-05T03:00:00+05:00",
              "2024-01-05"]
    got = col_values(spark, starts, D.starts_before_offset)
    # the wall clock written in the string decides; a date-only string is midnight
    assert got == [True, False, True, True]
    df = spark.createDataFrame([("2024-01-05", s) for s in starts], "req string, start string")
    shifted = [r[0] for r in df.select(D.game_date(F.col("req"), F.col("start"))).collect()]
    assert shifted == [dt.date(2024, 1, 4), dt.date(2024, 1, 5), dt.date(2024, 1, 4), dt.date(2024, 1, 4)]


def test_previous_day_text_and_processing_date(spark):
    assert col_values(spark, [dt.date(2024, 3, 1)], D.previous_day_text, "date") == ["2024-02-29"]
    assert col_values(spark, [dt.date(2024, 1, 1)], D.processing_date, "date") == [dt.date(2023, 12, 31)]


def test_split_request(spark):
    df = spark.createDataFrame([("spurs 2016",), ("san  antonio 2016",), ("2016",), ("",), ("  a b  c ",), ("\t\t",), ("\tboston 2016",),
                                ("boston 2016\n",), ("a\u00a0b\u2003c\x1f1",), (None,)], "t string")
    ok, team, season = T.split_request(F.col("t"))
    got = [tuple(r) for r in df.select(ok, team, season).collect()]
    assert got == [(True, "spurs", "2016"), (True, "san antonio", "2016"), (False, None, None),
                   (False, None, None), (True, "a b", "c"), (False, None, None), (True, "boston", "2016"),
                   (True, "boston", "2016"), (True, "a b c", "1"), (False, None, None)]


def test_reply_text(spark):
    assert col_values(spark, [0.615, 1.0, 0.0, 0.333], T.percent_text, "double") == ["61.5%", "100.0%", "0.0%", "33.3%"]
    assert col_values(spark, [12, -3], T.signed_margin_text, "int") == ["+12", "+-3"]
    assert col_values(spark, ["home", "AWAY"], T.capitalize) == ["Home", "Away"]
    df = spark.createDataFrame([("A", "B", 1, None)], "h string, a string, hs int, as_ int")
    r = df.select(T.matchup_text(F.col("h"), F.col("a")), T.score_text(F.col("hs"), F.col("as_"))).first()
    assert tuple(r) == ("A vs B", "Score: 1 - None")


def test_processing_date_python_side():
    from rivalry.plans.loads import processing_date
    assert processing_date(dt.date(2024, 3, 1)) == dt.date(2024, 2, 29)
