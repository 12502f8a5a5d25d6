"""Property checks: exact rounding against Python's Decimal, unpivot invariants."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rivalry.functions.rounding import round_ratio, round_ratio_sql

pairs = st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(-10**6, 10**6)),
                 min_size=1, max_size=300)


def expected(n, d, digits):
    if d == 0:
        return None
    q = (Decimal(n) / Decimal(d)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP)
    return float(q)


@settings(max_examples=4, deadline=None)
@given(pairs, st.sampled_from([0, 2, 3]))
def test_round_ratio_matches_decimal_half_up(spark, rows, digits):
    import decimal
    decimal.getcontext().prec = 60
    df = spark.createDataFrame(rows, "n long, d long")
    got = df.select("n", "d", round_ratio(F.col("n"), F.col("d"), digits).alias("a"),
                    F.expr(round_ratio_sql("n", "d", digits)).alias("b")).collect()
    for r in got:
        e = expected(r.n, r.d, digits)
        assert r.a == e and r.b == e, (r, e)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.one_of(st.none(), st.integers(0, 200)),
                          st.one_of(st.none(), st.integers(0, 200))), min_size=1, max_size=200))
def test_unpivot_invariants(spark, rows):
    import datetime as dt
    from rivalry.operators.results import team_results
    from rivalry.schemas import GAMES
    data = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), "s", f"T{h}", f"U{a}", hs, as_)
            for i, (h, a, hs, as_) in enumerate(rows)]
    r = team_results(spark.createDataFrame(data, GAMES))
    agg = r.agg(F.count(F.lit(1)).alias("n"),
                F.sum("points_scored").alias("pts"), F.sum("opponent_score").alias("opp"),
                F.sum(F.when(F.col("result") == "win", 1).otherwise(0)).alias("w"),
                F.sum(F.when(F.col("result") == "loss", 1).otherwise(0)).alias("l")).first()
    assert agg.n == 2 * len(rows) and agg.pts == agg.opp and agg.w == agg.l
