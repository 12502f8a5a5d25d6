import pytest

from rivalry.operators import quality as Q


def test_not_null_and_unique_counts(spark):
    df = spark.createDataFrame([("a", "s", 1), ("a", "s", 2), (None, None, None), (None, None, 3)],
                               "team string, season string, total_games int")
    rep = {(r.test, r.columns): r.failures for r in
           Q.report({"team_season_stats": df}, {"team_season_stats": ["season", "team", "total_games"]},
                    {"team_season_stats": ["season", "team"]}).collect()}
    assert rep[("not_null", "season")] == 2 and rep[("not_null", "total_games")] == 1
    # GROUP BY semantics: the two NULL keys form one duplicated group
    assert rep[("unique_combination_of_columns", "season,team")] == 2


def test_gate_raises_on_failures(spark):
    df = spark.createDataFrame([("a", None)], "team string, season string")
    rep = Q.report({"m": df}, {"m": ["team", "season"]}, {"m": ["team"]})
    with pytest.raises(Q.QualityGateError):
        Q.gate(rep)
    ok = Q.report({"m": df}, {"m": ["team"]}, {"m": ["team"]})
    assert Q.gate(ok).count() == 2
