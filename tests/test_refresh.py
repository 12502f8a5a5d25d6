import pytest

from conftest import games_df
from rivalry.operators.quality import QualityGateError
from rivalry.plans.refresh import SNAPSHOTS, refresh, summary
from rivalry.sources.store import VersionedTable


def test_refresh_builds_tests_and_snapshots(spark, tmpdir_spark):
    root = tmpdir_spark("refresh")
    g1 = games_df(spark, [("2020-01-01", "2019-2020", "A", "B", 100, 90)])
    g2 = games_df(spark, [("2020-01-01", "2019-2020", "A", "B", 100, 90),
                          ("2020-01-02", "2019-2020", "A", "C", 80, 95)])
    refresh(spark, g1, root, "2024-01-01 00:00:00")
    refresh(spark, g2, root, "2024-01-02 00:00:00")
    rows = {r.artifact: (r.rows, r.open_rows) for r in summary(spark, root, ["team_season_stats", *SNAPSHOTS]).collect()}
    assert rows["team_season_stats"] == (3, 3)
    # A changed (closed + new), B unchanged, C new
    assert rows["snapshot_team_season_stats"] == (4, 3)


def test_failing_data_test_stops_before_snapshots(spark, tmpdir_spark):
    root = tmpdir_spark("refresh")
    bad = games_df(spark, [("2020-01-01", None, "A", "B", 100, 90)])   # NULL season
    with pytest.raises(QualityGateError):
        refresh(spark, bad, root, "2024-01-01 00:00:00")
    assert VersionedTable(spark, f"{root}/snapshot_team_season_stats").current_version() is None
