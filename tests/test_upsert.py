import os

import pytest
from pyspark.sql import SparkSession, functions as F

from conftest import games_df
from rivalry.operators.upsert import merge_conflicts, merge_upsert
from rivalry.plans.loads import read_table, upsert_into
from rivalry.schemas import GAMES_COLS
from rivalry.sources.partitioned import PartitionedTable, folder_value, write_partitioned

D1, D2 = "2020-01-01", "2020-02-01"


def edge(spark):
    # merge_edge fixture: key = (date, home_team, away_team) with date <- first field
    target = games_df(spark, [(D1, "s", "x", "x2", 10, 0), (D1, "s", "x", "x2", 11, 0),
                              (D2, "s", "y", "y2", 20, 0), (None, "s", "z", "z2", 5, 0)])
    stage = games_df(spark, [(D1, "t", "x", "x2", 99, 1), (D2, "t", "y", "y2", None, 1),
                             (None, "t", "z", "z2", 6, 1), ("2020-03-01", "t", "n", "n2", 7, 1)])
    return target, stage


def test_merge_edge_cases(spark):
    target, stage = edge(spark)
    got = sorted((str(r.date), r.home_team, r.home_score, r.season)
                 for r in merge_upsert(target, stage).collect())
    assert got == sorted([("2020-01-01", "x", 99, "t"), ("2020-01-01", "x", 99, "t"),
                          ("2020-02-01", "y", None, "t"), ("None", "z", 5, "s"),
                          ("None", "z", 6, "t"), ("2020-03-01", "n", 7, "t")])


def test_merge_ambiguous_source_raises_but_unmatched_dups_insert(spark):
    target, stage = edge(spark)
    dup = stage.unionByName(stage.filter(F.col("home_team") == "x"))
    assert merge_conflicts(target, dup).count() == 1
    with pytest.raises(ValueError):
        merge_upsert(target, dup)
    new_dup = stage.unionByName(stage.filter(F.col("home_team") == "n"))
    assert merge_upsert(target, new_dup).filter(F.col("home_team") == "n").count() == 2


def test_merge_shuffle_branch_equals_broadcast_branch(spark, monkeypatch):
    import rivalry.operators.upsert as U
    from rivalry.plans import guard
    target, stage = edge(spark)
    a = sorted(map(str, merge_upsert(target, stage).collect()))
    monkeypatch.setattr(U, "bounded_broadcast", lambda df, **kw: guard.bounded_broadcast(df, max_rows=0))
    b = sorted(map(str, merge_upsert(target, stage).collect()))
    assert a == b


def test_merge_target_streamed_not_shuffled(spark):
    target, stage = edge(spark)
    plan = merge_upsert(target, stage)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def _partition_files(path):
    out = {}
    table = PartitionedTable(SparkSession.getActiveSession(), path)
    for e in table.entries().values():
        d = f"{table.unit}={folder_value(e.value)}"
        out[d] = sorted(f for f in os.listdir(f"{path.replace('file:', '')}/data/gen={e.gen}/{d}") if f.endswith(".parquet"))
    return out


def test_upsert_storage_rewrites_only_touched_months_and_is_idempotent(spark, tmpdir_spark):
    path = tmpdir_spark("games")
    target, stage = edge(spark)
    write_partitioned(target, path, unit="month")
    before = _partition_files(path)
    stage_jan = stage.filter(F.col("home_team") == "x")
    assert upsert_into(spark, path, stage_jan) == 1
    after = _partition_files(path)
    assert after["month=2020-02-01"] == before["month=2020-02-01"]
    assert after["month=2020-01-01"] != before["month=2020-01-01"]
    once = sorted(map(str, read_table(spark, path).collect()))
    upsert_into(spark, path, stage_jan)
    assert sorted(map(str, read_table(spark, path).collect())) == once
    settled = _partition_files(path)
    # empty stage: nothing rewritten
    assert upsert_into(spark, path, stage.limit(0)) == 0
    assert _partition_files(path) == settled


@pytest.mark.parametrize("unit", ["day", "month"])
def test_upsert_storage_null_dates_and_new_partitions(spark, tmpdir_spark, unit):
    path = tmpdir_spark("games")
    target, stage = edge(spark)
    write_partitioned(target, path, unit=unit)
    upsert_into(spark, path, stage)
    expected = sorted(map(str, merge_upsert(target, stage).select(*GAMES_COLS).collect()))
    assert sorted(map(str, read_table(spark, path).collect())) == expected
    assert all(d.startswith(f"{unit}=") for d in _partition_files(path))


def test_upsert_many_partitions_uses_semi_join_pruning(spark, tmpdir_spark, monkeypatch):
    import rivalry.plans.loads as L
    monkeypatch.setattr(L, "LOCAL_PARTITIONS", 1)
    path = tmpdir_spark("games")
    target, stage = edge(spark)
    write_partitioned(target, path, unit="day")
    assert upsert_into(spark, path, stage) == 4
    expected = sorted(map(str, merge_upsert(target, stage).select(*GAMES_COLS).collect()))
    assert sorted(map(str, read_table(spark, path).collect())) == expected
