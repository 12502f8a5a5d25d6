import os
import random

import pytest

from rivalry.operators.snapshot import as_of, snapshot
from rivalry.plans.guard import materialize
from rivalry.sources.history import SnapshotStore
from rivalry.sources.store import Conflict, VersionedTable


def source(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, at string").selectExpr("k", "v", "CAST(at AS DATE) AS at")


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.select("k", "v", "at", "scd_id", "valid_from", "valid_to").collect())


RUNS = ["2024-01-10 00:00:00", "2024-02-10 00:00:00", "2024-02-20 00:00:00", "2024-04-01 00:00:00"]


def states(seed):
    r = random.Random(seed)
    day = 0
    for _ in RUNS:
        day += 5
        yield [(k, r.randint(0, 2), f"2024-01-{day + r.randint(0, 4):02d}") for k in "abcdef" if r.random() < 0.7]


@pytest.mark.parametrize("config", [dict(strategy="check", check_cols=["v"]),
                                    dict(strategy="timestamp", updated_at="at", hard_deletes=True)])
def test_equals_the_snapshot_that_is_rewritten(spark, tmpdir_spark, config):
    """Keys change, vanish and reappear; closed folders never change."""
    store, plain, seen = SnapshotStore(spark, tmpdir_spark("snap")), None, {}
    for at, state in zip(RUNS, states(3)):
        src = source(spark, state)
        plain = materialize(snapshot(plain, src, ["k"], at, **config), "plain")
        store.run(src, ["k"], at, **config)
        assert rows(store.read()) == rows(plain)
        now = {}
        for d, _, names in os.walk(f"{store.root.replace('file:', '')}/closed"):
            now |= {f"{d}/{n}": os.stat(f"{d}/{n}").st_mtime_ns for n in names if n.startswith("part-")}
        assert {f: now[f] for f in seen} == seen
        seen = now
    assert seen
    for at in ["2024-01-09 00:00:00", *RUNS, "2024-02-15 00:00:00", "2024-03-01 12:00:00"]:
        assert rows(store.as_of(at)) == rows(as_of(plain, at))
    # A run made again adds nothing.
    before = rows(store.read())
    store.run(src, ["k"], RUNS[-1], **config)
    assert rows(store.read()) == before


def test_as_of_lists_overlapping_folders_only_and_versions_stay(spark, tmpdir_spark):
    store = SnapshotStore(spark, tmpdir_spark("snap"))
    for i, at in enumerate(RUNS):
        store.run(source(spark, [("a", i, "2024-01-01")]), ["k"], at, strategy="check", check_cols=["v"])
    assert len(store.as_of("2024-02-15 00:00:00").inputFiles()) < len(store.read().inputFiles())
    assert [f for f in store.as_of("2024-02-15 00:00:00").inputFiles() if "period=2024-04" in f] == []
    assert store.read(1).count() == 1 and store.current(2).first()["v"] == 1


def test_a_run_that_dies_or_loses_leaves_the_version(spark, tmpdir_spark, monkeypatch):
    store = SnapshotStore(spark, tmpdir_spark("snap"))
    config = dict(strategy="check", check_cols=["v"])
    store.run(source(spark, [("a", 1, "2024-01-01")]), ["k"], RUNS[0], **config)
    before = rows(store.read())

    def die(*a, **k):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "publish", die)
        with pytest.raises(KeyboardInterrupt):
            store.run(source(spark, [("a", 2, "2024-01-01")]), ["k"], RUNS[1], **config)
    assert rows(store.read()) == before
    real = VersionedTable.publish

    def late(self, df, expect=-1):
        if expect == 1:
            real(self, df)  # another run of the same version wins
        return real(self, df, expect)
    monkeypatch.setattr(VersionedTable, "publish", late)
    with pytest.raises(Conflict):
        store.run(source(spark, [("a", 2, "2024-01-01")]), ["k"], RUNS[1], **config)
    assert store.read().count() == 2


def test_empty_source(spark, tmpdir_spark):
    store = SnapshotStore(spark, tmpdir_spark("snap"))
    store.run(source(spark, []), ["k"], RUNS[0], strategy="check", check_cols=["v"])
    assert store.read().count() == 0 and store.as_of(RUNS[1]).count() == 0
