import random

import pytest

from conftest import games_df
from rivalry.plans import delta, incremental as I
from rivalry.plans.loads import upsert_into
from rivalry.sources.partitioned import PartitionedTable, write_partitioned


def rows(df):
    return sorted(map(str, df.collect()))


def assert_full(spark, fact, root, full_root):
    I.publish_all(spark, I.current_fact(spark, fact), full_root)
    inc, full = I.read_models(spark, root), I.read_models(spark, full_root)
    for name in I.MODEL_NAMES:
        assert rows(inc[name]) == rows(full[name]), name


def random_games(r, n, days=12):
    seen = {}
    for _ in range(n):
        d = r.choice([None, *[f"2020-0{m}-{k:02d}" for m in (1, 3) for k in range(1, days // 2 + 1)]])
        h, a = r.choice("ABCD"), r.choice(["A", "B", "C", "D", None])
        seen[d, h, a] = (d, r.choice(["s1", "s2", None]), h, a, r.choice([None, *range(90, 100)]), r.choice([None, *range(90, 100)]))
    return list(seen.values())


def test_deltas_equal_a_full_build(spark, tmpdir_spark):
    """Scores, seasons and extremes change, rows without dates, seasons, teams or scores included."""
    r = random.Random(1)
    fact, root = tmpdir_spark("fact"), tmpdir_spark("models")
    write_partitioned(games_df(spark, random_games(r, 60)), fact)
    I.publish_from(spark, fact, root)
    for k in range(2):
        stage = games_df(spark, random_games(r, 12))
        touched = I.announce(spark, root, I.touched_seasons(spark, fact, stage), stage)
        upsert_into(spark, fact, stage)
        I.refresh_models(spark, fact, root, touched)
    assert delta.read_state(spark, root)[1] == PartitionedTable(spark, fact).version() == 3
    assert_full(spark, fact, root, tmpdir_spark("full"))


def games(spark, *scores):
    return games_df(spark, [(f"2020-01-{d:02d}", "s", "A", "B", h, 100) for d, h in scores])


@pytest.mark.parametrize("change, reads_all", [
    ((1, 130), False),  # the best margin grows in its own partition
    ((1, 110), True),   # it leaves
    ((9, 60), False)])  # a new day holds a worse one than the worst
def test_other_partitions_are_read_only_if_an_extreme_leaves(spark, tmpdir_spark, change, reads_all):
    fact, root = tmpdir_spark("fact"), tmpdir_spark("models")
    write_partitioned(games(spark, (1, 120), (2, 101), (3, 115), (4, 70)), fact)
    I.publish_from(spark, fact, root)
    stage = games(spark, change)
    touched = I.announce(spark, root, I.touched_seasons(spark, fact, stage), stage)
    upsert_into(spark, fact, stage)
    read, asked = [], []
    real = PartitionedTable.read_entries

    def spy(self, entries):
        read.extend(e.value.day for e in entries)
        return real(self, entries)
    try:
        PartitionedTable.read_entries = spy
        assert delta.refresh_delta(spark, fact, root, lambda of: (asked.append(1), I.rows_of_seasons(spark, fact, root, of))[1])
    finally:
        PartitionedTable.read_entries = real
    assert bool(asked) == reads_all
    assert reads_all or set(read) == {change[0]}
    assert_full(spark, fact, root, tmpdir_spark("full"))
    # Nothing has changed since: the same models again.
    assert delta.refresh_delta(spark, fact, root, None)
    assert_full(spark, fact, root, tmpdir_spark("full"))


def test_without_a_state_or_its_version_the_seasons_are_computed_anew(spark, tmpdir_spark):
    fact, root = tmpdir_spark("fact"), tmpdir_spark("models")
    write_partitioned(games(spark, (1, 120)), fact)
    assert not delta.refresh_delta(spark, fact, root, None)
    I.publish_from(spark, fact, root)
    for score in (121, 122):
        upsert_into(spark, fact, games(spark, (1, score)))
    PartitionedTable(spark, fact).expire(keep=1)
    assert not delta.refresh_delta(spark, fact, root, None)
    I.refresh_models(spark, fact, root, spark.createDataFrame([("s",)], "season string"))
    assert_full(spark, fact, root, tmpdir_spark("full"))
