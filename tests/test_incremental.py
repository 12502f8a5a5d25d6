import pytest

from conftest import games_df
from rivalry.plans import incremental as I
from rivalry.plans.loads import upsert_into
from rivalry.sources.partitioned import write_partitioned


def rows(df):
    return sorted(map(str, df.collect()))


def test_incremental_refresh_equals_full_rebuild(spark, tmpdir_spark):
    fact_path, root, full_root = tmpdir_spark("fact"), tmpdir_spark("models"), tmpdir_spark("full")
    target = games_df(spark, [
        ("2019-11-01", "2019-2020", "A", "B", 100, 90), ("2019-12-01", "2019-2020", "B", "C", 80, 95),
        ("2020-11-01", "2020-2021", "A", "C", 70, 71), ("2021-11-01", "2021-2022", "C", "A", 99, 98)])
    write_partitioned(target, fact_path, unit="day")
    I.publish_all(spark, I.current_fact(spark, fact_path), root)
    # the increment corrects a 2019 score, moves a game to another season
    # label, and adds a game in a new season
    stage = games_df(spark, [
        ("2019-11-01", "2019-2020", "A", "B", 100, 101),
        ("2020-11-01", "2019-2020", "A", "C", 70, 71),
        ("2022-11-01", "2022-2023", "B", "A", 60, 50)])
    seasons = I.touched_seasons(spark, fact_path, stage)
    assert sorted(r[0] for r in seasons.collect()) == ["2019-2020", "2020-2021", "2022-2023"]
    upsert_into(spark, fact_path, stage)
    assert sorted(I.refresh_seasons(spark, fact_path, root, seasons, stage)) == \
        ["2019-2020", "2020-2021", "2022-2023"]
    I.publish_all(spark, I.current_fact(spark, fact_path), full_root)
    inc, full = I.read_models(spark, root), I.read_models(spark, full_root)
    for name in I.MODEL_NAMES:
        assert rows(inc[name]) == rows(full[name]), name
    # untouched season 2021-2022 was carried over, not recomputed
    assert rows(inc["team_season_stats"].filter("season = '2021-2022'")) == \
        rows(full["team_season_stats"].filter("season = '2021-2022'"))


def test_refresh_reads_only_partitions_in_range(spark, tmpdir_spark):
    fact_path, root = tmpdir_spark("fact"), tmpdir_spark("models")
    write_partitioned(games_df(spark, [("2019-11-01", "2019-2020", "A", "B", 1, 2),
                                       ("2021-11-01", "2021-2022", "A", "B", 3, 4)]), fact_path, unit="month")
    I.publish_all(spark, I.current_fact(spark, fact_path), root)
    import rivalry.plans.incremental as mod
    seen = {}
    orig = mod.build_models

    def spy(fact):
        seen["plan"] = fact._jdf.queryExecution().executedPlan().toString()
        return orig(fact)
    mod.build_models = spy
    try:
        I.refresh_seasons(spark, fact_path, root, spark.createDataFrame([("2019-2020",)], "season string"))
    finally:
        mod.build_models = orig
    # The season's months and the partition of rows without a date, stated on the partition column.
    filters = seen["plan"].split("PartitionFilters: [")[1].split("], ")[0]
    assert "isnull(month" in filters and "2019-11-01" in filters and "2021" not in filters


DOC = ('{{"parameters": {{"date": "{d}"}}, "response": [{{"status": {{"long": "Finished"}}, '
       '"date": {{"start": "{d}T20:00:00Z"}}, "season": {y}, "teams": {{"home": {{"name": "{h}"}}, '
       '"visitors": {{"name": "{a}"}}}}, "scores": {{"home": {{"points": {p}}}, "visitors": {{"points": 90}}}}}}]}}')


def test_daily_cycle_matches_full_refresh(spark, tmpdir_spark):
    import os
    from rivalry.plans.refresh import SNAPSHOTS, refresh
    from rivalry.sources.store import VersionedTable
    fact, root, full_root = tmpdir_spark("fact"), tmpdir_spark("models"), tmpdir_spark("full")
    base = games_df(spark, [("2019-11-01", "2019-2020", "A", "B", 100, 90),
                            ("2020-11-01", "2020-2021", "A", "C", 70, 71)])
    write_partitioned(base, fact, unit="day")
    I.publish_all(spark, I.current_fact(spark, fact), root)
    refresh(spark, I.current_fact(spark, fact), full_root, "2024-01-01 00:00:00")
    from rivalry.plans.refresh import test_and_snapshot
    test_and_snapshot(spark, root, I.MODEL_NAMES, "2024-01-01 00:00:00")
    landing = tmpdir_spark("landing").replace("file:", "")
    os.makedirs(landing)
    with open(f"{landing}/d.json", "w") as f:
        f.write(DOC.format(d="2020-11-01", y=2020, h="A", a="C", p=95))
    assert I.daily_cycle(spark, landing, fact, root, "2024-01-02 00:00:00") == ["2020-2021"]
    refresh(spark, I.current_fact(spark, fact), full_root, "2024-01-02 00:00:00")
    for name in [*I.MODEL_NAMES, *SNAPSHOTS]:
        a = VersionedTable(spark, f"{root}/{name}").read()
        b = VersionedTable(spark, f"{full_root}/{name}").read()
        assert rows(a) == rows(b), name


def test_season_ranges_only_widen(spark):
    import datetime as dt
    d = dt.date
    ranges = spark.createDataFrame([("s", d(2020, 1, 1), d(2020, 2, 1))],
                                   "season string, first_date date, last_date date")
    stage = games_df(spark, [("2020-01-15", "s", "A", "B", 1, 2), ("2020-03-01", "s", "A", "B", 1, 2),
                             ("2021-01-01", "t", "A", "B", 1, 2)])
    got = {r.season: (r.first_date, r.last_date)
           for r in I.widen_ranges(ranges, stage.select("season", "date")).collect()}
    assert got == {"s": (d(2020, 1, 1), d(2020, 3, 1)), "t": (d(2021, 1, 1), d(2021, 1, 1))}


def test_rows_without_date_or_season(spark, tmpdir_spark):
    fact_path, root, full_root = tmpdir_spark("fact"), tmpdir_spark("models"), tmpdir_spark("full")
    write_partitioned(games_df(spark, [
        ("2019-11-01", "2019-2020", "A", "B", 100, 90), (None, "2019-2020", "A", "B", 70, 60),
        ("2019-12-01", None, "A", "B", 80, 70), ("2019-12-02", None, "B", "C", 80, 70)]), fact_path, unit="day")
    I.publish_all(spark, I.current_fact(spark, fact_path), root)
    # One game leaves the NULL season, one joins the dated one.
    stage = games_df(spark, [("2019-12-02", "2019-2020", "B", "C", 81, 70), ("2019-12-03", None, "A", "C", 5, 4)])
    seasons = I.touched_seasons(spark, fact_path, stage)
    upsert_into(spark, fact_path, stage)
    I.refresh_seasons(spark, fact_path, root, seasons, stage)
    I.publish_all(spark, I.current_fact(spark, fact_path), full_root)
    inc, full = I.read_models(spark, root), I.read_models(spark, full_root)
    for name in I.MODEL_NAMES:
        assert rows(inc[name]) == rows(full[name]), name


def test_a_cycle_that_died_is_made_up_for(spark, tmpdir_spark):
    fact_path, root = tmpdir_spark("fact"), tmpdir_spark("models")
    write_partitioned(games_df(spark, [("2019-11-01", "2019-2020", "A", "B", 1, 2)]), fact_path, unit="day")
    I.publish_all(spark, I.current_fact(spark, fact_path), root)
    stage = games_df(spark, [("2019-11-01", "2020-2021", "A", "B", 1, 2)])
    I.announce(spark, root, I.touched_seasons(spark, fact_path, stage))
    upsert_into(spark, fact_path, stage)
    # Dies here; the retry sees the new season only, but both are pending.
    again = I.announce(spark, root, I.touched_seasons(spark, fact_path, stage))
    assert sorted(r[0] for r in again.collect()) == ["2019-2020", "2020-2021"]


def test_touched_seasons_scan_names_the_partitions(spark, tmpdir_spark):
    from rivalry.sources.partitioned import partitions_of
    path = tmpdir_spark("fact")
    write_partitioned(games_df(spark, [(f"2019-11-{d:02d}", "2019-2020", "A", "B", 1, 2) for d in range(1, 21)]
                               + [(None, "2019-2020", "A", "B", 3, 4)]), path, unit="day")
    stage = games_df(spark, [("2019-11-03", "2019-2020", "A", "B", 1, 2)])
    plan = partitions_of(spark, path, stage)._jdf.queryExecution().executedPlan().toString()
    assert "2019-11-03" in plan.split("PartitionFilters: [")[1].split("]")[0]
    many = partitions_of(spark, path, games_df(spark, [("2019-11-03", "s", "A", "B", 1, 2), ("2019-11-05", "s", "A", "B", 1, 2),
                                                       (None, "s", "A", "B", 1, 2)]), max_local=1)
    assert sorted(str(r["date"]) for r in many.collect()) == ["2019-11-03", "2019-11-05", "None"]


def cycle_docs(base, name, **games):
    import os
    folder = f"{base}/{name}".replace("file:", "")
    os.makedirs(folder)
    for i, (d, h, a, p) in enumerate(games.values()):
        y = int(d[:4]) - (int(d[5:7]) < 10)
        with open(f"{folder}/{i}.json", "w") as f:
            f.write(DOC.format(d=d, y=y, h=h, a=a, p=p))
    return folder


def started(spark, tmpdir_spark):
    fact, root = tmpdir_spark("fact"), tmpdir_spark("models")
    write_partitioned(games_df(spark, [
        ("2020-01-10", "2019-2020", "A", "B", 100, 90), ("2020-01-15", "2019-2020", "A", "C", 100, 95),
        ("2020-01-20", "2019-2020", "C", "B", 70, 71), ("2020-11-01", "2020-2021", "A", "C", 70, 71)]), fact)
    I.publish_from(spark, fact, root)
    return fact, root


def assert_models_are_those_of_a_full_build(spark, fact, root, full_root):
    I.publish_all(spark, I.current_fact(spark, fact), full_root)
    inc, full = I.read_models(spark, root), I.read_models(spark, full_root)
    for name in I.MODEL_NAMES:
        assert rows(inc[name]) == rows(full[name]), name


# Before a step, right after a state is logged, and between the tables that a step publishes.
DEATHS = ["rivalry.sources.partitioned.PartitionedTable.commit", "rivalry.plans.delta.refresh_delta",
          "rivalry.plans.delta.write_state", "rivalry.plans.refresh.test_and_snapshot", "log 0", "log 1", "publish 5"]


@pytest.mark.parametrize("step", DEATHS)
def test_whenever_a_cycle_dies_the_next_makes_up_for_it(spark, tmpdir_spark, monkeypatch, step):
    """The next cycle brings another season; the lost one's date lies outside the ranges so far."""
    fact, root = started(spark, tmpdir_spark)
    base = tmpdir_spark("landing")
    first = cycle_docs(base, "first", g=("2020-01-25", "A", "B", 120))
    second = cycle_docs(base, "second", g=("2020-12-01", "C", "A", 99))

    class Dead(BaseException):
        pass

    def die(*a, **k):
        raise Dead
    done = False
    with monkeypatch.context() as m:
        kind, _, at = step.partition(" ")
        if not at:
            m.setattr(step, die)
        else:
            # Dies right after the write: of the log, or of any table.
            owner, name = {"log": (I, "write_log"), "publish": (I.VersionedTable, "publish")}[kind]
            real, calls = getattr(owner, name), []

            def counted(*a, **k):
                out = real(*a, **k)
                calls.append(1)
                if len(calls) > int(at):
                    raise Dead
                return out
            m.setattr(owner, name, counted)
        try:
            I.daily_cycle(spark, first, fact, root, "2024-01-01 00:00:00")
            done = True
        except Dead:
            pass
    assert not done
    # If it died before it was logged, the scheduler runs it again.
    if I.read_log(spark, root) is None:
        I.daily_cycle(spark, first, fact, root, "2024-01-01 00:00:00")
    I.daily_cycle(spark, second, fact, root, "2024-01-02 00:00:00")
    assert I.current_fact(spark, fact).count() == 6
    assert_models_are_those_of_a_full_build(spark, fact, root, tmpdir_spark("full"))
    assert I.read_log(spark, root).phase == "done"
    # The snapshots of the lost run are there too: its rows are valid from its own time.
    from rivalry.sources.store import VersionedTable
    snap = VersionedTable(spark, f"{root}/snapshot_team_season_stats").read()
    assert {str(r.valid_from) for r in snap.filter("season = '2019-2020'").collect()} == {"2024-01-01 00:00:00"}


def test_models_that_fail_their_tests_do_not_block_the_load_that_mends_them(spark, tmpdir_spark, monkeypatch):
    from rivalry.operators.quality import QualityGateError
    fact, root = started(spark, tmpdir_spark)
    base = tmpdir_spark("landing")
    first = cycle_docs(base, "first", g=("2020-01-25", "A", "B", 120))
    second = cycle_docs(base, "second", g=("2020-12-01", "C", "A", 99))
    import rivalry.plans.refresh as R
    real, failures = R.test_and_snapshot, [1, 1]

    def fails(*a, **k):
        if failures:
            failures.pop()
            raise QualityGateError("bad models")
        return real(*a, **k)
    monkeypatch.setattr(R, "test_and_snapshot", fails)
    with pytest.raises(QualityGateError):
        I.daily_cycle(spark, first, fact, root, "2024-01-01 00:00:00")
    assert "2020-2021" in I.daily_cycle(spark, second, fact, root, "2024-01-02 00:00:00")
    assert_models_are_those_of_a_full_build(spark, fact, root, tmpdir_spark("full"))


def test_a_scheduler_can_run_the_phases_one_by_one(spark, tmpdir_spark):
    fact, root = started(spark, tmpdir_spark)
    docs = cycle_docs(tmpdir_spark("landing"), "first", g=("2020-01-25", "A", "B", 120))
    assert I.daily_cycle(spark, docs, fact, root, "2024-01-01 00:00:00", until="announced") == []
    assert I.current_fact(spark, fact).count() == 4
    assert [r[0] for r in I.pending_seasons(spark, root).collect()] == ["2019-2020"]
    assert I.advance(spark, fact, root, "merged") == [] and I.current_fact(spark, fact).count() == 5
    assert I.advance(spark, fact, root, "refreshed") == ["2019-2020"]
    assert I.pending_seasons(spark, root) is None
    assert I.advance(spark, fact, root) == [] and I.read_log(spark, root).phase == "done"
    assert_models_are_those_of_a_full_build(spark, fact, root, tmpdir_spark("full"))
