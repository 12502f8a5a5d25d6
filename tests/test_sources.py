import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, games_df
from rivalry.plans.loads import full_refresh
from rivalry.sources.csv import read_games_csv
from rivalry.sources.payload import flatten_payloads, latest_per_key, read_payloads
from rivalry.sources.partitioned import write_partitioned
from rivalry.sources.store import VersionedTable
from rivalry.sources.tables import TableRegistry

HEADER = "d,s,h,a,hs,as\n"


def write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def local(path):
    return path.replace("file:", "")


def test_csv_quoting_nulls_and_positional_header(spark, tmpdir_spark):
    base = local(tmpdir_spark("csv"))
    write_text(f"{base}/ok.csv", HEADER + '2020-01-01,"A, ""x""",B,C,1,2\n'
                                          '2020-01-02,,"",C,3,\\N\n')
    rows = sorted(read_games_csv(spark, base).collect(), key=lambda r: r.date)
    assert rows[0].season == 'A, "x"' and (rows[0].home_team, rows[0].away_team) == ("B", "C")
    assert (rows[0].home_score, rows[0].away_score) == (1, 2)
    # unquoted empty -> NULL, quoted empty -> '', \N -> NULL
    assert rows[1].season is None and rows[1].home_team == ""
    assert (rows[1].home_score, rows[1].away_score) == (3, None)


@pytest.mark.parametrize("bad", ["2020-01-01,s,h,a,1\n", "2020-01-01,s,h,a,1,2,3\n",
                                 "2020-01-01,s,h,a,x,2\n", "2020-13-45,s,h,a,1,2\n"])
def test_csv_bad_rows_abort_the_load(spark, tmpdir_spark, bad):
    base = local(tmpdir_spark("csv"))
    write_text(f"{base}/bad.csv", HEADER + "2020-01-01,s,h,a,1,2\n" + bad)
    with pytest.raises(Exception):
        full_refresh(spark, base, tmpdir_spark("table"))


def test_csv_missing_file(spark, tmpdir_spark):
    with pytest.raises(FileNotFoundError):
        read_games_csv(spark, tmpdir_spark("nothing") + "/x.csv")


def test_versioned_table_publish_and_read(spark, tmpdir_spark):
    root = tmpdir_spark("vt")
    t = VersionedTable(spark, root)
    assert t.current_version() is None
    t.publish(games_df(spark, [("2020-01-01", "s", "A", "B", 1, 2)]))
    t.publish(games_df(spark, [("2020-01-01", "s", "A", "B", 3, 4), ("2020-01-02", "s", "A", "B", 5, 6)]))
    assert t.current_version() == 2 and t.read().count() == 2 and t.read(1).count() == 1


def test_registry_declares_sources(spark):
    reg = TableRegistry(spark, SF_SMALL).declare("raw_match_data", f"{SF_SMALL}/nation.parquet")
    assert reg.load("raw_match_data", "n_name").count() == 25
    assert reg.load("region").count() == 5


PAYLOAD = """{"parameters": {"date": "2024-01-05"}, "response": [
 {"status": {"long": "Finished"}, "date": {"start": "2024-01-05T02:00:00.000Z"}, "season": 2023,
  "teams": {"home": {"name": "A"}, "visitors": {"name": "B"}},
  "scores": {"home": {"points": 100}, "visitors": {"points": 99}}},
 {"status": {"long": "Scheduled"}, "date": {"start": "2024-01-05T20:00:00.000Z"}, "season": 2023,
  "teams": {"home": {"name": "C"}, "visitors": {"name": "D"}},
  "scores": {"home": {"points": null}, "visitors": {"points": null}}},
 {"status": {"long": "Finished"}, "date": {"start": "2024-01-05T20:00:00.000Z"}, "season": 2023,
  "teams": {"home": {"name": "E"}, "visitors": {"name": "F"}},
  "scores": {"home": {"points": 90}, "visitors": {"points": 91}}}]}
"""


def test_payload_flatten_multiline_filters_and_shifts(spark, tmpdir_spark):
    base = local(tmpdir_spark("landing"))
    write_text(f"{base}/a.json", PAYLOAD)
    write_text(f"{base}/b.json", '{"parameters": {"date": "2024-01-06"}, "response": []}')
    write_text(f"{base}/c.json", '{"parameters": {"date": "2024-01-07"}}')
    rows = sorted(tuple(r) for r in flatten_payloads(read_payloads(spark, base, multiline=True))
                  .drop("file_time", "file_name").collect())
    assert rows == [(dt.date(2024, 1, 4), "2023-2024", "A", "B", 100, 99, dt.date(2024, 1, 5)),
                    (dt.date(2024, 1, 5), "2023-2024", "E", "F", 90, 91, dt.date(2024, 1, 5))]


def test_latest_request_wins(spark):
    stage = spark.createDataFrame(
        [(dt.date(2024, 1, 4), "s", "A", "B", 1, 1, dt.date(2024, 1, 4)),
         (dt.date(2024, 1, 4), "s", "A", "B", 2, 2, dt.date(2024, 1, 5))],
        "date date, season string, home_team string, away_team string, home_score int, "
        "away_score int, request_date date")
    assert [r.home_score for r in latest_per_key(stage).collect()] == [2]


def test_daily_load_stops_on_payload_without_start(spark, tmpdir_spark):
    from rivalry.operators.quality import QualityGateError
    from rivalry.plans.loads import daily_load
    from rivalry.sources.partitioned import write_partitioned
    base = local(tmpdir_spark("landing"))
    write_text(f"{base}/a.json", PAYLOAD.replace('"start": "2024-01-05T02:00:00.000Z"', '"start": null'))
    table = tmpdir_spark("games")
    write_partitioned(games_df(spark, [("2024-01-01", "s", "A", "B", 1, 2)]), table)
    with pytest.raises(QualityGateError):
        daily_load(spark, base, table, multiline=True)
    # non-strict: the game without a start keeps the requested date (one day touched)
    assert daily_load(spark, base, table, multiline=True, strict=False) == 1


def test_failed_publish_attempt_is_ignored(spark, tmpdir_spark):
    root = tmpdir_spark("vt")
    t = VersionedTable(spark, root)
    t.publish(games_df(spark, [("2020-01-01", "s", "A", "B", 1, 2)]))
    # an attempt that died after writing part of its folder, before its marker
    os.makedirs(local(f"{root}/v-00000002-deadbeef0000"), exist_ok=True)
    assert t.current_version() == 1 and t.read().count() == 1
    assert t.publish(games_df(spark, [("2020-01-02", "s", "A", "B", 3, 4)] * 2)) == 2
    assert t.read().count() == 2 and t.read(1).count() == 1


def test_csv_gzip_read_in_place(spark, tmpdir_spark):
    import gzip
    base = local(tmpdir_spark("csvgz"))
    os.makedirs(base, exist_ok=True)
    with gzip.open(f"{base}/games.csv.gz", "wt") as f:
        f.write(HEADER + "2020-01-01,2019-2020,A,B,100,90\n2020-01-02,2019-2020,B,A,80,85\n")
    rows = sorted((r.home_team, r.home_score) for r in read_games_csv(spark, base).collect())
    assert rows == [("A", 100), ("B", 80)]


@pytest.mark.parametrize("old, new", [
    ('"points": 100', '"points": "n/a"'), ('"points": 100', '"points": "101"'), ('"season": 2023', '"season": "x"')])
def test_a_value_of_another_type_stops_the_load(spark, tmpdir_spark, old, new):
    from rivalry.plans.loads import daily_load, read_table
    from rivalry.sources.partitioned import write_partitioned
    base, table = local(tmpdir_spark("landing")), tmpdir_spark("games")
    write_text(f"{base}/a.json", PAYLOAD.replace(old, new))
    write_partitioned(games_df(spark, [("2024-01-01", "s", "A", "B", 1, 2)]), table)
    with pytest.raises(Exception):
        daily_load(spark, base, table, multiline=True)
    assert read_table(spark, table).count() == 1


def test_a_document_cut_short_stops_the_load(spark, tmpdir_spark):
    from rivalry.plans.loads import daily_load
    base = local(tmpdir_spark("landing"))
    write_text(f"{base}/a.json", PAYLOAD[:-40])
    with pytest.raises(Exception):
        daily_load(spark, base, tmpdir_spark("games"), multiline=True)


@pytest.mark.parametrize("old, new", [('"parameters": {"date": "2024-01-05"}', '"parameters": {}'),
                                      ('"parameters": {"date": "2024-01-05"}', '"parameters": {"date": "soon"}'),
                                      ('"status": {"long": "Scheduled"}', '"status": {}')])
def test_gate_counts_missing_request_date_and_status(spark, tmpdir_spark, old, new):
    from rivalry.operators.quality import QualityGateError, gate
    from rivalry.sources.payload import payload_report
    base = local(tmpdir_spark("landing"))
    assert old in PAYLOAD
    write_text(f"{base}/a.json", PAYLOAD.replace(old, new))
    with pytest.raises(QualityGateError):
        gate(payload_report(read_payloads(spark, base, multiline=True)))


def test_of_two_documents_for_one_date_the_later_file_wins(spark, tmpdir_spark):
    base = local(tmpdir_spark("landing"))
    write_text(f"{base}/z.json", PAYLOAD.replace('"points": 100', '"points": 110'))
    write_text(f"{base}/a.json", PAYLOAD.replace('"points": 100', '"points": 101'))
    os.utime(f"{base}/z.json", (1_700_000_000, 1_700_000_000))
    os.utime(f"{base}/a.json", (1_700_000_100, 1_700_000_100))
    got = latest_per_key(flatten_payloads(read_payloads(spark, base, multiline=True))).collect()
    assert {r.home_team: r.home_score for r in got} == {"A": 101, "E": 90}


def test_a_run_loads_its_processing_date(spark, tmpdir_spark):
    from rivalry.plans.loads import daily_load, read_table
    from rivalry.sources.partitioned import write_partitioned
    base, table = local(tmpdir_spark("landing")), tmpdir_spark("games")
    write_text(f"{base}/a.json", PAYLOAD)
    write_text(f"{base}/b.json", PAYLOAD.replace("2024-01-05", "2024-02-05"))
    write_partitioned(games_df(spark, [("2024-01-01", "s", "A", "B", 1, 2)]), table)
    daily_load(spark, base, table, multiline=True, run_date=dt.date(2024, 1, 6))
    assert {str(r.date) for r in read_table(spark, table).collect()} == {"2024-01-01", "2024-01-04", "2024-01-05"}


def test_an_empty_marker_is_no_version(spark, tmpdir_spark):
    root = tmpdir_spark("vt")
    t = VersionedTable(spark, root)
    t.publish(games_df(spark, [("2020-01-01", "s", "A", "B", 1, 2)]))
    open(local(f"{root}/_versions/2"), "w").close()  # a publish that died between create and write
    assert t.current_version() == 1 and t.read().count() == 1
    assert t.publish(games_df(spark, [("2020-01-02", "s", "A", "B", 3, 4)] * 2)) == 3 and t.read().count() == 2


def test_real_columns_named_like_a_unit_are_kept(spark, tmpdir_spark):
    t = VersionedTable(spark, tmpdir_spark("vt"))
    t.publish(spark.createDataFrame([(1, "May")], "id int, month string"))
    assert t.read().columns == ["id", "month"]


@pytest.mark.parametrize("params", ["{}", '{"date": "soon"}', '{"date": null}'])
def test_undated_documents_reach_the_gate_of_every_run(spark, tmpdir_spark, params):
    from rivalry.operators.quality import QualityGateError
    from rivalry.plans.loads import daily_load, read_table
    base, table = local(tmpdir_spark("landing")), tmpdir_spark("games")
    write_text(f"{base}/a.json", PAYLOAD)
    write_text(f"{base}/b.json", PAYLOAD.replace('{"date": "2024-01-05"}', params))
    write_partitioned(games_df(spark, [("2024-01-01", "s", "A", "B", 1, 2)]), table)
    for run_date in (None, dt.date(2024, 1, 6), dt.date(2023, 5, 5)):
        with pytest.raises(QualityGateError):
            daily_load(spark, base, table, multiline=True, run_date=run_date)
    assert read_table(spark, table).count() == 1
