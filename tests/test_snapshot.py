import datetime as dt

from pyspark.sql import functions as F

from rivalry.operators.snapshot import as_of, current_rows, snapshot

T1, T2, T3 = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"
SCHEMA = "k string, v int"


def src(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted((r.k, r.v, str(r.valid_from), str(r.valid_to)) for r in df.collect())


def test_check_strategy_changed_new_gone_unchanged(spark):
    s1 = snapshot(None, src(spark, [("a", 1), ("b", 2), ("c", None)]), ["k"], T1)
    s2 = snapshot(s1, src(spark, [("a", 1), ("b", 3), ("c", None), ("d", 4)]), ["k"], T2)
    assert rows_of(s2) == [
        ("a", 1, "2024-01-01 00:00:00", "None"),
        ("b", 2, "2024-01-01 00:00:00", "2024-01-02 00:00:00"),
        ("b", 3, "2024-01-02 00:00:00", "None"),
        ("c", None, "2024-01-01 00:00:00", "None"),   # NULL == NULL: unchanged
        ("d", 4, "2024-01-02 00:00:00", "None"),
    ]


def test_rerun_same_source_changes_nothing_and_one_open_row_per_key(spark):
    source = src(spark, [("a", 1), ("b", 2)])
    s1 = snapshot(None, source, ["k"], T1)
    s2 = snapshot(snapshot(s1, src(spark, [("a", 5), ("b", 2)]), ["k"], T2), src(spark, [("a", 5), ("b", 2)]), ["k"], T3)
    assert rows_of(snapshot(s1, source, ["k"], T2)) == rows_of(s1)
    assert current_rows(s2).groupBy("k").count().filter(F.col("count") > 1).count() == 0
    assert s2.count() == 3


def test_missing_key_kept_open_or_closed_with_hard_deletes(spark):
    s1 = snapshot(None, src(spark, [("a", 1), ("b", 2)]), ["k"], T1)
    soft = snapshot(s1, src(spark, [("a", 1)]), ["k"], T2)
    hard = snapshot(s1, src(spark, [("a", 1)]), ["k"], T2, hard_deletes=True)
    assert ("b", 2, "2024-01-01 00:00:00", "None") in rows_of(soft)
    assert ("b", 2, "2024-01-01 00:00:00", "2024-01-02 00:00:00") in rows_of(hard)


def test_timestamp_strategy_and_reappearing_key(spark):
    schema = "k string, d date, v int"
    d = dt.date(2023, 12, 30)
    kw = dict(strategy="timestamp", updated_at="d", hard_deletes=True)
    s1 = snapshot(None, spark.createDataFrame([("a", d, 1)], schema), ["k", "d"], T1, **kw)
    assert str(s1.first().valid_from) == "2023-12-30 00:00:00"
    # same key, corrected value, same date: never versioned (date is in the key)
    s2 = snapshot(s1, spark.createDataFrame([("a", d, 9)], schema), ["k", "d"], T2, **kw)
    assert [(r.v, r.valid_to) for r in s2.collect()] == [(1, None)]
    # deleted, then reappears: new version starts after the close
    s3 = snapshot(s2, spark.createDataFrame([], schema), ["k", "d"], T3, **kw)
    s4 = snapshot(s3, spark.createDataFrame([("a", d, 9)], schema), ["k", "d"], "2024-01-04", **kw)
    got = sorted((r.v, str(r.valid_from), str(r.valid_to)) for r in s4.collect())
    assert got == [(1, "2023-12-30 00:00:00", "2024-01-03 00:00:00"),
                   (9, "2024-01-03 00:00:00", "None")]
    assert s4.select("scd_id").distinct().count() == 2


def test_as_of(spark):
    s1 = snapshot(None, src(spark, [("a", 1)]), ["k"], T1)
    s2 = snapshot(s1, src(spark, [("a", 2)]), ["k"], T2)
    assert [r.v for r in as_of(s2, "2024-01-01 12:00:00").collect()] == [1]
    assert [r.v for r in as_of(s2, T2).collect()] == [2]
    assert as_of(s2, "2023-12-31").count() == 0
