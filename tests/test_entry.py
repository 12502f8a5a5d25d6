import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["team", "season"] and df.count() > 0


def test_every_query_has_an_oracle_or_is_rows_only():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    from rivalry.plans import catalog
    assert set(catalog.queries()) <= set(sql)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple("NULL" if v is None else (repr(round(v, 9)) if isinstance(v, float) else str(v))
                         for v in r))
    return sorted(out)


@pytest.mark.parametrize("name", ["team_season_stats", "close_game_season_stats", "biggest_win_loss",
                                  "merge_upsert", "answer_requests", "snapshot_hard_delete",
                                  "payload_flatten", "fuzzy_resolve_lev", "dq_report"])
def test_oracle_agreement_small(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    spark_rows = [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]
    idx = [ocols.index(c) for c in sorted(ocols)]
    duck_rows = [tuple(r[i] for i in idx) for r in res.fetchall()]
    assert _norm(spark_rows) == _norm(duck_rows)
