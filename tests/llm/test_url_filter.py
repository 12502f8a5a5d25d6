import pytest

from rivalry.llm.url_filter import STRONGEST, estimate, url_filter

URLS = [(1, None, 1), (2, "", 1), (3, "no scheme", 1), (4, "HTTP://A.Net/x", 1), (5, "http://b.example.net/en/1?x#y", 1),
        (6, "http://example.com/de/x", 1), (7, "http://x.org/fr/a", 1), (8, "http://x.org", 1), (8, "http://x.org", 1),
        (9, "http://notnet/x", 1), (10, "http://a.net?q=/x", 1), (11, "http://h:80#f", None), (None, "http://1.2.3.4/a", 2),
        (12, "a://b://c/d", 1), (13, "http://sub.example.net/en", 1)]


@pytest.fixture(scope="module")
def judged(spark):
    pages = spark.createDataFrame([(*u, "?") for u in URLS], "page_id long, url string, k long, host string")
    outcomes = spark.createDataFrame([(1, False), (1, True), (2, None), (None, True)], "k long, bad boolean")
    return [tuple(r) for r in url_filter(pages, outcomes, "k").select("page_id", "host", "path", "rule", "verdict").collect()]


def test_parts_and_rules(judged):
    by = {r[0]: r[1:] for r in judged}
    assert len(judged) == len(URLS)
    assert by[1][:3] == by[2][:3] == by[3][:3] == ("", "", None)
    assert by[4] == ("a.net", "/x", "net/", "block")
    assert by[5] == ("b.example.net", "/en/1", "example.net/en/", "allow")
    assert by[6][2:] == ("example.com/de/", "block")
    assert by[7][2:] == ("org/fr/", "allow")
    assert by[8][2] is None and by[9][2] is None
    assert by[10][:3] == ("a.net", "", None)  # the path is empty: the rule's is not its start
    assert by[11][:2] == ("h:80", "")
    assert by[12][:2] == ("b:", "//c/d")
    assert by[13][2] == "net/"


def test_confidently_bad_hosts_are_blocked(spark):
    rows = [(i, f"http://{'bad' if i % 2 else 'good'}.site.info/{i}", i) for i in range(400)]
    rows += [(1000, "http://new.site.info/x", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, k long")
    outcomes = spark.createDataFrame([(i, bool(i % 2) and i % 20 != 1) for i in range(400)], "k long, bad boolean")
    got = {r.page_id: r for r in url_filter(pages, outcomes, "k").collect()}
    assert got[1].verdict == "block" and got[2].verdict == "allow" and got[1000].verdict == "allow"
    assert 0.5 < got[1].bad_lower < got[1].bad_share <= 0.9 and got[1].n_labelled == 200


def test_hosts_without_labels_have_the_prior_of_their_domain(spark):
    rows = [(i, f"http://h{i % 20}.{'bad' if i % 2 else 'good'}.info/{i}", i) for i in range(2000)]
    rows += [(5000, "http://new.bad.info/x", None), (5001, "http://new.good.info/x", None), (5002, "http://other.info/", None),
             (5003, "http://a.elsewhere.biz/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, k long")
    outcomes = spark.createDataFrame([(i, bool(i % 2) and i % 50 != 1) for i in range(2000)], "k long, bad boolean")
    got = {r.page_id: r for r in url_filter(pages, outcomes, "k").collect()}
    assert [got[i].verdict for i in range(5000, 5004)] == ["block", "allow", "allow", "allow"]
    assert got[5000].bad_lower > 0.5 and [got[i].n_labelled for i in range(5000, 5004)] == [0] * 4
    assert got[5001].bad_share < got[5002].bad_share < got[5000].bad_share


def test_shrinking_needs_evidence(spark):
    rows = [(i, f"http://h{i % 50}.site.info/{i}", i) for i in range(100)] + [(500, "http://once.site.info/", 500)]
    pages = spark.createDataFrame(rows, "page_id long, url string, k long")
    outcomes = spark.createDataFrame([(i, i % 10 == 0) for i in range(100)] + [(500, True)], "k long, bad boolean")
    got = {r.page_id: r for r in url_filter(pages, outcomes, "k").collect()}
    assert got[500].verdict == "allow" and got[500].bad_share < 0.9


def test_without_rows_or_labels(spark):
    pages = spark.createDataFrame([(1, "http://a.b/", 1)], "page_id long, url string, k long")
    none = spark.createDataFrame([], "k long, bad boolean")
    assert [r.verdict for r in url_filter(pages, none, "k").collect()] == ["allow"]
    assert url_filter(pages.where("false"), none, "k").count() == 0


def test_strength_estimate():
    assert estimate(0, 0, 0, 0.0, 0.0) == STRONGEST
    # Ten hosts of 100 pages, half all bad and half all good: hardly any shrinkage.
    assert estimate(1000, 500, 9, 250.0, 100.0) == 1.0


def test_the_sql_judges_hosts_without_labels_by_the_same_priors(spark, tmp_path):
    """New hosts of a bad domain, of a good one, of a known suffix and of none."""
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq
    from rivalry.llm import oracle
    from rivalry.llm.queries import op2_url_reputation
    urls = [f"http://h{i % 20}.{'bad' if i % 2 else 'good'}.info/{i}" for i in range(1200)]
    urls += ["http://new.bad.info/x", "http://new.good.info/", "http://a.other.info/9999999", "http://b.none.biz/x", "http://1.2.3.4/5", None, "x"]
    pq.write_table(pa.table({"page_id": list(range(len(urls))), "url": urls, "html": [""] * len(urls)}), tmp_path / "pages.parquet")
    pq.write_table(pa.table({"doc_id": list(range(1200)), "quality": [0 if i % 2 and i % 30 != 1 else 1 for i in range(1200)],
                             "toxic": [0] * 1200}), tmp_path / "labels.parquet")
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet')")
    columns = ["page_id", "host", "path", "rule", "verdict", "n_labelled"]
    want = sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({oracle.SQL['op2_url_reputation']})").fetchall(), key=repr)
    got = sorted((tuple(r) for r in op2_url_reputation(spark, str(tmp_path)).select(*columns).collect()), key=repr)
    assert got == want
    verdict = {r[0]: r[4] for r in got}
    assert verdict[1200] == "block" and verdict[1201] == verdict[1203] == "allow"
