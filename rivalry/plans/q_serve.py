"""Queries over the serving path (request parsing, lookups, reply text)."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from rivalry.functions.dates import parse_ymd
from rivalry.functions.text import normalize_season, split_request
from rivalry.operators import serve as S
from rivalry.operators.resolve import exact_lookup
from rivalry.plans import fixtures as X
from rivalry.plans import oracle as O
from rivalry.plans.catalog import register
from rivalry.plans.models import build_biggest_win_loss, build_team_season_stats
from rivalry.plans.oracle_weighted import best_ctes
from rivalry.session import work_dir
from rivalry.sources.partitioned import write_partitioned

REQUESTS = """
SELECT request_id, kind, CASE WHEN request_id % 17 = 0 THEN chr(9) || chr(9)
       WHEN request_id % 7 = 1 THEN replace(words, ' ', chr(9)) WHEN request_id % 7 = 2 THEN words || chr(10)
       WHEN request_id % 7 = 3 THEN chr(9) || words ELSE words END AS text
FROM (SELECT request_id, kind, CASE WHEN request_id % 13 = 0 THEN season_txt ELSE team_txt || ' ' || season_txt END AS words
FROM (SELECT c_custkey AS request_id,
             CASE c_custkey % 3 WHEN 0 THEN 'seasonperformance' WHEN 1 THEN 'biggestwin' ELSE 'biggestloss' END AS kind,
             CASE c_custkey % 4 WHEN 0 THEN lower(n_name) WHEN 1 THEN replace(lower(n_name), '_', ' ')
                  WHEN 2 THEN replace(n_name, 'A', '') ELSE 'club ' || CAST(c_custkey AS VARCHAR) END AS team_txt,
             CASE (c_custkey // 4) % 3 WHEN 0 THEN CAST(1994 + c_custkey % 9 AS VARCHAR)
                  WHEN 1 THEN CAST(1994 + c_custkey % 9 AS VARCHAR) || '-' || CAST(1995 + c_custkey % 9 AS VARCHAR)
                  ELSE CAST(1994 + c_custkey % 9 AS VARCHAR) || 'x' END AS season_txt
      FROM customer JOIN nation ON c_nationkey = n_nationkey))
"""
ALIAS_NATION = """
SELECT lower(n_name) AS alias, n_name AS canonical, CAST(n_nationkey AS BIGINT) * 1000000 AS ord FROM nation
UNION ALL
SELECT replace(lower(n_name), '_', ' ') AS alias, n_name AS canonical, CAST(n_nationkey AS BIGINT) * 1000000 + 1 AS ord FROM nation
"""
PARSED = r"""
SELECT request_id, kind, n >= 2 AS ok,
       CASE WHEN n >= 2 THEN array_to_string(tok[1:n-1], ' ') END AS team_txt,
       CASE WHEN n >= 2 THEN tok[n] END AS season_txt
FROM (SELECT *, len(tok) AS n FROM (SELECT *, regexp_extract_all(text, '[^\s]+') AS tok FROM requests))
"""


def season_sql(s: str) -> str:
    num = f"CAST(regexp_replace({s}, '[\\s+_]', '', 'g') AS DECIMAL(38,0))"
    return (f"(CASE WHEN strpos({s}, '-') > 0 THEN {s} "
            f"WHEN regexp_full_match({s}, '\\s*\\+?[0-9]+(_[0-9]+)*\\s*') "
            f"THEN CAST({num} AS VARCHAR) || '-' || CAST({num} + 1 AS VARCHAR) END)")


def lev_sql(q: str, a: str) -> str:
    m = f"greatest(length({q}), length({a}))"
    return (f"(CASE WHEN {m} > 0 THEN CAST(100 * ({m} - levenshtein({q}, {a})) AS DOUBLE) / "
            f"CAST({m} AS DOUBLE) ELSE 0.0 END)")


def best_alias_sql(inputs: str, dim: str) -> str:
    """Top-1 alias per distinct lower-cased input; accepted iff score > 70."""
    return f"""
SELECT q, CASE WHEN score > 70 THEN canonical END AS canonical, score FROM (
  SELECT q, canonical, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, ord, alias) AS rn
  FROM (SELECT i.q, d.alias, d.canonical, d.ord, {lev_sql('i.q', 'd.alias')} AS score
        FROM {inputs} i, {dim} d)) WHERE rn = 1
"""


PCT = ("CAST(CAST(ROUND(win_percentage * 1000) AS BIGINT) // 10 AS VARCHAR) || '.' || "
       "CAST(CAST(ROUND(win_percentage * 1000) AS BIGINT) % 10 AS VARCHAR) || '%'")
CAP = "upper(substr(home_away_status, 1, 1)) || lower(substr(home_away_status, 2))"

MODEL_CTES = {"games": O.GAMES, "team_results": O.team_results_sql("games"),
              "stats": O.team_season_stats_sql("team_results"),
              "extremes": O.biggest_win_loss_sql("team_results")}
RESOLVED_CTES = {"requests": REQUESTS, "alias_dim": ALIAS_NATION, "parsed": PARSED,
                 "inp": "SELECT DISTINCT lower(team_txt) AS q FROM parsed WHERE ok",
                 "best": best_alias_sql("inp", "alias_dim"),
                 "res": f"SELECT p.request_id, p.kind, p.ok, b.canonical AS team, "
                        f"{season_sql('p.season_txt')} AS season FROM parsed p "
                        f"LEFT JOIN best b ON lower(p.team_txt) = b.q",
                 "st": "SELECT *, CASE WHEN NOT ok THEN 'invalid_request' WHEN team IS NULL THEN "
                       "'invalid_team' WHEN season IS NULL THEN 'invalid_season' END AS bad FROM res"}

ANSWER_BODY = f"""
SELECT request_id, kind, bad AS status, team, season, NULL::BIGINT AS total_games, NULL::BIGINT AS total_wins,
       NULL::BIGINT AS total_losses, NULL::VARCHAR AS win_pct_text, NULL::DOUBLE AS avg_ppg,
       NULL::DOUBLE AS avg_ppg_in_wins, NULL::DOUBLE AS avg_ppg_in_losses, NULL::DOUBLE AS avg_points_allowed, NULL::DOUBLE AS avg_points_allowed_in_wins, NULL::DOUBLE AS avg_points_allowed_in_losses, NULL::DATE AS date,
       NULL::VARCHAR AS opponent_team, NULL::VARCHAR AS home_away, NULL::INTEGER AS points_scored,
       NULL::INTEGER AS opponent_score, NULL::VARCHAR AS margin_text
FROM st WHERE bad IS NOT NULL
UNION ALL
SELECT r.request_id, r.kind, CASE WHEN s.team IS NULL THEN 'no_data' ELSE 'ok' END, r.team, r.season,
       s.total_games, s.total_wins, s.total_losses, {PCT}, s.avg_ppg,
       s.avg_ppg_in_wins, s.avg_ppg_in_losses, s.avg_points_allowed, s.avg_points_allowed_in_wins, s.avg_points_allowed_in_losses, NULL, NULL, NULL, NULL, NULL, NULL
FROM st r LEFT JOIN stats s ON r.team = s.team AND r.season = s.season
WHERE r.bad IS NULL AND r.kind = 'seasonperformance'
UNION ALL
SELECT r.request_id, r.kind, CASE WHEN e.team IS NULL THEN 'no_data' ELSE 'ok' END, r.team, r.season,
       NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, e.date, e.opponent_team, CASE WHEN e.team IS NOT NULL THEN {CAP} END,
       e.points_scored, e.opponent_score, '+' || CAST(e.point_margin AS VARCHAR)
FROM st r LEFT JOIN (SELECT * FROM extremes WHERE margin_type = 'biggest_win') e
  ON r.team = e.team AND r.season = e.season
WHERE r.bad IS NULL AND r.kind = 'biggestwin'
UNION ALL
SELECT r.request_id, r.kind, CASE WHEN e.team IS NULL THEN 'no_data' ELSE 'ok' END, r.team, r.season,
       NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, e.date, e.opponent_team, CASE WHEN e.team IS NOT NULL THEN {CAP} END,
       e.points_scored, e.opponent_score, CAST(e.point_margin AS VARCHAR)
FROM st r LEFT JOIN (SELECT * FROM extremes WHERE margin_type = 'biggest_loss') e
  ON r.team = e.team AND r.season = e.season
WHERE r.bad IS NULL AND r.kind = 'biggestloss'
"""
ANSWER_SQL = O.with_ctes(ANSWER_BODY, **MODEL_CTES, **RESOLVED_CTES)


def _weighted_ctes() -> dict[str, str]:
    out = {}
    for name, sql in RESOLVED_CTES.items():
        out |= best_ctes("inp", "alias_dim") if name == "best" else {name: sql}
    return out


WEIGHTED_ANSWER_SQL = O.with_ctes(ANSWER_BODY, **MODEL_CTES, **_weighted_ctes())


def _models(spark, sf_dir):
    g = X.games(spark, sf_dir)
    return build_team_season_stats(g), build_biggest_win_loss(g)


@register("answer_requests", ANSWER_SQL)
def q_answer_requests(spark, sf_dir):
    stats, extremes = _models(spark, sf_dir)
    return S.answer_requests(X.requests(spark, sf_dir), stats, extremes,
                             X.alias_dim_nation(spark, sf_dir))


@register("request_parse", O.with_ctes(
    "SELECT request_id, ok, team_txt AS team_text, season_txt AS season_text FROM parsed",
    requests=REQUESTS, parsed=PARSED))
def q_request_parse(spark, sf_dir):
    r = X.requests(spark, sf_dir)
    ok, team, season = split_request(F.col("text"))
    return r.select("request_id", ok.alias("ok"), team.alias("team_text"), season.alias("season_text"))


@register("alias_exact", O.with_ctes(
    "SELECT p.request_id, p.team_txt AS team_text, d.canonical FROM parsed p "
    "LEFT JOIN alias_dim d ON lower(p.team_txt) = d.alias",
    requests=REQUESTS, parsed=PARSED, alias_dim=ALIAS_NATION))
def q_alias_exact(spark, sf_dir):
    r = X.requests(spark, sf_dir)
    _, team, _ = split_request(F.col("text"))
    r = r.select("request_id", team.alias("team_text"))
    return exact_lookup(r, "team_text", X.alias_dim_nation(spark, sf_dir))


@register("season_normalize", f"""
WITH t AS (SELECT c_custkey AS id, CAST(1994 + c_custkey % 9 AS VARCHAR) AS y, c_custkey % 7 AS v FROM customer),
s AS (SELECT id, CASE v WHEN 0 THEN y WHEN 1 THEN y || '-' || CAST(CAST(y AS INTEGER) + 1 AS VARCHAR)
                        WHEN 2 THEN substr(y, 1, 2) || 'x' || substr(y, 4, 1) WHEN 3 THEN '+' || y
                        WHEN 4 THEN ' ' || y || ' ' WHEN 5 THEN substr(y, 1, 1) || '_' || substr(y, 2, 3)
                        ELSE '-5' END AS text FROM t)
SELECT id, text, {season_sql('text')} AS season FROM s""")
def q_season_normalize(spark, sf_dir):
    s = X.season_texts(spark, sf_dir)
    return s.select("id", "text", normalize_season(F.col("text")).alias("season"))


DATE_REQ = """
SELECT o_orderkey AS request_id,
       CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
            WHEN 1 THEN CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(month(o_orderdate) AS VARCHAR) || '-' || CAST(day(o_orderdate) AS VARCHAR)
            WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y')
            ELSE CAST(year(o_orderdate) AS VARCHAR) || '-02-30' END AS text
FROM orders
"""
DATE_PARSED = """
SELECT request_id, text,
       CASE WHEN regexp_full_match(text, '[0-9]{4}-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])')
            THEN TRY_CAST(replace(text, '- ', '-0') AS DATE) END AS date
FROM date_req
"""


@register("date_parse", O.with_ctes("SELECT * FROM date_parsed", date_req=DATE_REQ, date_parsed=DATE_PARSED))
def q_date_parse(spark, sf_dir):
    r = X.date_requests(spark, sf_dir)
    return r.select("request_id", "text", parse_ymd(F.col("text")).alias("date"))


@register("games_on_date", O.with_ctes("""
SELECT r.request_id, CASE WHEN r.date IS NULL THEN 'invalid_date' WHEN g.date IS NULL THEN 'no_data' ELSE 'ok' END AS status,
       r.date, g.season, g.home_team, g.home_score, g.away_team, g.away_score
FROM date_parsed r LEFT JOIN games g ON r.date = g.date""", games=O.GAMES, date_req=DATE_REQ, date_parsed=DATE_PARSED))
def q_games_on_date(spark, sf_dir):
    return S.games_on_dates(X.date_requests(spark, sf_dir), X.games(spark, sf_dir))


@register("games_on_date_pruned", O.with_ctes("""
SELECT r.request_id, CASE WHEN r.date IS NULL THEN 'invalid_date' WHEN g.date IS NULL THEN 'no_data' ELSE 'ok' END AS status,
       r.date, g.season, g.home_team, g.home_score, g.away_team, g.away_score
FROM date_parsed r LEFT JOIN games g ON r.date = g.date""", games=O.GAMES, date_req=DATE_REQ, date_parsed=DATE_PARSED))
def q_games_on_date_pruned(spark, sf_dir):
    """The batch date lookup over the partitioned fact table, pruned to the requested dates' partitions."""
    table = work_dir(spark, "games")
    write_partitioned(X.games(spark, sf_dir), table, unit="month")
    return S.games_on_dates_of(spark, table, X.date_requests(spark, sf_dir))


@register("games_on_one_date", O.with_ctes(
    "SELECT season, home_team, home_score, away_team, away_score FROM games WHERE date = (SELECT max(date) FROM games)",
    games=O.GAMES))
def q_games_on_one_date(spark, sf_dir):
    """The single-date lookup, on the last day of the fact table."""
    games, table = X.games(spark, sf_dir), work_dir(spark, "games")
    write_partitioned(games, table, unit="month")
    return S.games_on_date(spark, table, games.agg(F.max("date")).first()[0])


def _placed(ordered, *group):
    """The presented rows with their place: by ids that follow the order of the sorted rows' partitions."""
    at = ordered.withColumn("_at", F.monotonically_increasing_id())
    return at.withColumn("place", F.row_number().over(Window.partitionBy(*group).orderBy("_at"))).drop("_at")


@register("present_stats", O.with_ctes(
    "SELECT *, CAST(row_number() OVER (PARTITION BY team ORDER BY season NULLS FIRST) AS INTEGER) AS place FROM stats", **MODEL_CTES))
def q_present_stats(spark, sf_dir):
    """Season stats in presentation order; ``place`` is a row's place among its team's."""
    return _placed(S.presented_stats(build_team_season_stats(X.games(spark, sf_dir))), "team")


@register("present_extremes", O.with_ctes(
    "SELECT *, CAST(row_number() OVER (PARTITION BY team, season ORDER BY CASE margin_type WHEN 'biggest_win' THEN 0 ELSE 1 END, "
    "date NULLS FIRST, opponent_team NULLS FIRST, home_away_status) AS INTEGER) AS place FROM extremes", **MODEL_CTES))
def q_present_extremes(spark, sf_dir):
    """Biggest wins before biggest losses; ``place`` is a row's place in its team's season."""
    return _placed(S.presented_extremes(build_biggest_win_loss(X.games(spark, sf_dir))), "team", "season")


@register("game_card", O.with_ctes(
    "SELECT date, home_team, away_team, home_team || ' vs ' || away_team AS title, "
    "'Score: ' || CAST(home_score AS VARCHAR) || ' - ' || CAST(away_score AS VARCHAR) AS score_line FROM games",
    games=O.GAMES))
def q_game_card(spark, sf_dir):
    return S.game_card(X.games(spark, sf_dir))


@register("performance_card", O.with_ctes(
    f"SELECT team, season, total_games, total_wins, total_losses, {PCT} AS win_pct_text, "
    "avg_ppg, avg_ppg_in_wins, avg_ppg_in_losses, avg_points_allowed, avg_points_allowed_in_wins, avg_points_allowed_in_losses FROM stats", **MODEL_CTES))
def q_performance_card(spark, sf_dir):
    return S.performance_card(build_team_season_stats(X.games(spark, sf_dir)))


@register("extreme_card", O.with_ctes(
    f"SELECT team, season, margin_type, date, opponent_team, {CAP} AS home_away, "
    "CASE WHEN margin_type = 'biggest_win' THEN '+' || CAST(point_margin AS VARCHAR) "
    "ELSE CAST(point_margin AS VARCHAR) END AS margin_text FROM extremes", **MODEL_CTES))
def q_extreme_card(spark, sf_dir):
    return S.extreme_card(build_biggest_win_loss(X.games(spark, sf_dir)))


def _valid_keys(spark, sf_dir):
    p = S.parse_requests(X.requests(spark, sf_dir), X.alias_dim_nation(spark, sf_dir))
    return p.filter(F.col("status").isNull()).select("request_id", "kind", "team", "season")


@register("season_performance", O.with_ctes(
    "SELECT r.request_id, s.* FROM st r JOIN stats s ON r.team = s.team AND r.season = s.season "
    "WHERE r.bad IS NULL AND r.kind = 'seasonperformance'", **MODEL_CTES, **RESOLVED_CTES))
def q_season_performance(spark, sf_dir):
    keys = _valid_keys(spark, sf_dir).filter(F.col("kind") == S.KIND_PERFORMANCE)
    stats = build_team_season_stats(X.games(spark, sf_dir))
    return S.lookup_stats(keys.select("request_id", "team", "season"), stats)


def _extreme_sql(mtype: str, kind: str) -> str:
    return O.with_ctes(
        "SELECT r.request_id, e.* FROM st r JOIN extremes e ON r.team = e.team AND r.season = e.season "
        f"WHERE r.bad IS NULL AND r.kind = '{kind}' AND e.margin_type = '{mtype}'",
        **MODEL_CTES, **RESOLVED_CTES)


@register("biggest_win", _extreme_sql("biggest_win", "biggestwin"))
def q_biggest_win(spark, sf_dir):
    keys = _valid_keys(spark, sf_dir).filter(F.col("kind") == S.KIND_WIN)
    ex = build_biggest_win_loss(X.games(spark, sf_dir))
    return S.lookup_extremes(keys.select("request_id", "team", "season"), ex, "biggest_win")


@register("biggest_loss", _extreme_sql("biggest_loss", "biggestloss"))
def q_biggest_loss(spark, sf_dir):
    keys = _valid_keys(spark, sf_dir).filter(F.col("kind") == S.KIND_LOSS)
    ex = build_biggest_win_loss(X.games(spark, sf_dir))
    return S.lookup_extremes(keys.select("request_id", "team", "season"), ex, "biggest_loss")


@register("answer_requests_weighted", WEIGHTED_ANSWER_SQL)
def q_answer_requests_weighted(spark, sf_dir):
    """``answer_requests`` with the weighted-ratio scorer."""
    stats, extremes = _models(spark, sf_dir)
    return S.answer_requests(X.requests(spark, sf_dir), stats, extremes,
                             X.alias_dim_nation(spark, sf_dir), scorer="weighted")
