"""Queries over ingest: CSV load, payload flatten, MERGE, daily load, stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivalry.functions.dates import game_date, previous_day_text
from rivalry.functions.text import season_label
from rivalry.operators.upsert import merge_conflicts, merge_upsert
from rivalry.plans import fixtures as X
from rivalry.plans import oracle as O
from rivalry.plans.catalog import register
from rivalry.plans.loads import daily_load, full_refresh, read_table, upsert_into
from rivalry.schemas import GAMES_COLS
from rivalry.session import work_dir
from rivalry.sources.csv import write_games_csv
from rivalry.sources.payload import LANDED, flatten_payloads, latest_per_key, read_payloads
from rivalry.sources.partitioned import write_partitioned
from rivalry.sources.tables import TableRegistry, read_table as read_src
from rivalry.streaming.ingest import ingest

# The fixture loads replay every date at once (a backfill of a small table),
# so they store months; production daily increments use the default, days.
FIXTURE_UNIT = "month"

KEYS_EQ = "t.date = s.date AND t.home_team = s.home_team AND t.away_team = s.away_team"


def merge_sql(target: str, stage: str) -> str:
    return f"""
SELECT t.date, CASE WHEN s.hit THEN s.season ELSE t.season END AS season, t.home_team, t.away_team,
       CASE WHEN s.hit THEN s.home_score ELSE t.home_score END AS home_score,
       CASE WHEN s.hit THEN s.away_score ELSE t.away_score END AS away_score
FROM {target} t LEFT JOIN (SELECT *, TRUE AS hit FROM {stage}) s ON {KEYS_EQ}
UNION ALL
SELECT s.date, s.season, s.home_team, s.away_team, s.home_score, s.away_score FROM {stage} s
WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {KEYS_EQ})
"""


MERGE_TARGET = "SELECT * FROM games WHERE home_score % 5 <> 0"
MERGE_STAGE = ("SELECT date, season, home_team, away_team, CAST(home_score + 1 AS INTEGER) AS home_score, "
               "away_score FROM games WHERE home_score % 3 = 0")
STAGE_RAW = """
SELECT CASE WHEN (home_score * 3 + away_score) % 24 < 8 THEN CAST(date - INTERVAL 1 DAY AS DATE)
            ELSE date END AS date,
       CAST(CAST(substr(season, 1, 4) AS INTEGER) AS VARCHAR) || '-' ||
       CAST(CAST(substr(season, 1, 4) AS INTEGER) + 1 AS VARCHAR) AS season,
       home_team, away_team, home_score, away_score, date AS request_date
FROM games WHERE (home_score + away_score) % 11 <> 0
"""
STAGE_LATEST = """
SELECT date, season, home_team, away_team, home_score, away_score FROM (
  SELECT *, row_number() OVER (PARTITION BY date, home_team, away_team ORDER BY request_date DESC) AS rn
  FROM stage_raw) WHERE rn = 1
"""
DAILY_SQL = O.with_ctes(merge_sql("target", "stage"), games=O.GAMES, target=MERGE_TARGET,
                        stage_raw=STAGE_RAW, stage=STAGE_LATEST)


@register("csv_bulk_load", O.with_ctes("SELECT * FROM games", games=O.GAMES))
def q_csv_bulk_load(spark, sf_dir):
    """Games -> headed CSV -> strict CSV load -> published date-partitioned version."""
    base = work_dir(spark, "csv")
    write_games_csv(X.games(spark, sf_dir), f"{base}/csv")
    full_refresh(spark, f"{base}/csv", f"{base}/table", unit=FIXTURE_UNIT)
    return read_table(spark, f"{base}/table")


@register("declared_source", O.with_ctes("SELECT * FROM games", games=O.GAMES))
def q_declared_source(spark, sf_dir):
    """The fact table read through its declared logical name."""
    path = work_dir(spark, "games")
    X.games(spark, sf_dir).write.parquet(path)
    return TableRegistry(spark).declare("raw_match_data", path).load("raw_match_data", *GAMES_COLS)


@register("payload_flatten", O.with_ctes("SELECT * FROM stage_raw", games=O.GAMES, stage_raw=STAGE_RAW))
def q_payload_flatten(spark, sf_dir):
    """Payload documents (JSON Lines, incl. empty/missing responses) -> staging rows."""
    path = work_dir(spark, "payloads")
    X.payload_documents(spark, sf_dir).write.json(path)
    return flatten_payloads(read_payloads(spark, path)).drop(*LANDED)


@register("merge_upsert", O.with_ctes(merge_sql("target", "stage"), games=O.GAMES,
                                      target=MERGE_TARGET, stage=MERGE_STAGE))
def q_merge_upsert(spark, sf_dir):
    return merge_upsert(X.merge_target(spark, sf_dir), X.merge_stage(spark, sf_dir))


@register("merge_conflicts", O.with_ctes(
    "SELECT s.date, s.home_team, s.away_team, COUNT(*) AS stage_rows FROM stage s "
    f"WHERE EXISTS (SELECT 1 FROM target t WHERE {KEYS_EQ}) "
    "GROUP BY s.date, s.home_team, s.away_team HAVING COUNT(*) > 1",
    games=O.GAMES, target=MERGE_TARGET, stage1=MERGE_STAGE,
    stage="SELECT * FROM stage1 UNION ALL SELECT date, season, home_team, away_team, home_score, "
          "CAST(away_score + 1 AS INTEGER) AS away_score FROM stage1 WHERE away_score % 7 = 0"))
def q_merge_conflicts(spark, sf_dir):
    return merge_conflicts(X.merge_target(spark, sf_dir), X.merge_stage_dups(spark, sf_dir))


@register("daily_load", DAILY_SQL)
def q_daily_load(spark, sf_dir):
    """Landed payloads upserted into the date-partitioned fact table."""
    base = work_dir(spark, "daily")
    X.payload_documents(spark, sf_dir).write.json(f"{base}/landing")
    write_partitioned(X.merge_target(spark, sf_dir), f"{base}/games", unit=FIXTURE_UNIT)
    daily_load(spark, f"{base}/landing", f"{base}/games")
    return read_table(spark, f"{base}/games")


@register("historical_then_daily", DAILY_SQL)
def q_historical_then_daily(spark, sf_dir):
    """Historical CSV load, then the daily payloads merged into the same table."""
    base = work_dir(spark, "history")
    write_games_csv(X.merge_target(spark, sf_dir), f"{base}/csv")
    full_refresh(spark, f"{base}/csv", f"{base}/games", unit=FIXTURE_UNIT)
    X.payload_documents(spark, sf_dir).write.json(f"{base}/landing")
    daily_load(spark, f"{base}/landing", f"{base}/games")
    return read_table(spark, f"{base}/games")


@register("stream_ingest", DAILY_SQL)
def q_stream_ingest(spark, sf_dir):
    """The daily load as an availableNow file stream with foreachBatch MERGE."""
    base = work_dir(spark, "stream")
    X.payload_documents(spark, sf_dir).write.json(f"{base}/landing")
    write_partitioned(X.merge_target(spark, sf_dir), f"{base}/games", unit=FIXTURE_UNIT)
    ingest(spark, f"{base}/landing", f"{base}/games", f"{base}/_checkpoint", multiline=False)
    return read_table(spark, f"{base}/games")


@register("stream_ingest_batches", DAILY_SQL)
def q_stream_ingest_batches(spark, sf_dir):
    """The same documents in several micro-batches, those of later requests first: the result is that of one load."""
    base = work_dir(spark, "batches")
    docs = X.payload_documents(spark, sf_dir)
    asked = F.col("parameters.date")
    # Files are taken in the order they landed.
    for i, (low, high) in enumerate([("1997-01-01", "9999"), ("1994-06-01", "1997-01-01"), ("0000", "1994-06-01")]):
        docs.filter((asked >= low) & (asked < high)).coalesce(1).write.mode("append").json(f"{base}/landing")
    write_partitioned(X.merge_target(spark, sf_dir), f"{base}/games", unit=FIXTURE_UNIT)
    ingest(spark, f"{base}/landing", f"{base}/games", f"{base}/_checkpoint", multiline=False, max_files_per_trigger=1)
    return read_table(spark, f"{base}/games")


@register("merge_atomic", O.with_ctes(
    "SELECT 1 AS version, * FROM target UNION ALL SELECT 2 AS version, * FROM merged",
    games=O.GAMES, target=MERGE_TARGET, stage=MERGE_STAGE, merged=merge_sql("target", "stage")))
def q_merge_atomic(spark, sf_dir):
    """The table before and after a MERGE: a frame opened before reads the old version, one opened after the new one."""
    path = work_dir(spark, "atomic")
    write_partitioned(X.merge_target(spark, sf_dir), path, unit=FIXTURE_UNIT)
    before = read_table(spark, path)
    upsert_into(spark, path, X.merge_stage(spark, sf_dir))
    after = read_table(spark, path)
    return before.select(F.lit(1).alias("version"), "*").unionByName(after.select(F.lit(2).alias("version"), "*"))


@register("game_date_shift", """
SELECT event_id, CAST(ts - INTERVAL 8 HOURS AS DATE) AS game_date,
       strftime(CAST(ts AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d') AS previous_day
FROM events""")
def q_game_date_shift(spark, sf_dir):
    ev = read_src(spark, sf_dir, "events", "event_id", "ts")
    return ev.select("event_id", game_date(F.to_date("ts"), F.col("ts")).alias("game_date"),
                     previous_day_text(F.to_date("ts")).alias("previous_day"))


@register("season_label", """
SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(year(o_orderdate) + 1 AS VARCHAR)
       AS season FROM orders""")
def q_season_label(spark, sf_dir):
    o = read_src(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    return o.select("o_orderkey", season_label(F.year("o_orderdate")).alias("season"))


# Fixed values of the incremental scenario: the increment is the payloads
# requested from the start of the 2000-2001 season on.
INCREMENT_FROM = "2000-10-01"


@register("refresh_incremental", O.with_ctes(
    O.team_season_stats_sql("team_results"), games=O.GAMES, target=MERGE_TARGET,
    stage_raw=STAGE_RAW.replace("WHERE (home_score + away_score) % 11 <> 0",
                                f"WHERE (home_score + away_score) % 11 <> 0 AND date >= DATE '{INCREMENT_FROM}'"),
    stage=STAGE_LATEST, merged=merge_sql("target", "stage"),
    team_results=O.team_results_sql("merged")))
def q_refresh_incremental(spark, sf_dir):
    """Models refreshed for the seasons an increment touches, after its MERGE."""
    from rivalry.plans import incremental as I
    from rivalry.plans.guard import materialize
    from rivalry.sources.payload import flatten_payloads, latest_per_key
    base = work_dir(spark, "incremental")
    fact, root = f"{base}/games", f"{base}/models"
    write_partitioned(X.merge_target(spark, sf_dir), fact, unit=FIXTURE_UNIT)
    I.publish_all(spark, I.current_fact(spark, fact), root)
    docs = X.payload_documents(spark, sf_dir).filter(
        F.col("parameters.date") >= F.lit(INCREMENT_FROM))
    stage = materialize(latest_per_key(flatten_payloads(docs)), "stage")
    seasons = I.touched_seasons(spark, fact, stage)
    upsert_into(spark, fact, stage)
    I.refresh_seasons(spark, fact, root, seasons, stage)
    return I.read_models(spark, root)["team_season_stats"]


EARLY_UNTIL = "1993-06-01"


def stage_where(name: str, condition: str) -> dict[str, str]:
    """CTEs of the stage of the documents that meet ``condition``, as ``name``."""
    raw = STAGE_RAW.replace("WHERE (home_score + away_score) % 11 <> 0",
                            f"WHERE (home_score + away_score) % 11 <> 0 AND {condition}")
    return {f"{name}_raw": raw, name: STAGE_LATEST.replace("stage_raw", f"{name}_raw")}


@register("refresh_recovered", O.with_ctes(
    O.team_season_stats_sql("team_results"), games=O.GAMES, target=MERGE_TARGET,
    **stage_where("late", f"date >= DATE '{INCREMENT_FROM}'"), **stage_where("early", f"date < DATE '{EARLY_UNTIL}'"),
    once=merge_sql("target", "late"), merged=merge_sql("once", "early"), team_results=O.team_results_sql("merged")))
def q_refresh_recovered(spark, sf_dir):
    """A cycle that stops after its MERGE, then one that brings other seasons: the models cover both."""
    from rivalry.plans import incremental as I
    base = work_dir(spark, "recovered")
    fact, root, asked = f"{base}/games", f"{base}/models", F.col("parameters.date")
    write_partitioned(X.merge_target(spark, sf_dir), fact, unit=FIXTURE_UNIT)
    I.publish_all(spark, I.current_fact(spark, fact), root)
    docs = X.payload_documents(spark, sf_dir)
    docs.filter(asked >= INCREMENT_FROM).write.json(f"{base}/late")
    docs.filter(asked < EARLY_UNTIL).write.json(f"{base}/early")
    I.daily_cycle(spark, f"{base}/late", fact, root, "2024-01-01 00:00:00", until="merged")
    I.daily_cycle(spark, f"{base}/early", fact, root, "2024-01-02 00:00:00")
    return I.read_models(spark, root)["team_season_stats"]


@register("refresh_delta", O.with_ctes(
    f"""SELECT s.*, e.margin_type, e.date, e.opponent_team, e.point_margin, c.total_close_games, c.avg_ppg_in_close_wins
FROM ({O.team_season_stats_sql("team_results")}) s
LEFT JOIN ({O.biggest_win_loss_sql("team_results")}) e ON s.team = e.team AND s.season = e.season
LEFT JOIN ({O.close_game_stats_sql("team_results")}) c ON s.team = c.team AND s.season = c.season""",
    games=O.GAMES, target=MERGE_TARGET, **stage_where("late", f"date >= DATE '{INCREMENT_FROM}'"),
    **stage_where("early", f"date < DATE '{EARLY_UNTIL}'"), once=merge_sql("target", "late"),
    merged=merge_sql("once", "early"), team_results=O.team_results_sql("merged")))
def q_refresh_delta(spark, sf_dir):
    """All models after two cycles that add what has changed to the state of the first build."""
    from rivalry.plans import incremental as I
    base = work_dir(spark, "delta")
    fact, root, asked = f"{base}/games", f"{base}/models", F.col("parameters.date")
    write_partitioned(X.merge_target(spark, sf_dir), fact, unit=FIXTURE_UNIT)
    I.publish_from(spark, fact, root)
    docs = X.payload_documents(spark, sf_dir)
    docs.filter(asked >= INCREMENT_FROM).write.json(f"{base}/late")
    docs.filter(asked < EARLY_UNTIL).write.json(f"{base}/early")
    I.daily_cycle(spark, f"{base}/late", fact, root, "2024-01-01 00:00:00")
    I.daily_cycle(spark, f"{base}/early", fact, root, "2024-01-02 00:00:00")
    m = I.read_models(spark, root)
    keys = ["team", "season"]
    extremes = m["team_season_biggest_win_loss"].select(*keys, "margin_type", "date", "opponent_team", "point_margin")
    close = m["close_game_season_stats"].select(*keys, "total_close_games", "avg_ppg_in_close_wins")
    return m["team_season_stats"].join(extremes, keys, "left").join(close, keys, "left")


# Fixed values of the NULL scenario: every fifth game has no date, every
# seventh no season; the increment moves games into and out of the NULL season.
NULLED = """
SELECT CASE WHEN home_score % 5 = 0 THEN NULL ELSE date END AS date,
       CASE WHEN away_score % 7 = 0 THEN NULL ELSE season END AS season, home_team, away_team, home_score, away_score
FROM games
"""
NULL_STAGE = f"""
SELECT date, CASE WHEN home_score % 2 = 0 THEN NULL ELSE season END AS season, home_team, away_team,
       CAST(home_score + 1 AS INTEGER) AS home_score, away_score
FROM games WHERE date >= DATE '{INCREMENT_FROM}' AND home_score % 5 <> 0 AND away_score % 3 = 0
"""


@register("refresh_incremental_nulls", O.with_ctes(
    O.team_season_stats_sql("team_results"), games=O.GAMES, target=NULLED, stage=NULL_STAGE,
    merged=merge_sql("target", "stage"), team_results=O.team_results_sql("merged")))
def q_refresh_incremental_nulls(spark, sf_dir):
    """The incremental refresh with facts that have no date or no season, and games that change to and from none."""
    from rivalry.plans import incremental as I
    from rivalry.plans.guard import materialize
    base = work_dir(spark, "incremental-nulls")
    fact, root = f"{base}/games", f"{base}/models"
    games = X.games(spark, sf_dir)
    write_partitioned(games.withColumns({
        "date": F.when(F.col("home_score") % 5 != 0, F.col("date")),
        "season": F.when(F.col("away_score") % 7 != 0, F.col("season"))}), fact, unit=FIXTURE_UNIT)
    I.publish_all(spark, I.current_fact(spark, fact), root)
    stage = materialize(
        games.filter((F.col("date") >= F.lit(INCREMENT_FROM)) & (F.col("home_score") % 5 != 0) & (F.col("away_score") % 3 == 0))
        .withColumns({"season": F.when(F.col("home_score") % 2 != 0, F.col("season")),
                      "home_score": (F.col("home_score") + 1).cast("int")}), "stage")
    seasons = I.touched_seasons(spark, fact, stage)
    upsert_into(spark, fact, stage)
    I.refresh_seasons(spark, fact, root, seasons, stage)
    return I.read_models(spark, root)["team_season_stats"]


@register("payload_latest_file", O.with_ctes(
    "SELECT date, season, home_team, away_team, CASE WHEN home_score % 3 = 0 THEN CAST(home_score - 9 AS INTEGER) "
    "ELSE home_score END AS home_score, away_score FROM stage",
    games=O.GAMES, stage_raw=STAGE_RAW, stage=STAGE_LATEST))
def q_payload_latest_file(spark, sf_dir):
    """Corrected documents for the same request dates that land later win, though their scores are smaller."""
    path = work_dir(spark, "corrected")
    docs = X.payload_documents(spark, sf_dir)
    docs.write.json(path)
    home = F.col("response")[0]["scores"]["home"]["points"]
    corrected = docs.filter((F.size("response") > 0) & (home % 3 == 0)).withColumn("response", F.transform(
        "response", lambda g: g.withField("scores.home.points", g["scores"]["home"]["points"] - 9)))
    corrected.write.mode("append").json(path)
    return latest_per_key(flatten_payloads(read_payloads(spark, path)))
