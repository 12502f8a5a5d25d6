"""Table schemas and column-order contracts."""

from pyspark.sql import types as T

# Match fact: one row per contest, logical key (date, home_team, away_team).
GAMES = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("season", T.StringType()),
    T.StructField("home_team", T.StringType()),
    T.StructField("away_team", T.StringType()),
    T.StructField("home_score", T.IntegerType()),
    T.StructField("away_score", T.IntegerType()),
])
GAMES_COLS = [f.name for f in GAMES.fields]
GAME_KEY = ["date", "home_team", "away_team"]

# Of a fact row that came from a payload: the request and the landing that it came with.
MARKS = T.StructType([
    T.StructField("request_date", T.DateType()),
    T.StructField("file_time", T.TimestampType()),
    T.StructField("file_name", T.StringType()),
])
MARK_COLS = [f.name for f in MARKS.fields]
# The stored fact: the match columns, and the marks (null for rows that came from elsewhere).
FACT = T.StructType([*GAMES.fields, *MARKS.fields])
FACT_COLS = [f.name for f in FACT.fields]

# Per-participant view: two rows per contest.
TEAM_RESULTS_COLS = [
    "date", "season", "team", "opponent_team", "home_away_status",
    "result", "points_scored", "opponent_score",
]

TEAM_SEASON_STATS_COLS = [
    "team", "season", "total_games", "total_wins", "total_losses",
    "win_percentage", "avg_ppg", "avg_ppg_in_wins", "avg_ppg_in_losses",
    "avg_points_allowed", "avg_points_allowed_in_wins",
    "avg_points_allowed_in_losses",
]

CLOSE_GAME_STATS_COLS = [
    "team", "season", "total_close_games", "close_game_wins",
    "close_game_losses", "avg_points_scored_close_games",
    "avg_points_allowed_close_games", "avg_ppg_in_close_wins",
    "avg_ppg_in_close_losses",
]

BIGGEST_WIN_LOSS_COLS = [
    "team", "season", "margin_type", "date", "opponent_team",
    "home_away_status", "points_scored", "opponent_score", "point_margin",
]

# API payload as landed JSON: request parameters plus an array of games.
_TEAM = T.StructType([T.StructField("name", T.StringType())])
_POINTS = T.StructType([T.StructField("points", T.IntegerType())])
PAYLOAD_GAME = T.StructType([
    T.StructField("status", T.StructType([T.StructField("long", T.StringType())])),
    T.StructField("date", T.StructType([T.StructField("start", T.StringType())])),
    T.StructField("season", T.IntegerType()),
    T.StructField("teams", T.StructType([
        T.StructField("home", _TEAM), T.StructField("visitors", _TEAM)])),
    T.StructField("scores", T.StructType([
        T.StructField("home", _POINTS), T.StructField("visitors", _POINTS)])),
])
PAYLOAD = T.StructType([
    T.StructField("parameters", T.StructType([T.StructField("date", T.StringType())])),
    T.StructField("response", T.ArrayType(PAYLOAD_GAME)),
])

# SCD2 bookkeeping columns appended to every snapshot table.
SCD_COLS = ["scd_id", "updated_at", "valid_from", "valid_to"]
