"""Nested JSON API payloads -> staging rows.

A payload is ``{parameters: {date}, response: [game, ...]}``.  Landed API
files are one pretty-printed document each (``multiline=True``); bulk
exports are JSON Lines.  The schema is given, never inferred, and a document
that is cut short or holds a value of another type stops the read
(``FAILFAST``): nothing of it is loaded as NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivalry.functions.dates import game_date
from rivalry.functions.text import season_label
from rivalry.schemas import FACT_COLS, GAME_KEY, GAMES_COLS, MARKS, PAYLOAD

FINISHED = "Finished"


# When and as what a document landed, for the rule of the latest request.
LANDED = ["file_time", "file_name"]


def with_landing(payloads: DataFrame) -> DataFrame:
    """Payloads of a file source with the modification time and name of their file."""
    return payloads.select("*", F.col("_metadata.file_modification_time").alias("file_time"),
                           F.col("_metadata.file_name").alias("file_name"))


def read_payloads(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    return with_landing(spark.read.schema(PAYLOAD).option("multiLine", multiline)
                        .option("mode", "FAILFAST").json(path))


def requested_date(payloads: DataFrame):
    """The document's request date; NULL where it is missing or no date."""
    return F.try_to_date(payloads["parameters.date"], "yyyy-MM-dd")


def flatten_payloads(payloads: DataFrame) -> DataFrame:
    """One staging row per finished game, with ``request_date``.

    ``explode`` drops documents whose ``response`` is missing or empty, so
    they produce no rows.  The game date is the *requested* date, moved one
    day back when the start time is before 08:00 on its own clock (UTC-8).
    """
    g = F.col("g")
    landed = [c for c in LANDED if c in payloads.columns]
    exploded = payloads.select(F.col("parameters.date").alias("request_text"), *landed,
                               F.explode("response").alias("g"))
    return (exploded.filter(g["status"]["long"] == FINISHED)
            .select(game_date(F.col("request_text"), g["date"]["start"]).alias("date"),
                    season_label(g["season"]).alias("season"),
                    g["teams"]["home"]["name"].alias("home_team"),
                    g["teams"]["visitors"]["name"].alias("away_team"),
                    g["scores"]["home"]["points"].alias("home_score"),
                    g["scores"]["visitors"]["points"].alias("away_score"),
                    F.col("request_text").cast("date").alias("request_date"), *landed))


def payload_report(payloads: DataFrame) -> DataFrame:
    """Data tests on finished games: fields the load cannot do without.

    A game without a status, and a finished game without a start time (the
    date rule needs it), a season (the label needs it), a team or a request
    date make the extract fail in the reference; here they are counted so the
    load can stop before writing.  A score that is an explicit null is legal.
    """
    from rivalry.operators.quality import not_null
    g = F.col("g")
    every = payloads.select(requested_date(payloads).alias("request_date"), F.explode("response").alias("g"))
    finished = (every.filter(g["status"]["long"] == FINISHED)
                .select("request_date", g["date"]["start"].alias("start"), g["season"].alias("season"),
                        g["teams"]["home"]["name"].alias("home_team"),
                        g["teams"]["visitors"]["name"].alias("away_team")))
    return not_null("payload", finished, ["start", "season", "home_team", "away_team", "request_date"]).unionByName(
        not_null("payload", every.select(g["status"]["long"].alias("status")), ["status"]))


def latest_per_key(stage: DataFrame, keys: list[str] = GAME_KEY,
                   order_col: str = "request_date", marks: bool = False) -> DataFrame:
    """Reduce staging rows to one per key: the one from the latest request.

    Several payloads may carry the same game (a game moved to the previous
    date meets that date's own payload).  ``max_by`` is a partial aggregate,
    so a hot key is combined map-side.  Of documents for one request date the
    one that landed last wins (modification time, then file name); rows of
    one document are told apart by their values, deterministically.  With
    ``marks`` the winner's request and landing stay beside it (``schemas.MARKS``).
    """
    value_cols = [c for c in GAMES_COLS if c not in keys]
    landed = [c for c in LANDED if c in stage.columns]
    best = F.max_by(F.struct(*[F.col(c) for c in value_cols]),
                    F.struct(order_col, *landed, *[F.col(c) for c in value_cols]))
    mark = F.max(F.struct(order_col, *landed))
    rows = (stage.groupBy(*keys).agg(best.alias("_v"), mark.alias("_m"))
            .select(*keys, *[F.col("_v")[c].alias(c) for c in value_cols],
                    *[(F.col("_m")[f.name] if f.name in (order_col, *landed) else F.lit(None)).cast(f.dataType).alias(f.name)
                      for f in MARKS]))
    return rows.select(*(FACT_COLS if marks else GAMES_COLS))
