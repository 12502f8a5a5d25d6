"""Two-sided unpivot: one contest row -> one row per participant.

Both perspectives are produced from a single scan with ``inline(array(...))``
(no UNION ALL of two scans).  Column names are parameters, so any home/away
fact works.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rivalry.schemas import TEAM_RESULTS_COLS


def outcome(own: Column, other: Column) -> Column:
    """'win' / 'loss', else 'draw' — a NULL score on either side is a draw."""
    return F.when(own > other, "win").when(own < other, "loss").otherwise("draw")


def point_margin(df: DataFrame, scored: str = "points_scored",
                 allowed: str = "opponent_score", name: str = "point_margin") -> DataFrame:
    return df.withColumn(name, F.col(scored) - F.col(allowed))


def close_contest(a: Column, b: Column, max_margin: int = 5) -> Column:
    """``|a - b| <= max_margin`` (NULL when either side is NULL, so dropped)."""
    return F.abs(a - b) <= F.lit(max_margin)


def team_results(games: DataFrame, home: str = "home_team", away: str = "away_team",
                 home_score: str = "home_score", away_score: str = "away_score",
                 passthrough: tuple[str, ...] = ("date", "season")) -> DataFrame:
    """Per-participant rows: home perspective and away perspective."""
    h, a = F.col(home), F.col(away)
    hs, as_ = F.col(home_score), F.col(away_score)

    def side(team, opp, tag, own, other):
        return F.struct(team.alias("team"), opp.alias("opponent_team"),
                        F.lit(tag).alias("home_away_status"),
                        outcome(own, other).alias("result"),
                        own.alias("points_scored"), other.alias("opponent_score"))

    both = F.array(side(h, a, "home", hs, as_), side(a, h, "away", as_, hs))
    out = games.select(*[F.col(c) for c in passthrough], F.inline(both))
    return out.select(*[c for c in TEAM_RESULTS_COLS if c in out.columns])
