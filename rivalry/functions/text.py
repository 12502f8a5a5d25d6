"""String expressions: season labels, request parsing and reply text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def season_label(start_year: Column) -> Column:
    """``"{y}-{y+1}"`` from an integer start year."""
    y = start_year.cast("bigint")
    return F.concat(y.cast("string"), F.lit("-"), (y + 1).cast("string"))


def season_of_date(d: Column, first_month: int = 10) -> Column:
    """Season label of a date: seasons start in ``first_month``."""
    y = F.year(d)
    start = F.when(F.month(d) >= first_month, y).otherwise(y - 1)
    return season_label(start)


# An integer as Python's int() reads it: optional sign '+', digits with single
# underscores between digit groups, surrounding whitespace.
_INT_TEXT = r"^\s*\+?[0-9]+(_[0-9]+)*\s*$"


def normalize_season(text: Column) -> Column:
    """Season input normaliser.

    * contains ``-``  -> returned unchanged (already a two-year label);
    * an integer      -> ``"{y}-{y+1}"`` (``' 2016 '``, ``'+2016'``, ``'2_016'``);
    * anything else   -> NULL.
    """
    year = F.regexp_replace(F.regexp_replace(text, r"[\s+_]", ""), "^0+(?=.)", "")
    as_label = F.concat(year, F.lit("-"), _next_number(year))
    return (F.when(F.instr(text, "-") > 0, text)
             .when(text.rlike(_INT_TEXT), as_label))


def _next_number(digits: Column) -> Column:
    """The number after one given in digits, of any length: the last digit below 9 goes up, the nines after it are 0."""
    nines = F.length(F.regexp_extract(digits, "9*$", 0))
    zeros = F.repeat(F.lit("0"), nines)
    at = F.length(digits) - nines
    up = F.substr(digits, at, F.lit(1)).try_cast("int") + 1
    return F.when(at == 0, F.concat(F.lit("1"), zeros)).otherwise(
        F.concat(F.substr(digits, F.lit(1), at - 1), up.cast("string"), zeros))


# Runs of what Python's str.split() parts words at: tabs, line ends, control separators and Unicode blanks too.
_BLANKS = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def split_request(text: Column) -> tuple[Column, Column, Column]:
    """Split request text into (ok, team_text, season_text).

    Tokens are separated by whitespace of any kind; the last token is the
    season and the rest, joined by single spaces, is the team.  Fewer than two
    tokens -> not ok.
    """
    tokens = F.filter(F.split(text, _BLANKS), lambda t: t != "")
    n = F.coalesce(F.size(tokens), F.lit(0))
    ok = n >= 2
    season = F.when(ok, F.element_at(tokens, -1))
    team = F.when(ok, F.array_join(F.slice(tokens, 1, n - 1), " "))
    return ok, team, season


def percent_text(ratio_3dp: Column) -> Column:
    """``f"{p*100:.1f}%"`` for a ratio already rounded to 3 decimals.

    Built from the integer number of tenths so the text is exact (formatting
    a binary double with %.1f can round the wrong way at .x5).
    """
    tenths = F.round(ratio_3dp * F.lit(1000.0)).cast("bigint")
    return F.concat(F.call_function("div", tenths, F.lit(10)).cast("string"), F.lit("."),
                    F.pmod(tenths, F.lit(10)).cast("string"), F.lit("%"))


def signed_margin_text(margin: Column) -> Column:
    """Margin text of a win: ``+{m}`` (a negative "win" prints ``+-3``)."""
    return F.concat(F.lit("+"), margin.cast("string"))


def margin_text(margin: Column) -> Column:
    """Margin text of a loss: ``{m}``."""
    return margin.cast("string")


def capitalize(s: Column) -> Column:
    """Python ``str.capitalize``: first character upper, the rest lower."""
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substr(s, F.lit(2))))


def _py_str(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("None"))


def matchup_text(home: Column, away: Column) -> Column:
    """``"{home} vs {away}"``."""
    return F.concat(_py_str(home), F.lit(" vs "), _py_str(away))


def score_text(home_score: Column, away_score: Column) -> Column:
    """``"Score: {h} - {a}"``."""
    return F.concat(F.lit("Score: "), _py_str(home_score), F.lit(" - "), _py_str(away_score))
