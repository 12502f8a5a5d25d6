"""Exact ROUND(num / den, digits) for integer numerators and denominators.

Warehouse ROUND on exact decimals rounds half away from zero once.  Rounding a
binary double (or a decimal already rounded to a finite scale by division)
can round twice and land one unit off.  Integer division keeps it exact for
any group size: with S = 10**digits,

    q = (2*S*|num| + |den|) div (2*|den|)      -- floor, so half rounds up
    result = sign(num*den) * q / S             -- published as DOUBLE

``den = 0`` or NULL gives NULL (the ``NULLIF(den, 0)`` idiom).  The
expression is built as SQL text so a model's dozen aggregates cost one
parse each on the JVM side; identical aggregates inside it (``sum(x)``
used twice) are computed once by the aggregate operator.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_ratio_sql(num: str, den: str, digits: int) -> str:
    scale = 10 ** digits
    n = f"CAST(({num}) AS DECIMAL(38,0))"
    d = f"CAST(({den}) AS DECIMAL(38,0))"
    q = f"((abs({n}) * {2 * scale} + abs({d})) div (abs({d}) * 2))"
    signed = f"(CASE WHEN ({n} < 0) <> ({d} < 0) AND {n} <> 0 THEN -{q} ELSE {q} END)"
    return f"(CASE WHEN {d} <> 0 THEN CAST({signed} AS DOUBLE) / {scale}D END)"


def round_avg_sql(x: str, digits: int = 2) -> str:
    """ROUND(AVG(x), digits) as aggregate SQL text; NULL when no non-NULL x."""
    return round_ratio_sql(f"sum({x})", f"count({x})", digits)


def round_ratio(num: Column, den: Column, digits: int) -> Column:
    """Column form of ``round_ratio_sql`` for non-aggregate inputs."""
    scale = 10 ** digits
    n = num.cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    q = F.call_function("div", F.abs(n) * F.lit(2 * scale) + F.abs(d), F.abs(d) * F.lit(2))
    negative = (n < 0) != (d < 0)
    signed = F.when(negative & (n != 0), -q).otherwise(q)
    return F.when(d != 0, signed.cast("double") / F.lit(float(scale)))
