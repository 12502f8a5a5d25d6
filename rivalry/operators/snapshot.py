"""SCD type-2 snapshots (check and timestamp strategies, hard deletes, as-of).

A snapshot holds every version of every key with validity columns
``scd_id, updated_at, valid_from, valid_to`` (``valid_to IS NULL`` = current).
One run = closed history (untouched) + the current rows FULL OUTER JOIN the
source on the unique key:

* key in both, changed    -> close the current row, insert the source row;
* key in both, unchanged  -> keep;
* key only in the source  -> insert;
* key only in the snapshot-> keep open, or close when ``hard_deletes``.

``check`` strategy: changed = any check column differs (NULL-safe).
``timestamp`` strategy: changed = source ``updated_at`` > current
``valid_from``; new versions start at the source's ``updated_at``.
The source is written to the shared folder once per run: both halves of the
outer join read the same rows, and a source computed from a large fact table
is computed once.  The run timestamp is a parameter (never the wall clock)
so runs replay deterministically.  The key must be unique in the source (run the
uniqueness test first); current rows are unique per key by construction,
so the join has no hot key.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rivalry.plans.guard import materialize
from rivalry.schemas import SCD_COLS


def _ts(value) -> Column:
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, (_dt.datetime, _dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def scd_id(keys: list[str], valid_from: Column) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys],
                             valid_from.cast("string")))


def _versions(src: DataFrame, keys: list[str], valid_from: Column, cols: list[str]) -> DataFrame:
    return src.select(*cols, valid_from.alias("_vf")).select(
        *cols, scd_id(keys, F.col("_vf")).alias("scd_id"), F.col("_vf").alias("updated_at"),
        F.col("_vf").alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))


def snapshot(current: DataFrame | None, source: DataFrame, keys: list[str], run_ts,
             strategy: str = "check", check_cols: list[str] | None = None,
             updated_at: str | None = None, hard_deletes: bool = False,
             materialize_source: bool = True, history: DataFrame | None = None) -> DataFrame:
    """Return the snapshot table after one run over ``source``.

    ``history``: the closed rows, if they are stored apart and ``current``
    holds open ones only; they are not part of the result then.

    ``materialize_source=False`` when the source already is a written table
    (for example a published model version): it is then read as is.
    """
    cols = source.columns
    run = _ts(run_ts)
    if strategy == "check":
        check = check_cols or [c for c in cols if c not in keys]
        src_from = run
    elif strategy == "timestamp":
        if not updated_at:
            raise ValueError("timestamp strategy needs updated_at")
        src_from = F.col(updated_at).cast("timestamp_ntz")
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    if current is None:
        return _versions(source, keys, src_from, cols).select(*cols, *SCD_COLS)
    if materialize_source:
        source = materialize(source, "snapshot_source")

    apart = history is not None
    if not apart:
        history = current.filter(F.col("valid_to").isNotNull())
    live = current.filter(F.col("valid_to").isNull())
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in cols], src_from.alias("_s_vf"),
                      F.lit(True).alias("_s_hit"))
    o = live.withColumn("_o_hit", F.lit(True))
    j = o.join(s, reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_s_{k}") for k in keys]), "full")
    both = F.col("_o_hit").isNotNull() & F.col("_s_hit").isNotNull()
    if strategy == "check":
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in check])
        changed = both & ~same
    else:
        changed = both & (F.col("_s_vf") > F.col("valid_from"))
    gone = F.col("_o_hit").isNotNull() & F.col("_s_hit").isNull()
    close_at = run if strategy == "check" else F.col("_s_vf")
    valid_to = F.when(changed, close_at)
    if hard_deletes:
        valid_to = valid_to.when(gone, run)
    old = (j.filter(F.col("_o_hit").isNotNull())
            .select(*cols, "scd_id", "updated_at", "valid_from",
                    valid_to.otherwise(F.col("valid_to")).alias("valid_to")))
    fresh = j.filter(F.col("_s_hit").isNotNull() & (F.col("_o_hit").isNull() | changed))
    fresh = fresh.select(*[F.col(f"_s_{c}").alias(c) for c in cols], F.col("_s_vf").alias("_vf"))
    if strategy == "timestamp":
        # A key that reappears after a hard delete starts after its last close.
        last = history.groupBy(*keys).agg(F.max("valid_to").alias("_last_to"))
        fresh = (fresh.join(last, keys, "left")
                      .withColumn("_vf", F.greatest(F.col("_vf"), F.col("_last_to")))
                      .drop("_last_to"))
    new = _versions(fresh, keys, F.col("_vf"), cols)
    rows = old.select(*cols, *SCD_COLS).unionByName(new.select(*cols, *SCD_COLS))
    return rows if apart else history.select(*cols, *SCD_COLS).unionByName(rows)


def as_of(snap: DataFrame, at) -> DataFrame:
    """Rows valid at ``at``: ``valid_from <= at < coalesce(valid_to, +inf)``."""
    t = _ts(at)
    return snap.filter((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (t < F.col("valid_to"))))


def current_rows(snap: DataFrame) -> DataFrame:
    return snap.filter(F.col("valid_to").isNull())
