"""MERGE (matched -> update, not matched -> insert) as DataFrame joins.

``target LEFT JOIN stage`` takes stage values where a stage row matched (a
hit flag, not ``coalesce``, so an update *to* NULL wins); stage rows whose
key matches no target row are appended.  Equi-joins never match NULL keys,
so NULL-key stage rows are inserted.  Duplicate target rows are each
updated.  Two stage rows for one matched target row are ambiguous and raise
(``assert_unambiguous``); duplicates that match nothing are both inserted.

The stage (a daily increment) is the small side: after a size check it is
broadcast, so the target is streamed through hash joins and never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from rivalry.plans.guard import bounded_broadcast
from rivalry.schemas import GAME_KEY

UPDATE_COLS = ["home_score", "away_score", "season"]


def _key_eq(right_prefix: str, keys: list[str]):
    return reduce(lambda a, b: a & b,
                  [F.col(k) == F.col(f"{right_prefix}{k}") for k in keys])


def merge_conflicts(target: DataFrame, stage: DataFrame,
                    keys: list[str] = GAME_KEY) -> DataFrame:
    """Keys with more than one stage row that also match a target row."""
    dup = (stage.groupBy(*keys).agg(F.count(F.lit(1)).alias("stage_rows"))
           .filter(F.col("stage_rows") > 1))
    return dup.join(target.select(*keys), keys, "left_semi")


def assert_unambiguous(target: DataFrame, stage: DataFrame,
                       keys: list[str] = GAME_KEY) -> None:
    """Raise if two stage rows would update one target row.

    Duplicate stage keys are found first (a partial aggregate over the stage
    alone); the target is consulted only when there are some, through a
    broadcast semi join of those keys (a subset of the measured stage).
    """
    dup = (stage.groupBy(*keys).agg(F.count(F.lit(1)).alias("stage_rows"))
           .filter(F.col("stage_rows") > 1))
    dup_keys, small = bounded_broadcast(dup)
    if small and dup_keys.isEmpty():
        return
    bad = target.select(*keys).join(dup_keys, keys, "left_semi").limit(1).collect()
    if bad:
        raise ValueError(f"MERGE source has several rows for one target row: {bad[0].asDict()}")


def merge_upsert(target: DataFrame, stage: DataFrame, keys: list[str] = GAME_KEY,
                 update_cols: list[str] = UPDATE_COLS, check: bool = True,
                 stage_rows: int | None = None, newer_by: list[str] | None = None) -> DataFrame:
    """Rows of ``target`` after MERGE with ``stage`` (columns in target order).

    ``stage_rows``: row count of a stage that is already a written table
    (skips measuring it again).  ``newer_by``: columns of both sides; a matched
    row is updated only if the stage's values of them, compared in this order
    with NULL as the least, are not less than its own.
    """
    cols = target.columns
    st, small = bounded_broadcast(
        stage.select(*[F.col(c).alias(f"_s_{c}") for c in stage.columns])
             .withColumn("_hit", F.lit(True)), known_rows=stage_rows)
    if check:
        measured = st.select(*[F.col(f"_s_{c}").alias(c) for c in stage.columns])
        assert_unambiguous(target, measured, keys)
    hit = F.col("_hit").isNotNull()
    if newer_by:
        hit = hit & (F.struct(*[F.col(f"_s_{c}") for c in newer_by]) >= F.struct(*newer_by))
    updated = target.join(st, _key_eq("_s_", keys), "left").select(
        *[F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in update_cols
          else F.col(c) for c in cols])
    # Keys of target rows that some stage row matches (target streamed,
    # stage keys broadcast), then the stage rows with no such key.
    matched = (target.select(*keys)
               .join(st.select(*[F.col(f"_s_{k}") for k in keys]),
                     _key_eq("_s_", keys), "left_semi")
               .distinct())
    if small:
        # matched keys are a subset of the stage keys: the stage's measured
        # size bounds them, so the anti join can broadcast them too.
        matched = F.broadcast(matched)
    inserted = (st.join(matched, [F.col(f"_s_{k}") == matched[k] for k in keys], "left_anti")
                .select(*[F.col(f"_s_{c}").alias(c) for c in cols]))
    return updated.unionByName(inserted)
