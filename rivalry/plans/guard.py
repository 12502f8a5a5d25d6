"""Size-checked broadcast and lineage cuts.

``bounded_broadcast`` hints a join side for broadcast only after measuring
it:

1. up to ``local_rows`` rows: the rows are collected as Arrow batches (one
   job — the same trip a broadcast makes anyway) and re-enter the plan as
   local data;
2. otherwise the side is written as a parquet table in the shared work
   folder (lineage cut, survives executor loss) and counted from the file
   footers; broadcast if at most ``max_rows`` rows and, at the measured width
   of its rows, at most ``max_bytes``;
3. above that the side is returned unhinted and Catalyst/AQE plan a shuffle
   join, with AQE skew-join splitting hot keys.

The side is held while it is measured, so step 2 writes what step 1 has
computed instead of computing it again.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from rivalry.session import work_dir

# Rows allowed on a broadcast side (~100 B/row keeps it far below executor
# memory and the 8 GB broadcast limit).
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
# Rows small enough to collect directly (Arrow keeps 100 k rows cheap).
DEFAULT_LOCAL_ROWS = 100_000
# Bytes allowed on a broadcast side, whatever its rows.
DEFAULT_MAX_BROADCAST_BYTES = 256 << 20


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to a fresh parquet table in the shared folder and read it back."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      local_rows: int = DEFAULT_LOCAL_ROWS,
                      known_rows: int | None = None,
                      max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Return ``(frame, broadcasted)``; see the module docstring.

    ``known_rows`` is for a side that is already a written table whose row
    count is known: only the width of its rows is measured.
    """
    spark = df.sparkSession
    if known_rows is not None:
        fits = 0 < max_rows and known_rows <= max_rows and known_rows * row_width(df) <= max_bytes
        return (F.broadcast(df), True) if fits else (df, False)
    cap = min(local_rows, max_rows)
    held = df.persist(StorageLevel.DISK_ONLY)
    try:
        if cap > 0:
            head = held.limit(cap + 1).toArrow()
            if head.num_rows <= cap and head.nbytes <= max_bytes:
                return F.broadcast(spark.createDataFrame(head, schema=df.schema)), True
        frozen = materialize(held, "side")
    finally:
        held.unpersist()
    rows = frozen.count()
    if 0 < max_rows and rows <= max_rows and rows * row_width(frozen) <= max_bytes:
        return F.broadcast(frozen), True
    return frozen, False


def row_width(written: DataFrame, sample: int = 1_000) -> float:
    """Bytes of a row of a written table, by the mean of its first rows."""
    head = written.limit(sample).toArrow()
    return head.nbytes / max(head.num_rows, 1)
