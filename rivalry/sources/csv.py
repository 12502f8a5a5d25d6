"""Strict CSV bulk load of the match fact (header skipped, positional columns).

Options mirror a warehouse ``COPY INTO``: the header line is skipped and its
names ignored (columns are positional), fields may be enclosed in ``"``,
``""`` inside quotes is a quote, an unquoted empty field and ``\\N`` are NULL,
a quoted empty field is the empty string, and any malformed row (too few or
too many fields, a bad integer or date) aborts the load.

FAILFAST is lazy: it fires only for columns actually parsed.  ``count()``
prunes every column and validates nothing, so a load must consume full rows
(the table write in ``plans.loads.full_refresh`` does).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from rivalry.schemas import GAMES
from rivalry.sources.store import path_exists

CSV_OPTIONS = {
    "header": "true",
    "enforceSchema": "true",
    "quote": '"',
    "escape": '"',
    "mode": "FAILFAST",
    "nullValue": "\\N",
    "emptyValue": "",
    "dateFormat": "yyyy-MM-dd",
}


def read_games_csv(spark: SparkSession, path: str, schema: StructType = GAMES) -> DataFrame:
    """Read match CSV files (``.csv`` or compressed) with the strict options above."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no match CSV at {path}")
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def write_games_csv(df: DataFrame, path: str) -> None:
    """Write match rows as headed CSV (quoting as the reader expects)."""
    (df.write.mode("errorifexists")
       .options(header="true", quote='"', escape='"', nullValue="\\N", emptyValue='""')
       .csv(path))
