"""rivalry — two-sided match analytics on Spark DataFrames.

A match fact has one row per contest between a home side and an away side.
The library turns those facts into per-participant rows, season statistics,
close-contest statistics and arg-extreme margins, guards them with data
quality rules, versions them as SCD2 snapshots, upserts increments, and
answers batches of lookup requests with exact and fuzzy name resolution.

Everything is expressed with the DataFrame API so Catalyst plans it; the
only Python on executors is the weighted fuzzy scorer (a pandas UDF).
"""

__version__ = "0.1.0"
