"""Connected components of a large sparse graph by alternating star operations.

Every round replaces edges by edges towards the smallest neighbour; after
about log n rounds each vertex points at the smallest of its component.  Each
round is written to the shared folder, so lineage stays short and nothing
passes through the driver.  A centre with a third of all edges is combined
map-side where it is reduced.  Where it is joined, the join shares the exchange
of that reduction, so its edges (a vertex and a root, 16 bytes each) meet in one
task; writing both sides first would let Spark split them, at four times as many
small jobs a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rivalry.llm.common import table


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """``edges``: a, b (longs, in any direction, repeats and loops allowed).  Returns v, root for every vertex that
    isn't the smallest of its component."""
    now = table(edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("root")).distinct(),
                "edges")
    mark = None
    for _ in range(rounds):
        # All larger neighbours of each vertex to the smallest neighbour (or itself).
        both = now.union(now.select(F.col("root").alias("v"), F.col("v").alias("root")))
        least = both.groupBy("v").agg(F.least(F.min("root"), F.col("v")).alias("m"))
        large = both.join(least, "v").where("root > v").select(F.col("root").alias("v"), F.col("m").alias("root"))
        down = large.where("v <> root").distinct()
        # The vertex and its smaller neighbours to the smallest of them.
        least = down.groupBy("v").agg(F.min("root").alias("m"))
        small = (down.join(least, "v").where("root <> m").select(F.col("root").alias("v"), F.col("m").alias("root"))
                 .union(least.withColumnRenamed("m", "root")))
        now = table(small.where("v <> root").distinct(), "edges")
        was, mark = mark, now.agg(F.count("*"), F.sum(F.xxhash64("v", "root").cast("decimal(20,0)"))).first()
        if was == mark:
            return now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
