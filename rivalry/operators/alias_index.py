"""Best alias by edit distance over dictionaries of any size, from tables alone.

The dictionary is a written table of entries; the driver holds counts only.
The best alias stays exact, though most aliases are never scored:

1. A score of at least ``t`` percent allows ``d`` edits, so an input of length
   ``n`` meets aliases no longer than ``100 n / t`` only.  An edit destroys at
   most two of the input's two-letter grams, so any ``2 d + 1`` of them hold one
   that the alias has too, moved by at most ``d`` places.  The rarest ones are
   joined with the grams of the dictionary (an inverted index); length and place
   bound the score of what they meet, and what is left is scored.
2. If the best of these reaches ``t``, no alias outside can: the input is done.
   Levels go down (``LEVELS``): few edits need few grams, so most inputs end
   early, at rare grams.
3. The inputs that are left are like no alias, or too short for grams.  They are
   a stated set, dealt in parts to the blocks of the dictionary and scored there
   against each alias whose length alone does not rule it out.
"""

from __future__ import annotations

import pyspark.sql.types as T
from pyspark.sql import Column, DataFrame, functions as F

from rivalry.functions.fuzzy import best_match, lev_ratio
from rivalry.plans.guard import materialize

LEVELS = (90, 80)
GRAM = 2
# Aliases of a block, and inputs that meet one at a time.
BLOCK, PART = 5_000, 1_000


def entries_of(dim: DataFrame) -> DataFrame:
    """alias, canonical, ord, rank: a written table; ``rank`` orders the dictionary (NULL orders first, then by alias)."""
    known = dim.filter(F.col("alias").isNotNull())
    return materialize(known.select("alias", "canonical", F.struct(
        F.col("ord").isNotNull().alias("has"), "ord", "alias").alias("rank")), "alias-entries")


def grams_of(text: Column) -> Column:
    """[place, gram] of every two letters in turn."""
    at = F.sequence(F.lit(1), F.greatest(F.length(text) - GRAM + 1, F.lit(1)))
    return F.when(F.length(text) >= GRAM, F.transform(at, lambda i: F.struct(
        i.alias("place"), F.substr(text, i, F.lit(GRAM)).alias("gram"))))


def gram_index(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gram, at, alias, canonical, rank) for every gram of every alias, and (gram, n) how many there are: written
    tables."""
    index = materialize(entries.select("alias", "canonical", "rank", F.inline(grams_of(F.col("alias"))))
                        .withColumnRenamed("place", "at"), "alias-grams")
    return index, materialize(index.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "gram-counts")


def best_of(scored: DataFrame) -> DataFrame:
    """_q, _score, _canon: the best score of each input, of equal ones the first alias in dictionary order."""
    best = F.min(F.struct((-F.col("_score")).alias("worst"), "rank", "canonical"))
    return (scored.groupBy("_q").agg(best.alias("_b"))
            .select("_q", (-F.col("_b.worst")).alias("_score"), F.col("_b.canonical").alias("_canon")))


def at_level(inputs: DataFrame, index: DataFrame, counts: DataFrame, percent: int) -> DataFrame:
    """``best_of`` those inputs whose best alias scores ``percent`` or more."""
    n = F.length("_q")
    # Edits that an alias as long as the level allows may need.
    edits = F.call_function("div", n * (100 - percent), F.lit(percent))
    need = edits * GRAM + 1
    grams = (inputs.where(n - GRAM + 1 >= need).select("_q", n.alias("_n"), edits.alias("_d"), F.inline(grams_of(F.col("_q"))))
             .join(counts, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0))))
    rare = (grams.groupBy("_q", "_n", "_d").agg(F.sort_array(F.collect_list(F.struct("n", "gram", "place"))).alias("g"))
            .select("_q", "_n", "_d", F.inline(F.slice("g", F.lit(1), (F.col("_d") * GRAM + 1).cast("int"))))
            .drop("n"))
    size = F.length("alias")
    longest = F.greatest("_n", size)
    pairs = (rare.join(index, "gram")
             .where((F.abs(F.col("place") - F.col("at")) <= F.col("_d"))
                    & (100 * (longest - F.abs(F.col("_n") - size)) >= percent * longest))
             .select("_q", "alias", "canonical", "rank").distinct())
    scored = pairs.withColumn("_score", lev_ratio(F.col("_q"), F.col("alias"))).where(F.col("_score") >= percent)
    return best_of(scored)


def blocks_of(entries: DataFrame, size: int) -> tuple[DataFrame, int]:
    """(block, aliases) with the entries of each block in dictionary order, and the number of blocks."""
    n = max(1, -(-entries.count() // size))
    block = F.pmod(F.xxhash64("alias"), F.lit(n)).cast("int")
    rows = entries.groupBy(block.alias("block")).agg(F.sort_array(F.collect_list(
        F.struct("rank", "alias", "canonical"))).alias("aliases"))
    return materialize(rows, "alias-blocks"), n


def scan(inputs: DataFrame, entries: DataFrame, scorer: str = "levenshtein", block: int | None = None) -> DataFrame:
    """``best_of`` every input, against all aliases block by block."""
    blocks, n = blocks_of(entries, block or BLOCK)
    dealt = inputs.select("_q", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block"))
    if scorer == "weighted":
        return best_of(weighted_in_blocks(dealt, blocks))
    q = F.col("_q")
    rank = blocks.schema["aliases"].dataType.elementType
    none = F.struct(F.lit(-1.0).alias("score"), F.lit(None).cast(rank).alias("x"))

    def step(best, x):
        longest = F.greatest(F.length(q), F.length(x["alias"]))
        # By its length a later alias may score more: only then it is scored.
        may = 100 * (longest - F.abs(F.length(q) - F.length(x["alias"]))) > best["score"] * longest
        score = F.when(may | (best["score"] < 0), lev_ratio(q, x["alias"])).otherwise(F.lit(-1.0))
        return F.when(score > best["score"], F.struct(score.alias("score"), x.alias("x"))).otherwise(best)

    found = dealt.join(blocks, "block").select("_q", F.aggregate("aliases", none, step).alias("b"))
    return best_of(found.select("_q", F.col("b.score").alias("_score"), "b.x.rank", "b.x.canonical"))


def weighted_in_blocks(dealt: DataFrame, blocks: DataFrame) -> DataFrame:
    """The best alias of each (input, block) under the weighted scorer: a part of the inputs meets a block at a time."""
    parts = max(1, -(-dealt.select("_q").distinct().count() // PART))
    keyed = dealt.withColumn("part", F.pmod(F.xxhash64("_q"), F.lit(parts)).cast("int"))
    spread = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "aliases")
    rank = blocks.schema["aliases"].dataType.elementType["rank"].dataType

    def best(left, right):
        import pyarrow as pa
        aliases = [x for row in right.column("aliases").to_pylist() for x in row]
        choices = [(x["alias"], i) for i, x in enumerate(aliases)]
        queries = left.column("_q").to_pylist() if choices else []
        found = [best_match(q, choices) for q in queries]
        kind = right.schema.field("aliases").type.value_type
        return pa.table({"_q": pa.array(queries, pa.string()), "_score": pa.array([f[2] for f in found], pa.float64()),
                         "rank": pa.array([aliases[f[1]]["rank"] for f in found], kind.field("rank").type),
                         "canonical": pa.array([aliases[f[1]]["canonical"] for f in found], pa.string())})

    out = T.StructType([T.StructField("_q", T.StringType()), T.StructField("_score", T.DoubleType()),
                        T.StructField("rank", rank), T.StructField("canonical", T.StringType())])
    return keyed.groupBy("part", "block").cogroup(spread.groupBy("part", "block")).applyInArrow(best, out)


def best_aliases(inputs: DataFrame, entries: DataFrame, scorer: str = "levenshtein") -> DataFrame:
    """_q, _score, _canon of ``inputs`` (_q, distinct, no NULL): the best alias of the whole dictionary, first by score,
    then by dictionary order."""
    rest = materialize(inputs, "fuzzy-inputs")
    done = []
    if scorer == "levenshtein":
        index, counts = gram_index(entries)
        for percent in LEVELS:
            found = materialize(at_level(rest, index, counts, percent), "fuzzy-found")
            done.append(found)
            rest = materialize(rest.join(found.select("_q"), "_q", "left_anti"), "fuzzy-inputs")
    out = scan(rest, entries, scorer)
    for found in done:
        out = out.unionByName(found)
    return out
