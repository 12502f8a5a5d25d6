"""Entity name resolution: exact alias lookup, then fuzzy best match.

``resolve_names`` works on the *distinct* lower-cased inputs, so the cost is
proportional to the number of different spellings, not to the rows.  A small
alias dictionary is shipped to every task (as a literal array for the native
Levenshtein scorer, as a broadcast variable for the weighted scorer) and each
input is scored against every alias there.  A larger one stays a table: exact
hits by an equi-join, the best aliases of the other inputs by an inverted index
of grams and, for inputs like no alias, block by block (``alias_index``).  The
first alias in dictionary order wins ties, so the result is the same at any
size.
"""

from __future__ import annotations

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rivalry.functions import fuzzy as _fuzzy
from rivalry.functions.fuzzy import best_match, lev_ratio
from rivalry.operators.alias_index import best_aliases, entries_of

# The weighted scorer runs in Python workers: ship its module with the UDF
# (by value) so executors need not have this package installed.
cloudpickle.register_pickle_by_value(_fuzzy)
from rivalry.plans.guard import bounded_broadcast, materialize

# The reference's alias dictionary, canonical name -> aliases,
# in its dictionary order.
TEAM_ALIASES: list[tuple[str, list[str]]] = [
    ("Boston Celtics", ["boston", "celtics", "boston celtics"]),
    ("Brooklyn Nets", ["brooklyn", "nets", "brooklyn nets"]),
    ("New York Knicks", ["new york", "knicks", "new york knicks"]),
    ("Philadelphia 76ers", ["philadelphia", "sixers", "76ers", "philly", "philadelphia 76ers"]),
    ("Toronto Raptors", ["toronto", "raptors", "toronto raptors"]),
    ("Chicago Bulls", ["chicago", "bulls", "chicago bulls"]),
    ("Cleveland Cavaliers", ["cleveland", "cavs", "cavaliers", "cleveland cavaliers"]),
    ("Detroit Pistons", ["detroit", "pistons", "detroit pistons"]),
    ("Indiana Pacers", ["indiana", "pacers", "indiana pacers"]),
    ("Milwaukee Bucks", ["milwaukee", "bucks", "milwaukee bucks"]),
    ("Atlanta Hawks", ["atlanta", "hawks", "atlanta hawks"]),
    ("Charlotte Hornets", ["charlotte", "hornets", "charlotte hornets"]),
    ("Miami Heat", ["miami", "heat", "miami heat"]),
    ("Orlando Magic", ["orlando", "magic", "orlando magic"]),
    ("Washington Wizards", ["washington", "wizards", "washington wizards"]),
    ("Denver Nuggets", ["denver", "nuggets", "denver nuggets"]),
    ("Minnesota Timberwolves", ["minnesota", "wolves", "timberwolves", "minnesota timberwolves"]),
    ("Oklahoma City Thunder", ["oklahoma city", "okc", "thunder", "oklahoma city thunder"]),
    ("Portland Trail Blazers", ["portland", "blazers", "trail blazers", "portland trail blazers"]),
    ("Utah Jazz", ["utah", "jazz", "utah jazz"]),
    ("Golden State Warriors", ["golden state", "warriors", "gsw", "golden state warriors"]),
    ("Los Angeles Clippers", ["clippers", "la clippers", "los angeles clippers"]),
    ("Los Angeles Lakers", ["lakers", "la lakers", "los angeles lakers"]),
    ("Phoenix Suns", ["phoenix", "suns", "phoenix suns"]),
    ("Sacramento Kings", ["sacramento", "kings", "sacramento kings"]),
    ("Dallas Mavericks", ["dallas", "mavs", "mavericks", "dallas mavericks"]),
    ("Houston Rockets", ["houston", "rockets", "houston rockets"]),
    ("Memphis Grizzlies", ["memphis", "grizzlies", "grizz", "memphis grizzlies"]),
    ("New Orleans Pelicans", ["new orleans", "pelicans", "pels", "new orleans pelicans"]),
    ("San Antonio Spurs", ["san antonio", "spurs", "san antonio spurs"]),
]

# Accept a fuzzy match only when its score is strictly above this.
DEFAULT_THRESHOLD = 70.0

# Dictionaries up to this many aliases travel with the plan; larger ones stay tables (``alias_index``).
LOCAL_DICT = 5_000
ORD_STRIDE = 1_000_000

ALIAS_DIM_SCHEMA = "alias string, canonical string, ord bigint"


def alias_dim_from_lists(canon: DataFrame, canonical: str = "canonical",
                         aliases: str = "aliases", order: str = "cord") -> DataFrame:
    """Invert ``canonical -> [aliases]`` into ``(alias, canonical, ord)``.

    Dictionary semantics: an alias listed twice keeps the position of its
    *first* occurrence (``ord``) and maps to the canonical of its *last*.
    ``ord = canonical order * 1e6 + position in the list``.
    """
    e = canon.select(F.col(canonical).alias("canonical"), F.col(order).alias("cord"),
                     F.posexplode(aliases).alias("pos", "alias"))
    inside = F.when(F.col("pos") < ORD_STRIDE, F.col("pos")).otherwise(
        F.raise_error(F.lit(f"a list has more than {ORD_STRIDE} aliases")).cast("int"))
    e = e.withColumn("ord", F.col("cord").cast("bigint") * ORD_STRIDE + inside)
    return (e.groupBy("alias").agg(F.min("ord").alias("ord"),
                                   F.max_by("canonical", "ord").alias("canonical"))
             .select("alias", "canonical", "ord"))


def reference_alias_dim(spark) -> DataFrame:
    rows = [(c, i, a) for i, (c, a) in enumerate(TEAM_ALIASES)]
    canon = spark.createDataFrame(rows, "canonical string, cord int, aliases array<string>")
    return alias_dim_from_lists(canon)


def one_per_alias(alias_dim: DataFrame) -> DataFrame:
    """One row per alias: of repeated aliases the first in dictionary order (NULL orders first, then by name)."""
    first = F.min(F.struct(F.col("ord").isNotNull().alias("has"), "ord", "canonical"))
    return (alias_dim.groupBy("alias").agg(first.alias("_f"))
            .select("alias", F.col("_f.canonical").alias("canonical"), F.col("_f.ord").alias("ord")))


def exact_lookup(df: DataFrame, col: str, alias_dim: DataFrame, out: str = "canonical") -> DataFrame:
    """Case-folded exact alias lookup (left join; NULL when unknown)."""
    dim, _ = bounded_broadcast(one_per_alias(alias_dim).select(F.col("alias").alias("_alias"),
                                                               F.col("canonical").alias(out)))
    return df.join(dim, F.lower(F.col(col)) == F.col("_alias"), "left").drop("_alias")


def _sort_key(row):
    # Spark's ascending order: NULLs first.
    o, a = row["ord"], row["alias"]
    return (o is not None, o if o is not None else 0, a is not None, a or "")


def dictionary(alias_dim: DataFrame, local_limit: int | None = None) -> list[tuple[str, str]] | None:
    """``(alias, canonical)`` in dictionary order, if there are at most ``local_limit``; else None."""
    dim = one_per_alias(alias_dim)
    limit = LOCAL_DICT if local_limit is None else local_limit
    head = dim.limit(limit + 1).collect()
    return [(r["alias"], r["canonical"]) for r in sorted(head, key=_sort_key)] if len(head) <= limit else None


def _lev_best(q: Column, chunk: list[tuple[str, str]]) -> Column:
    arr = F.arrays_zip(F.lit([a for a, _ in chunk]).alias("alias"),
                       F.lit([c for _, c in chunk]).alias("canonical"))
    init = F.struct(F.lit(-1.0).alias("score"), F.lit(None).cast("string").alias("alias"),
                    F.lit(None).cast("string").alias("canonical"))

    def step(acc, x):
        s = lev_ratio(q, x["alias"])
        return F.when(s > acc["score"], F.struct(s.alias("score"), x["alias"].alias("alias"),
                                                 x["canonical"].alias("canonical"))).otherwise(acc)
    return F.aggregate(arr, init, step)


_BEST_TYPE = T.StructType([T.StructField("score", T.DoubleType()),
                           T.StructField("alias", T.StringType()),
                           T.StructField("canonical", T.StringType())])


def _weighted_best_udf(bc):
    @F.pandas_udf(_BEST_TYPE)
    def best(q: pd.Series) -> pd.DataFrame:
        choices = bc.value
        out = [best_match(s, choices) if s is not None else (None, None, -1.0) for s in q]
        return pd.DataFrame({"score": [o[2] for o in out], "alias": [o[0] for o in out],
                             "canonical": [o[1] for o in out]})
    return best


def _resolved_from_tables(inputs: DataFrame, alias_dim: DataFrame, scorer: str) -> DataFrame:
    entries = entries_of(one_per_alias(alias_dim))
    every = materialize(inputs, "fuzzy-inputs")
    # Empty text is no exact hit: both scorers give it 0.
    exact = materialize(every.filter("_q <> ''").join(entries, F.col("_q") == F.col("alias"))
                        .select("_q", F.lit(100.0).alias("_score"), F.col("canonical").alias("_canon")), "exact-hits")
    rest = every.join(exact.select("_q"), "_q", "left_anti")
    return exact.unionByName(best_aliases(rest, entries, scorer))


def resolve_names(df: DataFrame, col: str, alias_dim: DataFrame,
                  threshold: float = DEFAULT_THRESHOLD, scorer: str = "levenshtein",
                  out: str = "canonical", score_col: str | None = "score") -> DataFrame:
    """Add ``out`` (canonical name or NULL) and optionally the best ``score``.

    1. distinct ``lower(col)``;  2. each scored against the dictionary, best
    score wins, ties go to the alias first in dictionary order: a small
    dictionary is a literal (or a broadcast list) of the plan, a larger one a
    table whose exact hits are taken by an equi-join (100, which no other alias
    can reach) and whose best aliases come from an index (``alias_index``);
    3. accepted iff score > threshold;  4. joined back to ``df`` on the
    lower-cased input.  The rule is the same at every size.
    """
    if scorer not in ("levenshtein", "weighted"):
        raise ValueError(f"unknown scorer {scorer!r}")
    spark = df.sparkSession
    inputs = df.select(F.lower(F.col(col)).alias("_q")).distinct()
    local = dictionary(alias_dim)
    if local:
        best = (_lev_best(F.col("_q"), local) if scorer == "levenshtein"
                else _weighted_best_udf(spark.sparkContext.broadcast(local))(F.col("_q")))
        resolved = inputs.select("_q", best.alias("_b")).select(
            "_q", F.col("_b.score").alias("_score"), F.col("_b.canonical").alias("_canon"))
    elif local is None:
        resolved = _resolved_from_tables(inputs.filter(F.col("_q").isNotNull()), alias_dim, scorer)
    else:
        resolved = inputs.select("_q", F.lit(0.0).alias("_score"), F.lit(None).cast("string").alias("_canon"))
    resolved = resolved.select(
        "_q", F.when(F.col("_score") > F.lit(threshold), F.col("_canon")).alias(out),
        F.greatest(F.col("_score"), F.lit(0.0)).alias("_score"))
    # NULL inputs stay out of the join (they would all meet on one key): what
    # they get is the score of no match.
    res, _ = bounded_broadcast(resolved.filter(F.col("_q").isNotNull()))
    joined = df.join(res, F.lower(F.col(col)) == F.col("_q"), "left").drop("_q")
    joined = joined.withColumn("_score", F.coalesce("_score", F.lit(0.0)))
    if score_col:
        return joined.withColumnRenamed("_score", score_col)
    return joined.drop("_score")
