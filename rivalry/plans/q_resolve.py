"""Queries over alias dictionaries and fuzzy name resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from rivalry.operators.resolve import alias_dim_from_lists, resolve_names
from rivalry.plans import fixtures as X
from rivalry.plans import oracle as O
from rivalry.plans.catalog import register
from rivalry.plans.oracle_weighted import best_ctes
from rivalry.plans.q_serve import best_alias_sql

PART_DIM = """
SELECT alias, arg_max(canonical, ord) AS canonical, min(ord) AS ord FROM (
  SELECT p_name AS alias, p_name AS canonical, p_name || '#0' AS ord FROM (SELECT DISTINCT p_name FROM part)
  UNION ALL
  SELECT split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1), p_name, p_name || '#1'
  FROM (SELECT DISTINCT p_name FROM part)) GROUP BY alias
"""
FUZZY_IN = """
SELECT DISTINCT CASE p_partkey % 4 WHEN 0 THEN substr(p_name, 1, 2) || substr(p_name, 4)
                     WHEN 1 THEN upper(p_name) WHEN 2 THEN 'zq' || reverse(p_name)
                     ELSE p_name || CAST(p_partkey % 10 AS VARCHAR) END AS input
FROM part
"""


@register("alias_dim", """
WITH c AS (SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey),
e AS (
  SELECT lower(c_name) AS alias, c_name AS canonical, c_custkey * 1000000 AS ord FROM c
  UNION ALL SELECT regexp_replace(lower(c_name), '#0*', ' '), c_name, c_custkey * 1000000 + 1 FROM c
  UNION ALL SELECT lower(n_name), c_name, c_custkey * 1000000 + 2 FROM c)
SELECT alias, arg_max(canonical, ord) AS canonical, min(ord) AS ord FROM e GROUP BY alias""")
def q_alias_dim(spark, sf_dir):
    """Dictionary inversion: first position kept, last canonical wins for shared aliases."""
    return alias_dim_from_lists(X.customer_alias_lists(spark, sf_dir))


@register("fuzzy_resolve_lev", O.with_ctes(
    "SELECT i.input, b.canonical, b.score FROM fin i JOIN best b ON lower(i.input) = b.q",
    part_dim=PART_DIM, fin=FUZZY_IN, inp="SELECT DISTINCT lower(input) AS q FROM fin",
    best=best_alias_sql("inp", "part_dim")))
def q_fuzzy_resolve_lev(spark, sf_dir):
    return resolve_names(X.fuzzy_inputs(spark, sf_dir), "input", X.alias_dim_part(spark, sf_dir),
                         scorer="levenshtein")


@register("fuzzy_resolve_weighted", O.with_ctes(
    "SELECT i.input, b.canonical, b.score FROM fin i JOIN best b ON lower(i.input) = b.q",
    part_dim=PART_DIM, fin=FUZZY_IN, inp="SELECT DISTINCT lower(input) AS q FROM fin", **best_ctes("inp", "part_dim")))
def q_fuzzy_resolve_weighted(spark, sf_dir):
    """Weighted-ratio scorer, in Arrow batches."""
    return resolve_names(X.fuzzy_inputs(spark, sf_dir), "input", X.alias_dim_part(spark, sf_dir),
                         scorer="weighted")


DUP_DIM = """
SELECT alias, arg_min(canonical, ord) AS canonical, min(ord) AS ord FROM (
  SELECT p_name AS alias, p_name AS canonical, p_name || '#0' AS ord FROM (SELECT DISTINCT p_name FROM part)
  UNION ALL SELECT p_name, 'again ' || p_name, p_name || '#1' FROM (SELECT DISTINCT p_name FROM part)
  UNION ALL SELECT '', 'nothing', '#') GROUP BY alias
"""


@register("fuzzy_resolve_dup_alias", O.with_ctes(
    "SELECT i.input, b.canonical, b.score FROM fin i JOIN best b ON lower(i.input) = b.q",
    dup_dim=DUP_DIM, fin=FUZZY_IN, inp="SELECT DISTINCT lower(input) AS q FROM fin",
    best=best_alias_sql("inp", "dup_dim")))
def q_fuzzy_resolve_dup_alias(spark, sf_dir):
    """A dictionary that lists aliases twice and the empty one: the first entry counts."""
    names = X.alias_dim_part(spark, sf_dir).filter(F.col("ord").endswith("#0") & (F.col("alias") == F.col("canonical")))
    twice = names.select("alias", F.concat(F.lit("again "), "canonical").alias("canonical"),
                         F.regexp_replace("ord", "#0$", "#1").alias("ord"))
    empty = spark.createDataFrame([("", "nothing", "#")], "alias string, canonical string, ord string")
    return resolve_names(X.fuzzy_inputs(spark, sf_dir), "input", names.unionByName(twice).unionByName(empty),
                         scorer="levenshtein")
