"""Data-quality tests as DataFrame operators.

* ``not_null``: one aggregate pass per model counts NULLs in every tested
  column; the single result row is unpivoted to one row per test.
* ``unique_combination``: number of key combinations occurring more than
  once (GROUP BY semantics: NULLs compare equal), partial-aggregated.
* ``report`` / ``gate``: union of all tests; the gate raises when any test
  has failures, which stops a refresh before its snapshot step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The reference's tests, model -> tested columns / unique key.
NOT_NULL_TESTS: dict[str, list[str]] = {
    "team_season_stats": ["season", "team", "total_games"],
    "team_season_biggest_win_loss": ["team", "season", "margin_type"],
    "close_game_season_stats": ["season", "team"],
}
UNIQUE_TESTS: dict[str, list[str]] = {
    "team_season_stats": ["season", "team"],
    "team_season_biggest_win_loss": ["team", "opponent_team", "date"],
    "close_game_season_stats": ["season", "team"],
}

REPORT_COLS = ["model", "test", "columns", "failures"]


def not_null(model: str, df: DataFrame, columns: list[str]) -> DataFrame:
    counts = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(c)
                      for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("columns"), F.col(c).alias("failures"))
                      for c in columns])
    return (counts.select(F.inline(pairs))
            .select(F.lit(model).alias("model"), F.lit("not_null").alias("test"),
                    "columns", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures")))


def unique_combination(model: str, df: DataFrame, columns: list[str]) -> DataFrame:
    dups = (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))
    return dups.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit("unique_combination_of_columns").alias("test"),
        F.lit(",".join(columns)).alias("columns"), F.col("failures").cast("bigint"))


def report(models: dict[str, DataFrame],
           not_null_tests: dict[str, list[str]] = NOT_NULL_TESTS,
           unique_tests: dict[str, list[str]] = UNIQUE_TESTS) -> DataFrame:
    parts = [not_null(m, models[m], cols) for m, cols in not_null_tests.items() if m in models]
    parts += [unique_combination(m, models[m], cols) for m, cols in unique_tests.items() if m in models]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*REPORT_COLS)


class QualityGateError(RuntimeError):
    pass


def gate(report_df: DataFrame) -> DataFrame:
    """Raise if any test failed; returns the (collected, tiny) report otherwise."""
    failing = report_df.filter(F.col("failures") > 0).collect()
    if failing:
        raise QualityGateError("data tests failed: " + "; ".join(
            f"{r['model']}.{r['test']}({r['columns']})={r['failures']}" for r in failing))
    return report_df
