"""Declared sources: a logical name resolves to a physical parquet table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class TableRegistry:
    """Name indirection from a logical table name to a physical location."""

    def __init__(self, spark: SparkSession, root: str | None = None,
                 mapping: dict[str, str] | None = None):
        self.spark = spark
        self.root = root.rstrip("/") if root else None
        self.mapping = dict(mapping or {})

    def declare(self, logical: str, physical: str) -> "TableRegistry":
        self.mapping[logical] = physical
        return self

    def path(self, name: str) -> str:
        if name in self.mapping:
            return self.mapping[name]
        if self.root is None:
            raise KeyError(f"undeclared source {name!r}")
        return f"{self.root}/{name}.parquet"

    def load(self, name: str, *columns: str) -> DataFrame:
        df = self.spark.read.parquet(self.path(name))
        return df.select(*columns) if columns else df


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return TableRegistry(spark, sf_dir).load(name, *columns)
