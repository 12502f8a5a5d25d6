"""Helpers shared by the operators."""

from __future__ import annotations

import pickle

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rivalry.session import work_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# White space of the contracts: space, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared work folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def docs_of(df: DataFrame, *extra: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id`` as long and ``text`` (null as empty), with further columns by name."""
    return df.select(F.col(doc_id).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                     *[F.col(c) for c in extra])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Shared:
    """A broadcast value whose classes travel with it: executors need no copy of the package, of which a plain broadcast
    would keep the classes' names only."""

    def __init__(self, spark: SparkSession, value):
        self.raw = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self.raw.value)
