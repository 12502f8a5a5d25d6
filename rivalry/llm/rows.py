"""Rows told apart by an identity, so that decisions on few rows don't move the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rivalry.llm.hashing import bitmap, bitmap_size, in_bitmap


IDENT = "struct<a: long, b: long>"


def identity(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Of a row: what all rows with the same doc_id and text share, and no others: two hashes of 64 bits."""
    own = [F.col(doc_id).cast("long"), F.coalesce(F.col(text).cast("string"), F.lit(""))]
    return F.struct(F.xxhash64(*own).alias("a"), F.xxhash64(*own[::-1], F.length(own[1])).alias("b"))


def split_rows(docs: DataFrame, idents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that surely are not among ``idents`` (ident), and the others, both with ``_ident``.

    A bitmap of fixed bound tells them apart where they are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(idents, "ident.a", bitmap_size(idents.count())))

    @F.pandas_udf("boolean")
    def may_be(ident):
        import pandas as pd
        return pd.Series(in_bitmap(shared.value, ident.to_numpy().view("uint64")))

    source = docs.withColumn("_ident", identity()).withColumn("_may_be", may_be("_ident.a"))
    return source.where("not _may_be").drop("_may_be"), source.where("_may_be").drop("_may_be")


def doubtful_rows(docs: DataFrame, special: DataFrame) -> DataFrame:
    """``docs`` with ``_ident`` and, for the rows whose identity is in ``special`` (ident, ...), ``_special`` and its
    other columns; null for all others, of which only a few move."""
    more = [f for f in special.schema.fields if f.name != "ident"]
    sure, rest = split_rows(docs, special)
    marks = special.withColumnRenamed("ident", "_ident").withColumn("_special", F.lit(True))
    nulls = {f.name: F.lit(None).cast(f.dataType) for f in more} | {"_special": F.lit(None).cast("boolean")}
    return sure.withColumns(nulls).unionByName(rest.join(marks, "_ident", "left"))


def without(docs: DataFrame, idents: DataFrame) -> DataFrame:
    """``docs`` without the rows whose identity is in ``idents`` (ident)."""
    sure, rest = split_rows(docs, idents)
    gone = idents.select(F.col("ident").alias("_ident")).distinct()
    return sure.select(docs.columns).union(rest.join(gone, "_ident", "left_anti").select(docs.columns))
