"""From raw documents to packed sequences: five stages, each the predecessor's whole output to the next.

Every stage but the last returns the columns of ``documents``.  The tokens of
the last stage can't be expressed in SQL, so there is no oracle; the tests
hold the stages against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivalry.llm.common import read, table
from rivalry.llm.decontaminate import clean_documents
from rivalry.llm.line_dedup import line_dedup
from rivalry.llm.min_max import one_of_each
from rivalry.llm.packing import pack_documents
from rivalry.llm.quality_rules import keep_documents
from rivalry.llm.queries import tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned decision list rejects."""
    return keep_documents(docs, read(spark, sf_dir, "labels"))


# Lines of so many words are passages.
PASSAGE = 50


def left_of(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The columns of ``docs`` from ``line_dedup``'s result: documents of which nothing is left go; ``n_chars`` follows
    the text."""
    left = found.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", n_chars).select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more, and passages found in two or more, stay in their first document only.

    Near-copies share most of their passages, and without them would no longer be seen as such: they leave whole before
    passages are compared.  What passages leave behind may be near-copies anew, which the next stage finds.
    """
    short = table(left_of(docs, line_dedup(docs, min_docs=10, least=1, keep_first=True)), "repeated-lines-out")
    single = table(near_copies(spark, short, sf_dir), "near-copies-out")
    return left_of(docs, line_dedup(single, min_docs=2, keep_first=True, least_words=PASSAGE))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, on five-word shingles."""
    return one_of_each(docs, size=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return clean_documents(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of 4096 tokens."""
    return pack_documents(docs, tokenizer())


STAGES = [("quality rules", quality), ("line dedup", lines), ("min-max near-dedup", near_copies),
          ("benchmark decontamination", benchmark), ("best-fit packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
