"""The registered queries of this subpackage, with production parameters, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rivalry.llm import oracle
from rivalry.llm.centroids import cluster_vectors
from rivalry.llm.common import read
from rivalry.llm.decontaminate import decontaminate
from rivalry.llm.importance import importance_sample
from rivalry.llm.line_dedup import line_dedup
from rivalry.llm.lm_score import lm_scores
from rivalry.llm.min_max import near_duplicates
from rivalry.llm.packing import pack_documents
from rivalry.llm.pseudonyms import pseudonymise
from rivalry.llm.quality_rules import judge, learn_from, quality_statistics
from rivalry.llm.secret_scan import secret_scan
from rivalry.llm.simhash import simhash_groups
from rivalry.llm.token_files import write_and_read
from rivalry.llm.url_filter import path_of, url_filter


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words in every document."""
    found = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go from all of them."""
    found = line_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, least=1, keep_first=False)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op4_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents, on four-word shingles."""
    found = near_duplicates(read(spark, sf_dir, "documents"), size=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every page's URL; a page's outcome is the label of the document whose number its path names."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})", 1)
    pages = pages.withColumn("article", F.when(number != "", number.cast("long")))
    outcomes = read(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("article"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return (url_filter(pages, outcomes, "article")
            .select("page_id", "host", "path", "rule", "verdict", "n_labelled"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text."""
    return secret_scan(read(spark, sf_dir, "documents"))

# A real run gives a secret of its own.
PSEUDONYM_KEY = "published key of the registered query"


def tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every document's ids into token files and read them back."""
    return write_and_read(read(spark, sf_dir, "documents"), tokenizer())


def op6_gated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-likelihood of every document under the gated recurrent model and the unigram base."""
    return lm_scores(read(spark, sf_dir, "documents"))


def op7_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 4096 tokens."""
    return pack_documents(read(spark, sf_dir, "documents"), tokenizer())


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by pseudonyms."""
    return pseudonymise(read(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document, by the list learned from all labels."""
    stats = quality_statistics(read(spark, sf_dir, "documents"))
    return (judge(stats, learn_from(stats, read(spark, sf_dir, "labels")))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    "kept", "rule"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of all documents with twenty words or more, drawn towards the benchmark's features."""
    return importance_sample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"),
                             buckets=10_000, percent=25, least_words=20, seed=7)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty clusters of all complete embeddings."""
    return cluster_vectors(read(spark, sf_dir, "embeddings"), k=40, rounds=5, dim=64, scale=256, seed=2).drop("scanned")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all documents whose fingerprints differ in two bits or fewer."""
    return simhash_groups(read(spark, sf_dir, "documents"), size=3, budget=2)


QUERIES = {f.__name__: f for f in (op2_url_reputation, op5_token_files, op7_best_fit, op8_secret_scan,
                                   op9_pseudonyms, op10_quality_rules, op1_decontaminate, op3_line_dedup,
                                   op4_min_max, op6_gated_lm, op11_importance, op12_centroids, op13_simhash)}


def queries():
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
