"""Benchmark decontamination: a prefix-filtered join of item windows with document windows.

A window is a run of ``window`` words of an item (all words of a shorter
item).  Its tokens are its two-word shingles, ordered by rarity in the
documents.  A document that contains the whole window contains each of its
shingles, so the one rarest shingle is prefix enough: documents emit only the
places of such shingles (told apart by a bitmap of fixed bound, then by the
join itself), the window must lie within the document (length and position
bounds), and the words of the whole window are compared.  Items and documents
meet in one equi-join on the shingle; a passage that a third of the documents
share is many rows of one key on the document side only, which Spark splits.

Null text: no words.  Items without words or without an id are left out;
repeated items count once.  Repeated documents are judged row by row; empty
tables give empty (no documents) or clean (no items) results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from rivalry.llm.common import docs_of, table
from rivalry.llm.hashing import WordHashes, bitmap, bitmap_size, in_bitmap, shingles
from rivalry.llm.rows import IDENT, identity, without
from rivalry.llm.tokens import texts

# Bytes that words are made of, A-Z lower-cased; all others part words.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
                   for b in range(256))
SHINGLE = 2


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def windows_of(items: DataFrame, window: int) -> DataFrame:
    """item_id, words (joined by blanks), length, shingles (hash of each, in order) of every distinct window."""
    def cut(batches):
        import pyarrow as pa
        hashes = WordHashes()
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item_id").to_pylist(), texts(batch)):
                words = words_of(text)
                n = min(window, len(words))
                for i in range(len(words) - n + 1 if n else 0):
                    part = words[i:i + n]
                    found = shingles(hashes.of(part), min(SHINGLE, n)).view(np.int64)
                    rows.append((item, b" ".join(part).decode(), n, found.tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                    (pa.string(), pa.string(), pa.int32(), pa.list_(pa.int64())))],
                names=["item_id", "words", "n", "shingles"])

    source = items.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("string").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return source.mapInArrow(cut, "item_id string, words string, n int, shingles array<long>").distinct()


def rarity(docs: DataFrame, vocabulary: DataFrame, sizes: list[int]) -> DataFrame:
    """h, n: how often each shingle of ``vocabulary`` (h) occurs in all documents; each task adds up its own first."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(bitmap(vocabulary, "h", bitmap_size(vocabulary.count())))

    def count(batches):
        import pyarrow as pa
        hashes, bits = WordHashes(), shared.value
        for batch in batches:
            found = [np.zeros(0, np.uint64)]
            for text in texts(batch):
                words = hashes.of(words_of(text))
                for size in sizes:
                    h = shingles(words, size)
                    found.append(h[in_bitmap(bits, h)])
            h, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], names=["h", "n"])

    return (docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
            .join(vocabulary, "h"))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """words, n, h, at: the rarest shingle of each window and its place (ties: the smaller hash, then the first)."""
    each = windows.select("words", "n", F.posexplode("shingles").alias("at", "h"))
    return (each.join(counts, "h", "left")
            .groupBy("words", "n").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "h", "at")).alias("p"))
            .select("words", "n", "p.h", "p.at"))


def suspects(docs: DataFrame, prefix: DataFrame, window: int, sizes: list[int]) -> DataFrame:
    """rid, doc_id, n_words and places: [h, at, first, context], where a prefix shingle may stand.

    ``context`` holds the words around the place, the earliest of them being word ``first``.
    """
    spark = docs.sparkSession
    hashes_of_prefix = prefix.select("h").distinct()
    shared = spark.sparkContext.broadcast(bitmap(hashes_of_prefix, "h", bitmap_size(hashes_of_prefix.count())))

    def scan(batches):
        import pyarrow as pa
        hashes, bits = WordHashes(), shared.value
        place = pa.struct([("h", pa.int64()), ("at", pa.int32()), ("first", pa.int32()), ("context", pa.string())])
        for batch in batches:
            n_words, places = [], []
            for text in texts(batch):
                words = words_of(text)
                n_words.append(len(words))
                own, h = [], hashes.of(words) if sizes else None
                for size in sizes:
                    s = shingles(h, size)
                    for at in np.flatnonzero(in_bitmap(bits, s)).tolist():
                        first = max(0, at - window + 1)
                        own.append({"h": int(s[at:at + 1].view(np.int64)[0]), "at": at, "first": first,
                                    "context": b" ".join(words[first:at + window]).decode()})
                places.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ident"), pa.array(n_words, pa.int64()), pa.array(places, pa.list_(place))],
                names=["doc_id", "ident", "n_words", "places"])

    schema = f"doc_id long, ident {IDENT}, n_words long, places array<struct<h: long, at: int, first: int, context: string>>"
    found = docs.mapInArrow(scan, schema)
    return table(found.withColumn("rid", F.monotonically_increasing_id()), "suspects")


def matches(suspected: DataFrame, prefix: DataFrame) -> DataFrame:
    """rid, start, n, words: every place where a whole window stands, words compared."""
    places = suspected.where(F.size("places") > 0).select("rid", "n_words", F.inline("places"))
    p = prefix.select("words", "n", F.col("h").alias("p_h"), F.col("at").alias("p_at"))
    start = F.col("at") - F.col("p_at")
    inside = (start >= F.col("first")) & (start + F.col("n") <= F.col("n_words"))
    there = F.array_join(F.slice(F.split("context", " "), start - F.col("first") + 1, F.col("n")), " ")
    return (places.join(p, F.col("h") == F.col("p_h")).where(inside).where(there == F.col("words"))
            .select("rid", start.alias("start"), "n", "words"))


def covered(spans):
    """Words inside any of the spans (start, n): spans by start, each adding what is past the end so far."""
    def add(total, s):
        end = s["start"] + s["n"]
        return F.struct(F.greatest(total["end"], end).alias("end"),
                        (total["n"] + F.greatest(F.lit(0), end - F.greatest(total["end"], s["start"]))).alias("n"))
    return F.aggregate(F.sort_array(spans), F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), add, lambda t: t["n"])


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, ident, n_words, n_hit (words inside windows of items), n_items, items (sorted as strings) of every document row."""
    docs = docs_of(docs).withColumn("ident", identity())
    windows = table(windows_of(items, window), "item-windows")
    vocabulary = windows.select(F.explode("shingles").alias("h")).distinct()
    # Items of one word have shingles of one word; the others of SHINGLE words.
    sizes = [r["s"] for r in windows.select(F.least(F.col("n"), F.lit(SHINGLE)).alias("s")).distinct().collect()]
    counts = rarity(docs, vocabulary, sizes).withColumnRenamed("n", "df")
    prefix = table(prefixes(windows.drop("item_id").distinct(), counts), "prefixes")
    suspected = suspects(docs, prefix, window, sizes)
    found = table(matches(suspected, prefix), "matches")
    hit = (found.groupBy("rid").agg(F.collect_set(F.struct("start", "n")).alias("s"))
           .select("rid", covered(F.col("s")).cast("long").alias("n_hit")))
    named = (found.select("rid", "words").distinct().join(windows.select("words", "item_id"), "words")
             .groupBy("rid").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    return (suspected.select("rid", "doc_id", "ident", "n_words").join(hit, "rid", "left").join(named, "rid", "left")
            .select("doc_id", "ident", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def clean_documents(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` (all columns) without the documents that contain a window of an item."""
    found = decontaminate(docs, items, window).where("n_hit > 0")
    return without(docs, table(found.select("ident").distinct(), "contaminated"))
