"""Importance resampling towards a target: features in hashed buckets, an exact weighted draw without replacement.

Features are words and runs of two words; a feature's bucket is the CRC-32 of
its bytes modulo the number of buckets.  No feature is ever put together as a
string: frequent words, each between delimiters, are the dictionary of an
Aho-Corasick automaton whose payloads are the words' CRCs and lengths.  A scan
of a text emits the payloads of its words in order, and the CRC of two adjacent
words follows from theirs, since a CRC moves past ``n`` further bytes by a
linear map that depends on ``n`` only (``Shift``).  Words that the dictionary
lacks are what lies between two matches; their payloads are computed there, so
the dictionary's bound changes the speed only.

One pass over the documents counts words for the dictionary, one scans and
writes each document's buckets (two bytes a feature).  Counts per bucket are
added up per task first; the driver holds one number per bucket.  The draw is a
distributed sort: rows are dealt by ranges of (score, doc_id), so neither one
score nor one id lands in one task, and a rank is the number of rows in the
ranges before plus the place in its own.

Null text: no words.  A null doc_id counts as the empty text in the hash and
comes after all others among equal scores.  Repeated rows are documents of
their own, with ranks of their own.  An empty table gives an empty result, an
empty target gives every bucket the gain of its smoothed share.  Other columns
are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from rivalry.llm.common import docs_of, table
from rivalry.llm.decontaminate import WORD_BYTES
from rivalry.llm.lm_score import head_floor
from rivalry.llm.tokens import texts

LONGEST = 64  # bytes of a dictionary word


class Shift:
    """The map that moves a CRC-32 past ``n`` further bytes: crc(a + b) = shift(crc(a), len(b)) ^ crc(b).

    It is linear in the CRC's bits, so for each ``n`` it is four tables, one per byte of the CRC.
    """

    def __init__(self):
        self.tables = self.of_bits(np.array([[1 << k for k in range(32)]], np.uint32))

    @staticmethod
    def of_bits(maps: np.ndarray) -> np.ndarray:
        """Tables (n, 4, 256) of maps (n, 32) given by the images of the single bits."""
        out = np.zeros((len(maps), 4, 256), np.uint32)
        values = np.arange(256)
        for byte in range(4):
            for bit in range(8):
                out[:, byte] ^= np.where(values >> bit & 1, maps[:, 8 * byte + bit, None], 0).astype(np.uint32)
        return out

    def apply(self, tables: np.ndarray, which: np.ndarray, crc: np.ndarray) -> np.ndarray:
        out = tables[which, 0, crc & 255]
        for byte in (1, 2, 3):
            out ^= tables[which, byte, crc >> np.uint32(8 * byte) & 255]
        return out

    def single(self, n: int) -> np.ndarray:
        """The tables of a far shift, by squaring."""
        bits = np.array([1 << k for k in range(32)], np.uint32)
        # One further zero byte: eight steps of the reflected polynomial.
        step, result = bits.copy(), bits
        for _ in range(8):
            step = (step >> np.uint32(1)) ^ np.where(step & 1, np.uint32(0xEDB88320), np.uint32(0))
        while n:
            tables = self.of_bits(step[None])
            if n & 1:
                result = self.apply(tables, np.zeros(32, np.int64), result)
            step = self.apply(tables, np.zeros(32, np.int64), step)
            n >>= 1
        return self.of_bits(result[None])

    def near(self, most: int) -> None:
        """Have the tables of all shifts up to ``most``."""
        while len(self.tables) <= most:
            self.tables = np.concatenate([self.tables, self.single(len(self.tables))])

    def __call__(self, crc: np.ndarray, n: np.ndarray) -> np.ndarray:
        """``crc`` past ``n`` bytes, elementwise."""
        self.near(LONGEST + 1)
        far = n > LONGEST + 1
        out = self.apply(self.tables, np.where(far, 0, n), crc)
        for length in np.unique(n[far]).tolist():
            own = np.flatnonzero(n == length)
            out[own] = self.apply(self.single(length), np.zeros(len(own), np.int64), crc[own])
        return out


BLANK = zlib.crc32(b" ")


def word_counts(docs: DataFrame, hold: int = 400_000) -> DataFrame:
    """word, c: of all words; a task holds at most about ``hold`` words at a time."""
    def count(batches):
        import pyarrow as pa
        held = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.binary()),
                                                pa.array(list(held.values()), pa.int64())], names=["word", "c"])
            held.clear()
            return batch

        for batch in batches:
            for text in texts(batch):
                held.update(text.translate(WORD_BYTES).split())
                if len(held) >= hold:
                    yield out()
        yield out()

    return table(docs.select("text").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")),
                 "feature-words")


def dictionary(docs: DataFrame, most: int) -> list[str]:
    """The most frequent words, at most ``most``; longer ones than ``LONGEST`` bytes and words found once are left out."""
    counts = word_counts(docs).where((F.length("word") <= LONGEST) & (F.col("c") > 1))
    rows = counts.where(F.col("c") >= head_floor(counts, most)).select("word").toArrow()
    return sorted(w.decode() for w in rows.column("word").to_pylist())


class Payloads:
    """The CRC and the length in bytes of every word of a text, by one scan."""

    def __init__(self, words: list[str]):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        raw = [w.encode() for w in words]
        self.crc = np.array([zlib.crc32(w) for w in raw], np.uint32)
        self.size = np.array([len(w) for w in raw], np.int64)
        self.chars = np.array([len(w) for w in words], np.int64)
        for i, w in enumerate(words):
            self.automaton.add_word(f" {w} ", i)
        self.automaton.make_automaton()

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        line = " " + text.translate(WORD_BYTES).decode() + " "
        found = list(self.automaton.iter(line)) if len(self.crc) else []
        at = np.array(found, np.int64).reshape(-1, 2)
        ends, which = at[:, 0], at[:, 1]
        crc, size = self.crc[which], self.size[which]
        # From the delimiter that ends a match to the one before the next: nothing, blanks, or words of no entry.
        low = np.concatenate([[0], ends])
        high = np.concatenate([ends - self.chars[which] - 1, [len(line) - 1]])
        places, more = [], []
        for k in np.flatnonzero(high - low > 1).tolist():
            own = [w for w in line[low[k] + 1:high[k]].split(" ") if w]
            places += [k] * len(own)
            more += own
        if more:
            raw = [w.encode() for w in more]
            crc = np.insert(crc, places, np.fromiter(map(zlib.crc32, raw), np.uint32, len(raw)))
            size = np.insert(size, places, np.fromiter(map(len, raw), np.int64, len(raw)))
        return crc, size


def feature_hashes(crc: np.ndarray, size: np.ndarray, shift: Shift) -> np.ndarray:
    """CRCs of all words, then of all runs of two words joined by a blank."""
    if len(crc) < 2:
        return crc
    # word + " " + next: the word moves past the next one and the blank, the blank past the next one.
    pairs = shift(crc[:-1], size[1:] + 1) ^ shift(np.full(len(crc) - 1, BLANK, np.uint32), size[1:]) ^ crc[1:]
    return np.concatenate([crc, pairs])


def bucketed(docs: DataFrame, words: list[str], buckets: int) -> DataFrame:
    """doc_id, n_words, n_features, found (every feature's bucket, two bytes each) of every row."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("a bucket's number takes two bytes")
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def scan(batches):
        import pyarrow as pa
        payloads, shift = Payloads(shared.value), Shift()
        for batch in batches:
            n, sizes, found = [], [], []
            for text in texts(batch):
                crc, size = payloads.of(text)
                own = feature_hashes(crc, size, shift) % np.uint32(buckets)
                n.append(len(crc))
                sizes.append(len(own))
                found.append(own.astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())],
                names=["doc_id", "n_words", "n_features", "found"])

    return docs.mapInArrow(scan, "doc_id long, n_words long, n_features long, found binary")


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket: one number each."""
    def add(batches):
        import pyarrow as pa
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for raw in batch.column("found").to_pylist():
                total += np.bincount(np.frombuffer(raw, "<u2"), minlength=buckets)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(total[own])], names=["bucket", "n"])

    rows = (found.select("found").mapInArrow(add, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))).toArrow()
    out = np.zeros(buckets, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much more likely each bucket is in the target than in the source, both smoothed by one."""
    s_all, t_all, n = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log(((t + 1.0) * (s_all + n)) / ((s + 1.0) * (t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weighed(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``found`` with weight (the floored mean of its features' gains; none: 0) in place of its buckets."""
    def weigh(batches):
        import pyarrow as pa
        for batch in batches:
            total = [int(gain[np.frombuffer(raw, "<u2")].sum()) for raw in batch.column("found").to_pylist()]
            weight = [t // n if n else 0 for t, n in zip(total, batch.column("n_features").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "n_words", "n_features")] + [pa.array(weight, pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight"])

    return found.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """A document's own draw from the standard Gumbel distribution, times 1000 and floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, percent: int) -> DataFrame:
    """``rows`` (doc_id, score, ...) with rank: 1, 2, ... from the highest score, ties to the smaller doc_id; null beyond
    ``percent`` of all rows."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_at")]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = table(rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(n, *order)
                  .sortWithinPartitions(*order).drop("_at")
                  # The partition's number above 33 bits of the place within.
                  .withColumn("_place", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_place", 33)
    sizes = {r["p"]: r["n"] for r in dealt.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    total, before = 0, []
    for p in sorted(sizes):
        before.append((p, total))
        total += sizes[p]
    # One row per shuffle partition.
    starts = rows.sparkSession.createDataFrame(before, "_part long, _before long")
    rank = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (dealt.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn("rank", rank)
            .withColumn("rank", F.when(F.col("rank") <= percent * total // 100, F.col("rank")))
            .drop("_part", "_place", "_before"))


def importance_sample(docs: DataFrame, target: DataFrame, buckets: int = 10_000, percent: int = 25, least_words: int = 20,
                      seed: int = 7, words: int = 50_000) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank (of the drawn ones) of every row of ``docs``.

    ``percent`` of the documents with at least ``least_words`` words are drawn, those with the highest weight plus noise,
    which is a draw without replacement in proportion to exp(weight / 1000).  ``target``: rows with ``text``.
    """
    docs = docs_of(docs)
    goal = target.select(F.lit(None).cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    known = dictionary(docs, words)
    found = table(bucketed(docs, known, buckets), "buckets")
    gain = gains(bucket_counts(found, buckets), bucket_counts(bucketed(goal, known, buckets), buckets))
    scored = table(weighed(found, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scores")
    drawn = ranked(scored.where(F.col("n_words") >= least_words), percent)
    short = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(short).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
