"""Scores of whole texts by a gated recurrent language model (``gated_model.py``).

Word counts come from all training documents, added up per block before they
are shuffled.  The model learns from all training documents, each in one of
several rounds.  A round's documents are dealt by their hash into shares of a
fixed size in tokens; a share is learned from in a fixed order, from the same
parameters as all others, and the mean of the results, weighted by tokens,
starts the next round.  Shares, their order and the order of every sum follow
from the documents alone, so the scores don't depend on the cluster.  Scoring
walks every whole document.  Only words above a count (at most ``head`` words,
so of fixed bound) are broadcast; the other words of a document are joined
with the counts by shuffle.

Null text: empty, its only token is the end.  A null doc_id counts as the
empty text.  Repeated rows are learned and scored one by one; without training
documents all words are unknown; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from rivalry.llm.common import Shared, docs_of, table
from rivalry.llm.gated_model import Model, Shape
from rivalry.llm.tokens import Words, blocks

END = b"\n"  # no word has white space
ALPHA = 0.1
ENDINGS = 32
CHUNK = 4096


def ending_of(word: bytes) -> int:
    """The class of a word that isn't frequent: by its last two bytes."""
    return zlib.crc32(word[-2:]) % ENDINGS


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def word_counts(docs: DataFrame) -> DataFrame:
    """word, c, ending: of all tokens; each block of texts is added up first."""
    def count(batches):
        import pyarrow as pa
        for (found,) in blocks((b.column("text"),) for b in batches):
            words = Words(found, END)
            c = np.bincount(words.codes, minlength=len(words.array))
            own = np.flatnonzero(c)  # not the empty word that white space leaves
            yield pa.RecordBatch.from_arrays([words.array.take(pa.array(own)), pa.array(c[own])], names=["word", "c"])

    return table(docs.select("text").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))
                 .withColumn("ending", F.crc32(F.substring("word", -2, 2)) % ENDINGS), "word-counts")


def head_floor(counts: DataFrame, head: int) -> int:
    """The least count c so that at most ``head`` words have it: counts by powers of 2 ** (1/8), so few rows."""
    step = F.floor(F.log2("c") * 8)
    rows = counts.groupBy(step.alias("s")).agg(F.count("*").alias("n"), F.min("c").alias("low")).collect()
    total, floor = 0, None
    for row in sorted(rows, key=lambda r: -r["s"]):
        total += row["n"]
        if total > head:
            return floor if floor is not None else row["low"] + 1
        floor = row["low"]
    return 1


class Endings(dict):
    """The last two bytes of a word that isn't frequent to its symbol; at most 65,792 entries."""

    def __init__(self, frequent: int):
        super().__init__()
        self.frequent = frequent

    def __missing__(self, tail: bytes) -> int:
        self[tail] = s = self.frequent + ending_of(tail)
        return s


class Symbols:
    """Words to the model's symbols: frequent ones have their own, others that of their ending."""

    def __init__(self, frequent: list[bytes]):
        self.words, self.endings = {w: i for i, w in enumerate(frequent)}, Endings(len(frequent))

    def of(self, distinct: list[bytes]) -> np.ndarray:
        endings = self.endings
        return np.array([endings[w[-2:]] if s is None else s for s, w in zip(map(self.words.get, distinct), distinct)], np.int32)


class Language:
    """What scoring needs: counts, the head words and the model's sizes."""

    def __init__(self, counts: DataFrame, head: int, frequent: int, hidden: int):
        total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
        self.n, self.v = total["n"] or 0, total["v"] or 0
        self.floor = head_floor(counts, head)
        rows = counts.where((F.col("c") >= self.floor) | (F.col("word") == F.lit(bytearray(END)))).select("word", "c").toArrow()
        found = dict(zip(rows.column("word").to_pylist(), rows.column("c").to_pylist()))
        found.setdefault(END, 0)
        # The end is always a frequent word; then by count, ties by bytes.
        self.head = sorted(found, key=lambda w: (w != END, -found[w], w))
        self.counts = np.array([found[w] for w in self.head], np.int64)
        self.frequent = min(frequent, len(self.head))
        n, v = np.zeros(ENDINGS, np.int64), np.zeros(ENDINGS, np.int64)
        for r in counts.groupBy("ending").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
            n[r["ending"]], v[r["ending"]] = r["n"], r["v"]
        for w, c in zip(self.head[:self.frequent], self.counts[:self.frequent].tolist()):
            n[ending_of(w)] -= c
            v[ending_of(w)] -= c > 0
        self.ending_n, self.ending_v = n, v
        self.shape = Shape(self.frequent, ENDINGS, hidden)

    def first(self) -> np.ndarray:
        return self.shape.first(self.counts[:self.frequent].astype(float), self.ending_n.astype(float))

    def base(self, c):
        return np.log10((c + ALPHA) / (self.n + ALPHA * (self.v + 1)))

    def share(self, word_ending, c):
        """Log share of a word that isn't frequent within its class of endings; unknown words share one place."""
        return np.log10((c + ALPHA) / (self.ending_n[word_ending] + ALPHA * (self.ending_v[word_ending] + 1)))


# Tokens of a share, and groups of shares that are added up where they are learned from.
SHARE, GROUPS = 2_000_000, 4096


def train_round(docs: DataFrame, language: Language, vector: np.ndarray, rate: float, shares: int) -> np.ndarray:
    """Every share's pass over its documents (share, hash, doc_id, text) from the same parameters; the mean of the
    results."""
    spark = docs.sparkSession
    shared = Shared(spark, (language.head[:language.frequent], language.shape, vector))
    # Few shares: each is a group.  Many: neighbours are added up in their order, so that the sums stay few.
    size = -(-shares // GROUPS)

    def train(batches):
        import pyarrow as pa
        frequent, shape, start = shared.value
        symbols, now, total, seen = Symbols(frequent), None, None, 0

        def parts():
            for batch in batches:
                share = batch.column("share").to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), len(share)]
                for a, b in zip(cuts[:-1], cuts[1:]):
                    if b > a:
                        yield int(share[a]), batch.column("text").slice(a, b - a)

        def out():
            for i in range(0, shape.size, CHUNK):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([now], pa.int64()), pa.array([total[i:i + CHUNK].tobytes()], pa.binary()),
                     pa.array([seen], pa.int64())], names=["chunk", "part", "sums", "n"])

        from itertools import groupby
        for share, own in groupby(parts(), key=lambda part: part[0]):
            if share // size != now:
                if now is not None:
                    yield from out()
                now, total, seen = share // size, np.zeros(shape.size), 0
            model, squares, n = Model(shape, start.copy()), np.zeros(shape.size, np.float32), 0
            for (found,) in blocks((text,) for _, text in own):
                words = Words(found, END)
                stream = symbols.of(words.distinct)[words.codes]
                model.train(np.split(stream, words.starts[1:-1]), squares, rate)
                n += len(stream)
            total += model.vector.astype(np.float64) * n
            seen += n
        if now is not None:
            yield from out()

    def add(batches):
        # Chunks arrive in order, and each chunk's parts: one sum is held at a time, and is always the same.
        import pyarrow as pa
        now, total, n = None, None, 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([0]), pa.array([total.tobytes()], pa.binary()),
                                               pa.array([n], pa.int64())], names=["chunk", "part", "sums", "n"])

        for batch in batches:
            for i, raw, k in zip(*(batch.column(c).to_pylist() for c in ("chunk", "sums", "n"))):
                values = np.frombuffer(raw)
                if i == now:
                    total, n = total + values, n + k
                    continue
                if now is not None:
                    yield out()
                now, total, n = i, values, k
        if now is not None:
            yield out()

    schema = "chunk int, part long, sums binary, n long"
    group = F.floor(F.col("share") / size)
    n = min(-(-shares // size), int(spark.conf.get("spark.sql.shuffle.partitions")))
    sums = (docs.repartition(n, group).sortWithinPartitions("share", "hash", "doc_id").select("share", "text")
            .mapInArrow(train, schema)
            .repartition("chunk").sortWithinPartitions("chunk", "part").mapInArrow(add, schema)).toArrow()
    mean = vector.copy()
    for i, raw, n in zip(*(sums.column(c).to_pylist() for c in ("chunk", "sums", "n"))):
        mean[i:i + CHUNK] = (np.frombuffer(raw) / n).astype(np.float32)
    return mean


def learn(docs: DataFrame, counts: DataFrame, head: int = 250_000, frequent: int = 2048, hidden: int = 16,
          rounds: int = 3, rate: float = 0.1, share: int = SHARE) -> tuple[Language, np.ndarray]:
    """The language and its parameters: each training document is learned from once, in one of the rounds."""
    language = Language(counts, head, frequent, hidden)
    vector = language.first()
    shares = max(1, round(language.n / rounds / share))
    place = F.pmod("hash", F.lit(rounds * shares))
    dealt = docs.withColumn("hash", F.xxhash64("doc_id", "text"))
    for i in range(rounds):
        own = dealt.where(F.pmod(place, F.lit(rounds)) == i).withColumn("share", F.floor(place / rounds))
        vector = train_round(own, language, vector, rate, shares)
    return language, vector


TAIL = "array<struct<word: binary, tf: long>>"


def score(docs: DataFrame, language: Language, vector: np.ndarray, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    shared = Shared(spark, (language, vector))

    def scan(batches):
        import pyarrow as pa
        language, vector = shared.value
        number_of, symbols = {w: i for i, w in enumerate(language.head)}, Symbols(language.head[:language.frequent])
        model, frequent = Model(language.shape, vector), language.frequent
        # One more place, for words beyond the head.
        base, share = np.append(language.base(language.counts), 0.0), np.zeros(len(language.head) + 1)
        share[frequent:-1] = language.share(symbols.of(language.head[frequent:]) - frequent, language.counts[frequent:])
        known = np.append(language.counts > 0, False).astype(np.int64)
        for found, ids in blocks((b.column("text"), b.column("doc_id")) for b in batches):
            # Equal texts have equal scores: each is walked once a block.
            every = found.dictionary_encode()
            place = every.indices.to_numpy(zero_copy_only=False)
            words = Words(every.dictionary, END)
            distinct = words.distinct
            own = np.array([number_of.get(w, -1) for w in distinct], np.int32)
            numbers, first = own[words.codes], words.starts[:-1]
            sizes = np.diff(words.starts)
            logs = model.score(np.split(symbols.of(distinct)[words.codes], first[1:])) / math.log(10)
            sums = [np.add.reduceat(each[numbers], first) for each in (known, base, share)]
            # Words beyond the head: how often each stands in each text.
            rest = np.flatnonzero(numbers < 0)
            owner = np.searchsorted(words.starts, rest, side="right") - 1
            pairs, tf = np.unique(owner * len(distinct) + words.codes[rest], return_counts=True)
            ends = np.searchsorted(pairs, np.arange(len(sizes) + 1) * len(distinct))
            tails = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                [words.array.take(pa.array(pairs % len(distinct))), pa.array(tf.astype(np.int64))], names=["word", "tf"]))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes[place]), pa.array(sums[0][place]), pa.array(sums[1][place]),
                 pa.array((sums[2] + logs)[place]), tails.take(pa.array(place))],
                names=["doc_id", "n_tokens", "n_known", "base", "model", "tail"])

    schema = f"doc_id long, n_tokens long, n_known long, base double, model double, tail {TAIL}"
    found = table(docs.select("doc_id", "text").mapInArrow(scan, schema)
                  .withColumn("rid", F.monotonically_increasing_id()), "scores")
    # Words beyond the head, each with its count.
    tail = found.where(F.size("tail") > 0).select("rid", F.inline("tail"))
    rare = counts.where(F.col("c") < language.floor).select("word", "c")
    c = F.coalesce("c", F.lit(0))
    ending = (F.crc32(F.substring("word", -2, 2)) % ENDINGS).cast("int")
    total = F.get(F.array(*[F.lit(float(n + ALPHA * (v + 1))) for n, v in zip(
        language.ending_n.tolist(), language.ending_v.tolist())]), ending)
    rest = (tail.join(rare, "word", "left").groupBy("rid").agg(
        F.sum(F.when(c > 0, F.col("tf")).otherwise(0)).alias("k"),
        F.sum(F.col("tf") * F.log10((c + ALPHA) / F.lit(float(language.n + ALPHA * (language.v + 1))))).alias("b"),
        F.sum(F.col("tf") * F.log10((c + ALPHA) / total)).alias("m")))
    return (found.drop("tail").join(rest, "rid", "left")
            .select("doc_id", "n_tokens", (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
                    (F.col("base") + F.coalesce("b", F.lit(0.0))).alias("base_score"),
                    (F.col("model") + F.coalesce("m", F.lit(0.0))).alias("score")))


def lm_scores(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    Documents whose crc32(doc_id as text) is divisible by 10 are held out of all learning.
    """
    docs = docs_of(docs)
    training = docs.where(~held_out(F.col("doc_id")))
    counts = word_counts(training)
    language, vector = learn(training, counts, **options)
    return (score(docs, language, vector, counts)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
                    F.lit(language.n).cast("long").alias("train_tokens"), "base_score", "score"))
