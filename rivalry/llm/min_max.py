"""Near-duplicates by min-max hashing.

Under each permutation of the shingle hashes both the smallest and the largest
value are kept, so ``bands * rows`` signature values cost half as many hash
evaluations, and both halves agree with the probability of the sets'
similarity.  Documents with equal sets collapse into one class first, so
groups of copies cost one member.  Classes that share a band meet in a bucket:

1. every member is compared with one representative of its bucket, another one
   in every band, which is linear in the members and joins nearly all groups;
2. what may be left are links between members that are still in different
   components: for the members of such buckets only, all pairs that can reach
   the threshold are found through the rarest shingles of each set (prefix,
   length and position bounds, and the sketches of the sets), members of a
   shingle's main component being compared with the others only.

Every link is confirmed on the full sets.  With 24 bands of 4 values a pair at
similarity 0.8 shares no bucket with a probability of 3e-6, less above.

Null or empty text, and text without words: an empty set, linked with nothing.
Rows without a doc_id take part; a component's id is its smallest doc_id (null
if it has none).  Repeated rows are one class.  An empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from rivalry.llm.common import docs_of, table
from rivalry.llm.components import components
from rivalry.llm.hashing import WordHashes, bitmap, bitmap_size, in_bitmap, mixed, shingles
from rivalry.llm.rows import IDENT, doubtful_rows, identity
from rivalry.llm.tokens import texts


def shingle_set(text: bytes, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words (A-Z lower-cased); a shorter text is one run."""
    words = text.lower().split()
    return np.unique(shingles(hashes.of(words), min(size, len(words)))) if words else np.zeros(0, np.uint64)


def sketch(found: np.ndarray, bits: int = 1024) -> np.ndarray:
    """For each of ``bits`` residues, whether an odd number of hashes has it, as 64-bit words.

    Hashes that two sets share cancel out, so the sketches of two sets differ in at most as many bits as the sets do
    in hashes.
    """
    odd = np.bincount((mixed(found) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


class MinMax:
    """Band hashes of shingle sets."""

    def __init__(self, bands: int = 24, rows: int = 4, seed: int = 7):
        if rows % 2:
            raise ValueError("a band holds pairs of a minimum and a maximum")
        random = np.random.default_rng(seed)
        n = bands * rows // 2
        self.bands, self.rows = bands, rows
        self.times = random.integers(1 << 32, size=n, dtype=np.uint32) | np.uint32(1)
        self.plus = random.integers(1 << 32, size=n, dtype=np.uint32)

    def signature(self, found: np.ndarray) -> np.ndarray:
        """Minimum and maximum under each permutation, side by side."""
        x = (found >> np.uint64(32)).astype(np.uint32)
        low, high = np.full(len(self.times), 2**32 - 1, np.uint32), np.zeros(len(self.times), np.uint32)
        for i in range(0, len(x), 4096):  # a block stays in the cache
            p = x[i:i + 4096, None] * self.times + self.plus
            np.minimum(low, p.min(axis=0), out=low)
            np.maximum(high, p.max(axis=0), out=high)
        return np.column_stack([low, high]).ravel()

    def of(self, found: np.ndarray) -> np.ndarray:
        s = self.signature(found).astype(np.uint64).reshape(self.bands, self.rows)
        h = np.arange(self.bands, dtype=np.uint64)
        for k in range(self.rows):
            h = mixed(h) + s[:, k]
        return mixed(h)


def signatures(docs: DataFrame, size: int, hasher: MinMax) -> DataFrame:
    """rid, doc_id, ident, n, high and low (fingerprint of the set), bands of every row."""
    def scan(batches):
        import pyarrow as pa
        import xxhash
        hashes = WordHashes()
        for batch in batches:
            n, high, low, bands = [], [], [], []
            for text in texts(batch):
                found = shingle_set(text, size, hashes)
                print_ = xxhash.xxh3_128_digest(found.tobytes())
                n.append(len(found))
                high.append(int.from_bytes(print_[:8], "little", signed=True))
                low.append(int.from_bytes(print_[8:], "little", signed=True))
                bands.append(hasher.of(found).view(np.int64) if len(found) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ident"), pa.array(n, pa.int64()), pa.array(high, pa.int64()),
                 pa.array(low, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "ident", "n", "high", "low", "bands"])

    found = (docs_of(docs).withColumn("ident", identity())
             .mapInArrow(scan, f"doc_id long, ident {IDENT}, n long, high long, low long, bands array<long>"))
    return table(found.withColumn("rid", F.monotonically_increasing_id()), "signatures")


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """cid, shingles, sketch of the classes in ``wanted`` (cid, ident): their rows are read again, told apart by a bitmap."""
    bits = bitmap(wanted, "ident.a", bitmap_size(wanted.count()))
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def scan(batches):
        import pyarrow as pa
        hashes, bits, done = WordHashes(), shared.value, set()
        for batch in batches:
            rows = np.flatnonzero(in_bitmap(bits, batch.column("ident").field("a").to_numpy().view(np.uint64)))
            wanted_rows, found = batch.take(pa.array(rows)), []
            ident = wanted_rows.column("ident")
            for text, i in zip(texts(wanted_rows), zip(ident.field("a").to_pylist(), ident.field("b").to_pylist())):
                if i not in done:  # repeated rows once per task
                    done.add(i)
                    found.append((i, shingle_set(text, size, hashes)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([{"a": r[0][0], "b": r[0][1]} for r in found], ident.type),
                 pa.array([r[1].view(np.int64) for r in found], pa.list_(pa.int64())),
                 pa.array([sketch(r[1]) for r in found], pa.list_(pa.int64()))], names=["ident", "shingles", "sketch"])

    found = docs_of(docs).withColumn("ident", identity()).mapInArrow(
        scan, f"ident {IDENT}, shingles array<long>, sketch array<long>")
    return table(found.join(wanted, "ident").groupBy("cid").agg(
        F.first("shingles").alias("shingles"), F.first("sketch").alias("sketch")), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    left = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("y"))
    # Sizes first: a set much larger than the other can't be similar.
    joined = pairs.join(left, "a").join(right, "b").where(
        100 * F.least(F.size("x"), F.size("y")) >= percent * F.greatest(F.size("x"), F.size("y")))
    same = F.size(F.array_intersect("x", "y"))
    return joined.where(100 * same >= percent * (F.size("x") + F.size("y") - same)).select("a", "b")


def star_pairs(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``members``: b (bucket), cid.  The members of buckets of two or more, and their pairs with a representative.

    The representative is the least under a permutation of its bucket's own.
    """
    salt = F.xxhash64("b")
    reps = (members.groupBy("b").agg(F.count("*").alias("k"), F.min(F.col("cid").bitwiseXOR(salt)).alias("m"))
            .where("k > 1").select("b", F.col("m").bitwiseXOR(salt).alias("rep")))
    shared = table(members.join(reps, "b"), "buckets")
    pairs = shared.where("cid <> rep").select(F.least("cid", "rep").alias("a"), F.greatest("cid", "rep").alias("b")).distinct()
    return shared, table(pairs, "pairs")


def labelled(frame: DataFrame, roots: DataFrame) -> DataFrame:
    """``frame`` (with cid) and label: its component so far."""
    return (frame.join(roots.select(F.col("v").alias("cid"), "root"), "cid", "left")
            .withColumn("label", F.coalesce("root", "cid")).drop("root"))


def missing_pairs(buckets: DataFrame, sets: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that may still be linked, among members of buckets with several."""
    marked = table(labelled(buckets.select("b", "cid"), roots), "labelled-buckets")
    mixed_ = marked.groupBy("b").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    open_ = table(marked.join(mixed_.select("b"), "b", "left_semi").select("cid", "label").distinct(), "open")
    tokens = sets.join(open_, "cid").select("cid", "label", F.size("shingles").alias("n"), F.explode("shingles").alias("t"))
    counts = tokens.groupBy("t").agg(F.count("*").alias("k")).where("k > 1")
    own = sets.join(open_.select("cid"), "cid", "left_semi").select("cid", F.explode("shingles").alias("t"))
    # Shingles of one set only can't be shared: they come first in the order and need not be sent.
    seen = own.join(counts, "t").groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("k", "t"))).alias("shared"))
    prefix = (seen.join(sets.select("cid", "sketch", F.size("shingles").alias("n")), "cid").join(open_, "cid")
              # Place of the first shared shingle, and the end of the prefix.
              .withColumn("skip", F.col("n") - F.size("shared"))
              .withColumn("end", F.col("n") - F.ceil(F.col("n") * percent / 100.0) + 1)
              .where("skip < end")
              .select("cid", "label", "n", "sketch", "skip", F.posexplode(
                  F.slice("shared", F.lit(1), (F.col("end") - F.col("skip")).cast("int"))).alias("i", "s"))
              .select("cid", "label", "n", "sketch", (F.col("skip") + F.col("i")).alias("at"), F.col("s.t").alias("t")))
    prefix = table(prefix, "prefixes")
    # The component with most members of a shingle: its members are compared with the others only.
    main = (prefix.groupBy("t", "label").agg(F.count("*").alias("k"))
            .groupBy("t").agg(F.count("*").alias("labels"), F.max(F.struct("k", "label")).alias("m"))
            .where("labels > 1").select("t", F.col("m.label").alias("main")))
    # Written, so that both sides of the joins are dealt anew and Spark can split a shingle of many members.
    main = table(main, "main-components")
    probes = prefix.join(main, "t").where("label <> main").select(
        "t", F.col("cid").alias("a"), F.col("label").alias("la"), F.col("n").alias("na"), F.col("at").alias("pa"),
        F.col("sketch").alias("sa"))
    others = prefix.select("t", F.col("cid").alias("b"), F.col("label").alias("lb"), F.col("n").alias("nb"),
                           F.col("at").alias("pb"), F.col("sketch").alias("sb"))
    rest = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    apart = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    possible = ((F.col("la") != F.col("lb")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
                & (rest * (100 + percent) >= percent * (F.col("na") + F.col("nb")))
                & (apart * (100 + percent) <= (100 - percent) * (F.col("na") + F.col("nb"))))
    return table(probes.join(others, "t").where(possible)
                 .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "more-pairs")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, bands: int = 24, rows: int = 4) -> DataFrame:
    """rid, doc_id, ident, n_shingles, component_id (smallest doc_id reachable), kept (doc_id = component_id) and
    first (the one row of its component that stays) of every row.

    Rows are linked whose sets of ``size``-word shingles have a similarity of ``percent`` or more.
    """
    found = signatures(docs, size, MinMax(bands, rows))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "rid")
    classes = table(found.where("n > 0").groupBy("high", "low").agg(
        F.min("rid").alias("cid"), F.min(order).alias("first")), "classes")
    reps = found.join(classes.select(F.col("cid").alias("rid")), "rid")
    members = reps.select(F.col("rid").alias("cid"), F.explode("bands").alias("b"))
    buckets, pairs = star_pairs(members)
    wanted = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    wanted = table(wanted.join(found.select(F.col("rid").alias("cid"), "ident"), "cid"), "wanted")
    sets = sets_of(docs, wanted, size)
    links = table(confirmed(pairs, sets, percent), "links")
    roots = components(links)
    more = missing_pairs(buckets, sets, roots, percent)
    more = table(confirmed(more, sets, percent), "links")
    if not more.isEmpty():
        roots = components(roots.select(F.col("v").alias("a"), F.col("root").alias("b")).union(
            labelled_pairs(more, roots)))
    rooted = labelled(classes, roots)
    ids = rooted.groupBy("label").agg(F.min("first").alias("f"))
    groups = table(rooted.join(ids, "label").select("high", "low", F.col("f.doc_id").alias("component_id"),
                                                    F.col("f.rid").alias("first_rid")), "groups")
    # Sets without shingles share a fingerprint but are linked with nothing.
    joined = found.drop("bands").where("n > 0").join(groups, ["high", "low"], "left").unionByName(
        found.drop("bands").where("n = 0").withColumns({"component_id": F.col("doc_id"), "first_rid": F.col("rid")}))
    return joined.select("rid", "doc_id", "ident", F.col("n").alias("n_shingles"), "component_id",
                         F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
                         (F.col("rid") == F.col("first_rid")).alias("first"))


def labelled_pairs(links: DataFrame, roots: DataFrame) -> DataFrame:
    """The components that each link joins."""
    left = labelled(links.withColumnRenamed("a", "cid"), roots).select(F.col("label").alias("a"), F.col("b").alias("cid"))
    return labelled(left, roots).select("a", F.col("label").alias("b"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` (all columns) with one document of each group: the smallest doc_id; of rows with the same doc_id and
    text one stays.

    Rows that stay for sure never move (``rows.py``).
    """
    groups = table(near_duplicates(docs, size, percent).select("ident", "first"), "verdicts")
    verdicts = groups.groupBy("ident").agg(F.max("first").alias("stays"), F.count("*").alias("k"))
    special = table(verdicts.where("not stays or k > 1").select("ident", "stays"), "special")
    rest = doubtful_rows(docs, special)
    columns = docs.columns
    single = rest.where("_special is null or not _special").select(columns)
    double = rest.where("_special and stays").dropDuplicates(["_ident"]).select(columns)
    return single.union(double)
