"""Line dedup: two Bloom filters, then exact confirmation of suspected repeats.

Pass 1 builds in every task a filter of hashes seen once and one of hashes
seen twice (in different documents); two tasks' filters combine to a filter
that knows what both have seen.  Filters have a fixed bound and are combined
block by block.  Pass 2 sends only the keys that the twice filter knows into a
shuffle, added up per task first, which counts documents by the keys
themselves and picks each key's first document.  Pass 3 rewrites the texts in
place: the dropped keys are broadcast if their measured size is within a bound,
else they are joined by shuffle; both ways give the same result.

A key is a line without white space at its ends, A-Z lower-cased.  Null text:
one empty line, and stays null.  Documents are rows: repeated rows count as
many, and rows with the same doc_id and text keep the same lines.  Rows
without a doc_id come last in the choice of the first.  An empty table gives
an empty result; all columns of the input are kept.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from rivalry.llm.common import table
from rivalry.llm.hashing import bitmap_size, mixed

EDGE = b" \t\n\r\x0b\x0c"
BLOCK = 1 << 14  # bytes of a filter that travel as one row
HASHES = 2


def key_of(line: bytes) -> bytes:
    return line.strip(EDGE).lower()


def keys_of(text: bytes, least: int, least_words: int = 0) -> set[bytes]:
    """The distinct keys of at least ``least`` code points and ``least_words`` words."""
    found = set(map(key_of, text.split(b"\n")))
    if least_words > 1:
        # Words are at least one byte each, with white space between them.
        found = {k for k in found if len(k) >= 2 * least_words - 1 and len(k.split()) >= least_words}
    if least > 1:
        return {k for k in found if len(k) >= least and len(k.decode()) >= least}
    return found - {b""} if least else found


def hashes_of(keys) -> np.ndarray:
    import xxhash
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), dtype=np.uint64)


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each hash, one row per hash function."""
    second = mixed(hashes)
    return np.stack([hashes & np.uint64(bits - 1), second & np.uint64(bits - 1)])


def known(filter_: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether all bits of each hash are set."""
    return ((filter_[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def set_bits(filter_: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(filter_, (at >> np.uint64(3)).ravel(), np.left_shift(1, (at & np.uint64(7)).ravel()).astype(np.uint8))


def see(once: np.ndarray, twice: np.ndarray, hashes: np.ndarray) -> None:
    """Add hashes, one for each document that a key is in."""
    distinct, n = np.unique(hashes, return_counts=True)
    at = places(distinct, 8 * len(once))
    set_bits(twice, at[:, known(once, at) | (n > 1)])
    set_bits(once, at)


def combine(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """What two (once, twice) filters have seen together: bits that both have seen once were seen twice."""
    return a[0] | b[0], a[1] | b[1] | (a[0] & b[0])


def raw_texts(batch, column: str) -> list[bytes]:
    import pyarrow as pa
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def twice_filter(docs: DataFrame, least: int, max_bits: int, least_words: int = 0) -> np.ndarray:
    """The filter of hashes seen in two documents or more."""
    spark = docs.sparkSession
    lines = docs.agg(F.sum(F.size(F.split("text", "\n")))).first()[0] or 0
    bits = bitmap_size(lines, per_hash=8, least=8 * BLOCK, most=max_bits)

    def build(batches):
        import pyarrow as pa
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            keys = [k for text in raw_texts(batch, "text") for k in keys_of(text, least, least_words)]
            see(once, twice, hashes_of(keys))
        used = [i for i in range(bits // 8 // BLOCK) if once[i * BLOCK:(i + 1) * BLOCK].any()]
        for i in used:
            part = slice(i * BLOCK, (i + 1) * BLOCK)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([once[part].tobytes()], pa.binary()),
                 pa.array([twice[part].tobytes()], pa.binary())], names=["block", "once", "twice"])

    def fold(batches):
        # Blocks arrive in order: one is held at a time.
        import pyarrow as pa
        now, state = None, None
        for batch in batches:
            for i, a, b in zip(*(batch.column(c).to_pylist() for c in ("block", "once", "twice"))):
                new = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
                if i == now:
                    state = combine(state, new)
                    continue
                if now is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([state[1].tobytes()], pa.binary())],
                                                     names=["block", "twice"])
                now, state = i, new
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([state[1].tobytes()], pa.binary())],
                                             names=["block", "twice"])

    # As many filters as tasks run at a time, whatever the number of splits.
    builders = max(1, 2 * spark.sparkContext.defaultParallelism)
    blocks = (docs.select("text").coalesce(builders).mapInArrow(build, "block int, once binary, twice binary")
              .repartition("block").sortWithinPartitions("block").mapInArrow(fold, "block int, twice binary"))
    out = np.zeros(bits // 8, np.uint8)
    found = blocks.toArrow()  # at most max_bits / 8 bytes
    for i, part in zip(found.column("block").to_pylist(), found.column("twice").to_pylist()):
        out[i * BLOCK:(i + 1) * BLOCK] = np.frombuffer(part, np.uint8)
    return out


ORDER = "last: boolean, doc_id: long, mark: long"


def repeated_keys(docs: DataFrame, twice: np.ndarray, least: int, min_docs: int, hold: int = 200_000,
                  least_words: int = 0) -> DataFrame:
    """key, first: the keys found in at least ``min_docs`` documents and their first document.

    ``hold`` keys at most are added up in a task before they are sent.
    """
    shared = docs.sparkSession.sparkContext.broadcast(twice)

    def scan(batches):
        import pyarrow as pa
        filter_, held = shared.value, {}
        order = pa.struct([("last", pa.bool_()), ("doc_id", pa.int64()), ("mark", pa.int64())])

        def out():
            rows = [(k, n, {"last": f[0], "doc_id": f[1], "mark": f[2]}) for k, (n, f) in held.items()]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], order)], names=["key", "n", "first"])

        for batch in batches:
            for doc_id, mark, text in zip(batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist(),
                                          raw_texts(batch, "text")):
                keys = list(keys_of(text, least, least_words))
                here = doc_id is None, doc_id or 0, mark
                for i in np.flatnonzero(known(filter_, places(hashes_of(keys), 8 * len(filter_)))).tolist():
                    n, first = held.get(keys[i], (0, here))
                    held[keys[i]] = n + 1, min(first, here)
                if len(held) >= hold:
                    yield out()
        yield out()

    return (marked(docs).mapInArrow(scan, f"key binary, n long, first struct<{ORDER}>")
            .groupBy("key").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
            .where(F.col("n") >= min_docs).select("key", "first"))


def marked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"))


def rewrite(text: bytes, dropped: dict[bytes, tuple], here: tuple, keep_first: bool) -> tuple[bytes, int, int]:
    """The text without the lines of ``dropped`` keys; the first document keeps each key's first line."""
    lines = text.split(b"\n")
    kept, seen = [], set()
    for line in lines:
        key = key_of(line)
        first = dropped.get(key)
        if first is not None:
            if not keep_first or first != here or key in seen:
                continue
            seen.add(key)
        kept.append(line)
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def line_dedup(docs: DataFrame, min_docs: int = 10, least: int = 1, keep_first: bool = True,
               max_bits: int = 1 << 28, broadcast_bytes: int = 64 << 20, least_words: int = 0) -> DataFrame:
    """``docs`` (all columns) with repeated lines taken out of ``text``, and n_lines, n_dropped.

    Keys of at least ``least`` code points and ``least_words`` words found in
    at least ``min_docs`` documents lose all their lines, but for the first in
    the first document if ``keep_first``.  Columns called n_lines and n_dropped are replaced.
    """
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    types = {f.name: f.dataType for f in docs.schema.fields}
    docs = docs.select(*[F.col(c).cast("string").alias(c) if c == "text" else F.col(c) for c in columns])
    twice = twice_filter(docs, least, max_bits, least_words)
    dropped = table(repeated_keys(docs, twice, least, min_docs, least_words=least_words), "repeated-lines")
    size = dropped.agg(F.sum(F.length("key") + 200)).first()[0] or 0
    within = size <= broadcast_bytes
    own = docs.withColumn("_id", F.col("doc_id").cast("long")).withColumn("_mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    if within:
        found = dropped.toArrow()
        shared = spark.sparkContext.broadcast({k: (f["last"], f["doc_id"], f["mark"]) for k, f in zip(
            found.column("key").to_pylist(), found.column("first").to_pylist())})
    else:
        # The keys of each document that are dropped, by shuffle.
        each = keys_in(docs, twice, least, least_words).join(dropped, "key")
        lists = each.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("key", "first")).alias("_dropped"))
        own = (own.join(lists.withColumnsRenamed({"doc_id": "_k", "mark": "_m"}),
                        F.col("_id").eqNullSafe(F.col("_k")) & (F.col("_mark") == F.col("_m")), "left")
               .drop("_k", "_m"))

    def apply(batches):
        import pyarrow as pa
        everywhere = shared.value if within else None
        for batch in batches:
            lists = [None] * batch.num_rows if within else batch.column("_dropped").to_pylist()
            rows = []
            for text, doc_id, mark, own_list in zip(raw_texts(batch, "text"), batch.column("_id").to_pylist(),
                                                    batch.column("_mark").to_pylist(), lists):
                gone = everywhere if within else {x["key"]: tuple(x["first"].values()) for x in own_list or ()}
                rows.append(rewrite(text, gone, (doc_id is None, doc_id or 0, mark), keep_first))
            old = batch.column("text")
            text = pa.array([r[0].decode() if r[2] else o for r, o in zip(rows, old.to_pylist())], pa.string())
            yield pa.RecordBatch.from_arrays(
                [text if c == "text" else batch.column(c) for c in columns]
                + [pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2)], names=[*columns, "n_lines", "n_dropped"])

    schema = ", ".join(f"`{c}` {'string' if c == 'text' else types[c].simpleString()}" for c in columns)
    return own.mapInArrow(apply, schema + ", n_lines long, n_dropped long")


def keys_in(docs: DataFrame, twice: np.ndarray, least: int, least_words: int = 0) -> DataFrame:
    """doc_id, mark, key: the suspected keys of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(twice)

    def scan(batches):
        import pyarrow as pa
        filter_ = shared.value
        for batch in batches:
            rows = []
            for doc_id, mark, text in zip(batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist(),
                                          raw_texts(batch, "text")):
                keys = list(keys_of(text, least, least_words))
                rows += [(doc_id, mark, keys[i]) for i in np.flatnonzero(
                    known(filter_, places(hashes_of(keys), 8 * len(filter_)))).tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))],
                names=["doc_id", "mark", "key"])

    return marked(docs).mapInArrow(scan, "doc_id long, mark long, key binary")
