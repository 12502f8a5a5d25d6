"""Near-duplicates by SimHash: fingerprints are joined by walking a binary trie of them together with itself.

Equal fingerprints collapse first, so copies cost one entry.  The trie has one
level per bit.  Its upper part is walked in Spark, ``step`` levels at a time:
a pair of nodes carries the number of bits in which their prefixes differ and
goes once that exceeds the budget.  A pair whose nodes hold at most ``leaf``
fingerprints together is a task's unit; the other pairs go on to their
children, so a dense region of the trie is cut as finely as it needs and no
unit grows with the data.  Within a unit the walk goes on bit by bit over the
sorted fingerprints, all node pairs of a level at once in numpy.  What a unit
returns is a star for each group it has linked, so at most one row for each of
its fingerprints; all groups together are the components of all links.

Null or empty text, and text without words: fingerprint zero, linked like any
other.  Fewer words than ``size``: the whole sequence is one shingle.  Rows
without a doc_id take part; a component's id is its smallest doc_id (null if it
has none).  Repeated rows have equal results.  An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, functions as F

from rivalry.llm.common import docs_of, table
from rivalry.llm.components import components
from rivalry.llm.tokens import texts

BITS = 64
SEED = 42
BLOCK = 1 << 16


def fingerprint(text: bytes, size: int) -> int:
    """Bits that are set in over half of the shingles' hashes (A-Z lower-cased, repeats counted)."""
    import xxhash
    words = text.lower().split()
    if not words:
        return 0
    size = min(size, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    runs = map(line.__getitem__, map(slice, starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist()))
    n = len(words) - size + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, runs, repeat(SEED)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, BLOCK):
        part = hashes[i:i + BLOCK, None].view(np.uint8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, fp (the 64 bits as a long) of every row."""
    def scan(batches):
        import pyarrow as pa
        for batch in batches:
            found = np.array([fingerprint(t, size) for t in texts(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))],
                                             names=["doc_id", "fp"])

    return table(docs_of(docs).mapInArrow(scan, "doc_id long, fp long"), "fingerprints")


def descend(x: np.ndarray, y: np.ndarray, same: bool, budget: int, most: int = 1 << 18):
    """Walk the tries of two sorted arrays together: yields (i, j) arrays, places of fingerprints that differ in at
    most ``budget`` bits.  ``same``: both are one array, and each pair of places comes once.

    A node is a run of the array.  At most about ``most`` node pairs are held at a level; the rest of a level waits.
    """
    if not len(x) or not len(y):
        return
    one = np.zeros(1, np.int64)
    waiting = [(BITS - 1, one, one + len(x), one, one + len(y), one)]
    while waiting:
        bit, a0, a1, b0, b1, apart = waiting.pop()
        if len(a0) > most:
            half = len(a0) // 2
            waiting += [(bit, *(v[half:] for v in (a0, a1, b0, b1, apart))),
                        (bit, *(v[:half] for v in (a0, a1, b0, b1, apart)))]
            continue
        small = (a1 - a0) * (b1 - b0) <= 16 if bit >= 0 else np.ones(len(a0), bool)
        if small.any():
            yield from compared(x, y, a0[small], a1[small], b0[small], b1[small], same, budget)
        if small.all():
            continue
        a0, a1, b0, b1, apart = (v[~small] for v in (a0, a1, b0, b1, apart))
        am, bm = middle(x, a0, a1, bit), middle(y, b0, b1, bit)
        twin = (a0 == b0) if same else np.zeros(len(a0), bool)
        children = [(a0, am, b0, bm, apart, a0 >= 0), (am, a1, bm, b1, apart, a0 >= 0),
                    (a0, am, bm, b1, apart + 1, a0 >= 0), (am, a1, b0, bm, apart + 1, ~twin)]
        kept = [np.concatenate(v) for v in zip(*children)]
        good = (kept[0] < kept[1]) & (kept[2] < kept[3]) & (kept[4] <= budget) & kept[5]
        waiting.append((bit - 1, *(v[good] for v in kept[:5])))


def middle(x: np.ndarray, start: np.ndarray, end: np.ndarray, bit: int) -> np.ndarray:
    """Where the runs' second children start: the first fingerprint with the bit set."""
    above = np.uint64((1 << BITS) - (2 << bit))
    return np.clip(np.searchsorted(x, (x[start] & above) | np.uint64(1 << bit)), start, end)


def compared(x, y, a0, a1, b0, b1, same: bool, budget: int, most: int = 1 << 20):
    """Fingerprints of small node pairs (or equal ones) one by one."""
    na, nb = a1 - a0, b1 - b0
    sizes = na * nb
    ends = np.cumsum(sizes)
    for low in range(0, int(ends[-1]), most):
        place = np.arange(low, min(low + most, int(ends[-1])))
        k = np.searchsorted(ends, place, side="right")
        inside = place - (ends[k] - sizes[k])
        i, j = a0[k] + inside // nb[k], b0[k] + inside % nb[k]
        near = np.bitwise_count(x[i] ^ y[j]) <= budget
        if same:
            near &= i < j
        yield i[near], j[near]


class Groups:
    """Groups of places that links join; each is named by its smallest place."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.root[i], self.root[j]
            open_ = a != b
            if not open_.any():
                return
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]


def stars(x: np.ndarray, y: np.ndarray, same: bool, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Every linked fingerprint of a unit beside the first of its group."""
    both = x if same else np.concatenate([x, y])
    groups = Groups(len(both))
    for i, j in descend(x, y, same, budget):
        groups.join(i, j if same else j + len(x))
    far = np.flatnonzero(groups.root != np.arange(len(both)))
    return both[far], both[groups.root[far]]


def units(prints: DataFrame, budget: int, leaf: int, step: int) -> list[tuple[int, DataFrame]]:
    """(depth, frame of unit, a, b): the pairs of prefixes of ``depth`` bits whose fingerprints are joined in one task."""
    def nodes(depth):
        prefix = F.shiftrightunsigned("fp", BITS - depth) if depth else F.lit(0).cast("long")
        return prints.groupBy(prefix.alias("p")).agg(F.count("*").alias("n"))

    top = nodes(0)
    pairs = table(top.select(F.col("p").alias("a"), F.col("p").alias("b"), F.lit(0).alias("apart"),
                             F.col("n").alias("held")), "trie-pairs")
    found, depth = [], 0
    while True:
        done = pairs if depth == BITS else pairs.where(F.col("held") <= leaf)
        found.append((depth, done.select(F.concat_ws(":", F.lit(depth), "a", "b").alias("unit"), "a", "b")))
        heavy = pairs.where(F.col("held") > leaf).select("a", "b", "apart")
        if depth == BITS or heavy.isEmpty():
            return found
        depth = min(BITS, depth + step)
        child = table(nodes(depth).withColumn("up", F.shiftrightunsigned("p", step)), "trie-nodes")
        left = child.select(F.col("up").alias("a"), F.col("p").alias("x"), F.col("n").alias("nx"))
        right = child.select(F.col("up").alias("b"), F.col("p").alias("y"), F.col("n").alias("ny"))
        apart = F.col("apart") + F.bit_count(F.col("x").bitwiseXOR(F.col("y")).bitwiseAND(F.lit((1 << step) - 1)))
        # A node with itself: each pair of its children once.
        once = (F.col("a") != F.col("b")) | (F.col("x") <= F.col("y"))
        held = F.col("nx") + F.when(F.col("x") == F.col("y"), 0).otherwise(F.col("ny"))
        pairs = table(heavy.join(left, "a").join(right, "b").where(once & (apart <= budget))
                      .select(F.col("x").alias("a"), F.col("y").alias("b"), apart.alias("apart"), held.alias("held")),
                      "trie-pairs")


def linked(prints: DataFrame, budget: int, leaf: int = 4096, step: int = 4) -> DataFrame:
    """a, b: edges that join all of ``prints`` (fp, distinct) that are linked, at most one per fingerprint and unit."""
    if BITS % step:
        raise ValueError("the trie's levels must be a multiple of step")
    sides = []
    for depth, own in units(prints, budget, leaf, step):
        at = F.shiftrightunsigned("fp", BITS - depth) if depth else F.lit(0).cast("long")
        placed = prints.withColumn("p", at)
        sides.append(placed.join(own.select("unit", F.col("a").alias("p")), "p")
                     .select("unit", F.lit(False).alias("second"), "fp"))
        sides.append(placed.join(own.where("a <> b").select("unit", F.col("b").alias("p")), "p")
                     .select("unit", F.lit(True).alias("second"), "fp"))
    dealt = sides[0]
    for side in sides[1:]:
        dealt = dealt.unionByName(side)

    def join(group):
        import pyarrow as pa
        second = group.column("second").to_numpy()
        fps = group.column("fp").to_numpy().view(np.uint64)
        x, y = np.sort(fps[~second]), np.sort(fps[second])
        a, b = stars(x, y if len(y) else x, not len(y), budget)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.groupBy("unit").applyInArrow(join, "a long, b long")


def simhash_groups(docs: DataFrame, size: int = 3, budget: int = 2, leaf: int = 4096) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable, its own included) of every row.

    Rows are linked whose fingerprints differ in at most ``budget`` bits.
    """
    found = fingerprints(docs, size)
    classes = table(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-classes")
    roots = components(table(linked(classes.select("fp"), budget, leaf), "trie-links"))
    rooted = (classes.join(roots.select(F.col("v").alias("fp"), "root"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    # Written, so that Spark can split a fingerprint of many rows in the last join.
    groups = table(rooted.join(least, "root").select("fp", "component_id"), "fingerprint-groups")
    return (found.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
