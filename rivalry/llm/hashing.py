"""64-bit hashes of words and word sequences, a text at a time, and bounded bitmaps of hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

P1, P2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


class WordHashes(dict):
    """Words (bytes) to 64-bit hashes; at most ``limit`` words are held, then the table is filled anew."""

    def __init__(self, limit: int = 1_000_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= self.limit:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(P1)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(P2)
    return x ^ (x >> np.uint64(32))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words: a polynomial of the words' hashes, which are well mixed themselves."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = words[:n]
    for k in range(1, size):
        h = h * np.uint64(P1) + words[k:k + n]
    return h


def bitmap_size(n: int, per_hash: int = 32, least: int = 1 << 16, most: int = 1 << 28) -> int:
    """Bits for ``n`` hashes: a power of two, at most ``most`` (32 MB); beyond it more hashes pass by chance."""
    return min(most, max(least, 1 << (max(1, n * per_hash) - 1).bit_length()))


def bitmap(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bitmap with bit (hash mod ``bits``) set for every hash: set bits are combined in Spark, so the driver
    gets at most ``bits / 64`` rows."""
    at = F.pmod(F.col(column), F.lit(bits))
    words = (hashes.select(F.shiftright(at, 6).alias("w"), bit_of(F.col(column), bits).alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b"))).toArrow()
    out = np.zeros(bits // 64, dtype=np.int64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return out.view(np.uint8)


def bit_of(h: Column, bits: int) -> Column:
    """One bit of a 64-bit word: 1 << (h mod bits mod 64)."""
    powers = F.array(*[F.lit(1 << i) for i in range(63)], F.lit(-(1 << 63)).cast("long")).cast("array<long>")
    return F.get(powers, F.pmod(h, F.lit(64)).cast("int"))


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(8 * len(bits) - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
