"""Directly addressable codes: token files with random access to any id.

An id is split into 8-bit chunks, least significant first.  Level k holds the
k-th chunk of every id that has one, a bitmap that says which of them go on to
level k + 1, and a rank directory (set bits before each block of 512).  The
position of an id's next chunk is the rank of its bit, so any id, or any run of
ids, is found with a few reads and without decoding what stands before it.

File layout (little-endian): magic, version, number of levels, documents and
ids; per level the number of chunks and the offsets of its three arrays; then
the documents' ids, a null flag for each, and the starts of the documents.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"DACT"
VERSION = 1
BLOCK = 512
HEAD, LEVEL = "<4sHHQQ", "<QQQQ"


def split(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bitmap, ranks) of each level."""
    levels, rest = [], ids.astype(np.uint32)
    while len(rest) or not levels:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (BLOCK // 8)))
        per_block = np.bitwise_count(bits).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint64)
        ranks = np.concatenate([np.zeros(1, np.uint64), np.cumsum(per_block, dtype=np.uint64)]).astype("<u8")
        levels.append(((rest & 255).astype(np.uint8), bits, ranks))
        rest = rest[more] >> 8
    return levels


def encode(doc_ids: list[int | None], docs: list[bytes]) -> bytes:
    """One file of the documents' ids (each given as little-endian unsigned 32-bit integers)."""
    ids = np.frombuffer(b"".join(docs), dtype="<u4")
    levels = split(ids)
    starts = np.concatenate([np.zeros(1, np.uint64), np.cumsum([len(d) // 4 for d in docs], dtype=np.uint64)])
    at = struct.calcsize(HEAD) + struct.calcsize(LEVEL) * len(levels)
    table, body = [], []
    for chunks, bits, ranks in levels:
        offsets = []
        for part in (chunks, bits, ranks):
            raw = part.tobytes()
            offsets.append(at)
            at += len(raw)
            body.append(raw)
        table.append(struct.pack(LEVEL, len(chunks), *offsets))
    body += [np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
             np.array([d is None for d in doc_ids], np.uint8).tobytes(), starts.astype("<u8").tobytes()]
    return b"".join([struct.pack(HEAD, MAGIC, VERSION, len(levels), len(docs), len(ids)), *table, *body])


class Reader:
    """Random access to a file opened for reading (``seek``, ``read``)."""

    def __init__(self, file):
        self.file = file
        magic, version, n_levels, self.n_docs, self.n_ids = struct.unpack(HEAD, self._read(0, struct.calcsize(HEAD)))
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token file of this version")
        self.levels = [struct.unpack(LEVEL, self._read(struct.calcsize(HEAD) + i * struct.calcsize(LEVEL), struct.calcsize(LEVEL))) for i in range(n_levels)]
        n, _, _, ranks = self.levels[-1]
        self.index = ranks + 8 * (self._blocks(n) + 1)

    @staticmethod
    def _blocks(n: int) -> int:
        return -(-n // BLOCK)

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        raw = self.file.read(n)
        if len(raw) != n:
            raise ValueError("token file is cut short")
        return raw

    def docs(self) -> tuple[list[int | None], np.ndarray]:
        """The documents' ids and their n + 1 starts."""
        n = self.n_docs
        ids = np.frombuffer(self._read(self.index, 8 * n), "<i8").tolist()
        null = self._read(self.index + 8 * n, n)
        starts = np.frombuffer(self._read(self.index + 9 * n, 8 * (n + 1)), "<u8").astype(np.int64)
        return [None if x else i for i, x in zip(ids, null)], starts

    def _rank(self, level: int, at: int) -> int:
        """Set bits of the level's bitmap before ``at``."""
        _, _, bits, ranks = self.levels[level]
        block, inside = divmod(at, BLOCK)
        before = int.from_bytes(self._read(ranks + 8 * block, 8), "little")
        if not inside:
            return before
        word = int.from_bytes(self._read(bits + block * BLOCK // 8, (inside + 7) // 8), "little")
        return before + (word & ((1 << inside) - 1)).bit_count()

    def ids(self, start: int, stop: int, level: int = 0) -> np.ndarray:
        """The ids from ``start`` up to ``stop``: at each level one run of chunks, found by rank."""
        _, chunks, bits, _ = self.levels[level]
        if stop <= start:
            return np.zeros(0, np.uint32)
        out = np.frombuffer(self._read(chunks + start, stop - start), np.uint8).astype(np.uint32)
        first = start // 8
        raw = np.frombuffer(self._read(bits + first, (stop + 7) // 8 - first), np.uint8)
        more = np.unpackbits(raw, bitorder="little")[start - 8 * first:stop - 8 * first].astype(bool)
        n_more = int(np.count_nonzero(more))
        if n_more:
            at = self._rank(level, start)
            out[more] |= self.ids(at, at + n_more, level + 1) << 8
        return out
