"""Best-fit packing into sequences of at most ``size`` tokens.

Bounded-space online best fit: a fixed number of open sequences, their free
space kept as a bitset (bit f: some open sequence has f tokens free).  A piece
goes to the open sequence that it fills most; where none fits, a sequence is
opened, and beyond the fixed number the fullest one closes first.  One packing
task takes about ``per_task`` pieces, so the tasks grow with the input and the
few sequences that each leaves part-filled stay a small share.

Null text: no ids but the end.  Repeated rows are all packed; an empty table
gives no pieces.  Other columns are ignored.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, functions as F

from rivalry.llm.common import docs_of, table
from rivalry.llm.tokens import WordIds, texts

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces_of(docs: DataFrame, tokenizer: str, size: int, end: int = 1) -> DataFrame:
    """Each document's ids and the end id, cut after every ``size`` ids."""
    def cut(batches):
        import pyarrow as pa
        words, tail = WordIds(tokenizer), int(end).to_bytes(4, "little")
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                code = words.text(text) + tail
                for k, at in enumerate(range(0, len(code), 4 * size)):
                    part = code[at:at + 4 * size]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                    (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs_of(docs).mapInArrow(cut, PIECES)


class Packer:
    """Bounded-space best fit; ``place`` gives (sequence, offset)."""

    def __init__(self, size: int, open_bins: int):
        self.size, self.open_bins = size, open_bins
        self.bits, self.by_free, self.n_open, self.n = 0, {}, 0, 0

    def place(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            sequence = self._take(free)
        else:
            if self.n_open == self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, sequence = self.size, self.n
            self.n += 1
        rest = free - length
        if rest:
            self.by_free.setdefault(rest, []).append(sequence)
            self.bits |= 1 << rest
            self.n_open += 1
        return sequence, self.size - free

    def _take(self, free: int) -> int:
        same = self.by_free[free]
        sequence = same.pop()
        if not same:
            del self.by_free[free]
            self.bits ^= 1 << free
        self.n_open -= 1
        return sequence


def pack(pieces: DataFrame, size: int, open_bins: int = 1024, per_task: int = 100_000) -> DataFrame:
    """``pieces`` (a written table with ``length``) with sequence_id and offset.

    Tasks read whole files and neighbouring ones, without a shuffle.
    """
    n = pieces.count()
    tasks = max(1, -(-n // per_task))

    def place(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        packer, first = Packer(size, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            # Long pieces of a batch first: they are the hardest to place.
            lengths = batch.column("length").to_pylist()
            found: list = [None] * len(lengths)
            for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
                found[i] = packer.place(lengths[i])
            out = batch.append_column("sequence_id", pa.array([first + s for s, _ in found], pa.int64()))
            yield out.append_column("offset", pa.array([o for _, o in found], pa.int64()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return pieces.coalesce(tasks).mapInArrow(place, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 4096, end: int = 1, open_bins: int = 1024,
                   per_task: int = 100_000) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    return pack(table(pieces_of(docs, tokenizer, size, end), "pieces"), size, open_bins, per_task)
