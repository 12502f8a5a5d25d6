"""Token ids of whole texts, a word at a time.

The tokenizer file must never join text across white space (its normaliser
turns white space into one space and its pre-tokeniser drops it), so a text's
ids are its words' ids in turn; each distinct word is encoded once per task.
A null text is empty.
"""

from __future__ import annotations

import numpy as np


def byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordIds(dict):
    """Words (bytes without white space) to their ids as little-endian unsigned 32-bit integers.

    At most ``limit`` words are held: a full table is emptied and filled anew.
    """

    def __init__(self, path: str, limit: int = 700_000):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer, self.limit, self.chars = Tokenizer.from_file(path), limit, byte_chars()
        self.encode_word = self.tokenizer.model.tokenize

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        self[word] = ids = self.look_up(word)
        return ids

    def look_up(self, word: bytes) -> bytes:
        stem = word.rstrip(b".,")
        if len(stem) < len(word) and stem and stem[-1:].isalpha():
            # Letters and the marks after them are always pieces of their own.
            return self[stem] + self[word[len(stem):]]
        text = word.decode()
        if text.isalpha() and max(text) < "ɐ" and "İ" not in text:
            # One piece in normal form: the vocabulary model alone gives its ids.
            lower = text.lower()
            if lower != text and lower.isascii():
                return self[lower.encode()]
            chars = self.chars
            piece = lower if lower.isascii() else "".join([chars[b] for b in lower.encode()])
            found = [t.id for t in self.encode_word(piece)]
        else:
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(found, dtype="<u4").tobytes()

    def text(self, text: bytes) -> bytes:
        """The ids of a whole text."""
        return b"".join(map(self.__getitem__, text.split()))


def texts(batch, column: str = "text") -> list[bytes]:
    """The texts of an Arrow batch as UTF-8 bytes."""
    import pyarrow as pa
    return batch.column(column).cast(pa.binary()).to_pylist()


class Words:
    """The words of a block of texts, A-Z lower-cased and parted at ASCII white space, as codes.

    ``codes`` holds every word's place in ``distinct`` (bytes), text after text; ``starts`` where each text begins, and
    the end of the last.  The ``end`` follows each text if it is given; it is the last of ``distinct`` then.
    """

    def __init__(self, found, end: bytes | None = None):
        import pyarrow as pa
        import pyarrow.compute as pc
        lists = pc.ascii_split_whitespace(pc.ascii_lower(found))
        flat = lists.flatten().dictionary_encode()
        self.array = flat.dictionary.cast(pa.binary())
        codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        empty = pc.index(flat.dictionary, "").as_py()
        if empty >= 0:  # beside white space at a text's ends
            owner = np.repeat(np.arange(len(sizes)), sizes)
            real = codes != empty
            sizes = np.bincount(owner[real], minlength=len(sizes))
            codes = codes[real]
        if end is not None:
            codes = np.insert(codes, np.cumsum(sizes), len(self.array)).astype(np.int32)
            self.array = pa.concat_arrays([self.array, pa.array([end], pa.binary())])
            sizes = sizes + 1
        self.codes = codes
        self.starts = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])

    @property
    def distinct(self) -> list[bytes]:
        return self.array.to_pylist()


def blocks(batch_columns, most: int = 24 << 20):
    """Rows of Arrow arrays (texts first) in their order, in blocks of at most ``most`` bytes of text, or of one row.

    ``batch_columns``: tuples of arrays.  A block ends where the bytes do, whatever the batches were.
    """
    import pyarrow as pa
    import pyarrow.compute as pc
    held: list[tuple] = []
    size = 0

    def out():
        return tuple(pa.concat_arrays(column) for column in zip(*held))

    for columns in batch_columns:
        sizes = pc.binary_length(columns[0]).to_numpy(zero_copy_only=False).astype(np.int64)
        at = 0
        while at < len(sizes):
            room = np.cumsum(sizes[at:]) + size
            n = int(np.searchsorted(room, most, side="right"))
            if n == 0 and not held:
                n = 1
            if n:
                held.append(tuple(c.slice(at, n) for c in columns))
                size = int(room[n - 1])
                at += n
            if at < len(sizes):
                yield out()
                held, size = [], 0
    if held:
        yield out()
