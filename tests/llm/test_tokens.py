import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_fixtures import awkward, frame, sorted_rows
from rivalry.llm.packed_codes import Reader, encode
from rivalry.llm.packing import Packer, pack_documents
from rivalry.llm.token_files import read_token_files, write_token_files
from rivalry.llm.tokens import WordIds

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_words_give_the_ids_of_whole_texts(tokenizer):
    r = random.Random(3)
    parts = ["a", "É", "ß", "ñ", "İ", ".", ",", "12", "<|endoftext|>", "é", "Σ", "中", "'s", "\u0085", "\u00a0", "J̌", "😀", "…",
             "don't", "ﬁ", "\x1c", "ª", "ǅ", "ŉ", "The", "thing.", " ", "\n", "\t"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(3000)]
    words = WordIds(PATH, limit=500)
    for t in texts:
        assert np.frombuffer(words.text(t.encode()), "<u4").tolist() + [1] == ids_of(tokenizer, t), repr(t)


def test_codes_give_random_access():
    r = random.Random(1)
    docs = [[r.choice([r.randrange(256), r.randrange(1 << 16), r.randrange(1 << 32)]) for _ in range(r.randrange(900))] for _ in range(40)]
    raw = encode([None, *range(1, 40)], [np.array(d, "<u4").tobytes() for d in docs])
    reader = Reader(io.BytesIO(raw))
    ids, starts = reader.docs()
    every = sum(docs, [])
    assert ids == [None, *range(1, 40)] and np.diff(starts).tolist() == list(map(len, docs))
    assert reader.ids(0, len(every)).tolist() == every
    for _ in range(500):
        a = r.randrange(len(every))
        b = min(len(every), a + r.randrange(1200))
        assert reader.ids(a, b).tolist() == every[a:b]
    empty = Reader(io.BytesIO(encode([], [])))
    assert empty.docs()[0] == [] and empty.ids(0, 0).tolist() == []
    with pytest.raises(ValueError):
        Reader(io.BytesIO(b"x" * 100))


@pytest.mark.parametrize("clash", [False, True])
def test_files_round_trip(spark, tokenizer, clash):
    docs = awkward()
    manifest = write_token_files(frame(spark, docs, clash).repartition(4), PATH, max_ids=3000, shards=3)
    assert manifest.count() > 3
    got = read_token_files(spark, manifest).orderBy("start").collect()
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    want = [(d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in ((d, ids_of(tokenizer, t)) for d, t in docs)]
    assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], key=repr) == sorted(want, key=repr)


def test_no_documents(spark):
    assert read_token_files(spark, write_token_files(frame(spark, []), PATH)).count() == 0
    assert pack_documents(frame(spark, []), PATH).count() == 0


@pytest.mark.parametrize("clash", [False, True])
def test_packing(spark, tokenizer, clash):
    docs, size = awkward(), 64
    got = pack_documents(frame(spark, docs, clash), PATH, size=size, per_task=400).collect()
    want, rows = [], {}
    for d, t in docs:
        ids = ids_of(tokenizer, t)
        want += [(d, k, at, len(ids[at:at + size]), zlib.crc32(np.array(ids[at:at + size], "<u4").tobytes()))
                 for k, at in enumerate(range(0, len(ids), size))]
    assert sorted([tuple(r)[:5] for r in got], key=repr) == sorted(want, key=repr)
    for r in got:
        rows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in rows.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    least = -(-sum(w[3] for w in want) // size)
    assert len(rows) <= 1.1 * least + 1


def test_packer_keeps_few_open_and_closes_the_fullest():
    p = Packer(100, open_bins=2)
    assert p.place(60) == (0, 0) and p.place(70) == (1, 0)
    assert p.place(90) == (2, 0)       # none fits: sequence 1, the fullest, closes
    assert p.place(30) == (0, 60)      # the best of what is open
    assert p.place(10) == (0, 90)      # both 0 and 2 have 10 free: the last one with it
    assert p.n_open <= 2
