import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from llm_fixtures import awkward, frame, lower, sorted_rows
from rivalry.llm.importance import Payloads, Shift, feature_hashes, importance_sample

WORDS = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
COLUMNS = ("doc_id", "n_features", "weight", "score", "rank")


def features(text):
    w = WORDS.findall(lower(text))
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def crc(text):
    return zlib.crc32(text.encode())


def brute(docs, target, buckets=10_000, percent=25, least_words=20, seed=7):
    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for f in features(text)[1]:
            s[crc(f) % buckets] += 1
    for text in target:
        for f in features(text)[1]:
            t[crc(f) % buckets] += 1
    total_s, total_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((y + 1) * (total_s + buckets) / ((x + 1) * (total_t + buckets)))) for x, y in zip(s, t)]
    rows = []
    for d, text in docs:
        w, f = features(text)
        weight = sum(gain[crc(x) % buckets] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((d, len(w), len(f), weight, score))
    rows.sort(key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = [r for r in rows if r[1] >= least_words]
    out = [(r[0], r[2], r[3], r[4], k + 1 if k < percent * len(drawn) // 100 else None) for k, r in enumerate(drawn)]
    return sorted(out + [(r[0], r[2], r[3], r[4], None) for r in rows if r[1] < least_words], key=repr)


def target_frame(spark, texts, clash=False):
    if clash:
        return spark.createDataFrame([(str(i), t, 1, "?") for i, t in enumerate(texts)],
                                     "item_id string, text string, n_words int, rank string")
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "item_id string, text string")


TARGET = ["a b c, shared line of the pages", None, "", "one two words", "Ünï çödé 中文 x", "y" * 3000]


@pytest.mark.parametrize("words, clash", [(50_000, False), (12, True), (0, False)])
def test_against_brute_force(spark, words, clash):
    """Whatever the dictionary holds."""
    docs = awkward() + [(60 + k, "z" * 500 + f" a.b,c  d{k} " * (k + 3)) for k in range(20)]
    got = importance_sample(frame(spark, docs, clash), target_frame(spark, TARGET, clash), words=words)
    assert sorted_rows(got, *COLUMNS) == brute(docs, TARGET)


def test_more_partitions_than_rows_and_many_ties(spark):
    """Rows of one id have equal scores; every rank comes once."""
    docs = [(7, "same words " * 15)] * 60 + [(k, "same words " * 15) for k in range(40)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = importance_sample(frame(spark, docs).repartition(9), target_frame(spark, TARGET), percent=60)
        assert sorted_rows(got, *COLUMNS) == brute(docs, TARGET, percent=60)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_empty_tables(spark):
    assert importance_sample(frame(spark, []), target_frame(spark, TARGET)).count() == 0
    docs = awkward()
    assert sorted_rows(importance_sample(frame(spark, docs), target_frame(spark, [])), *COLUMNS) == brute(docs, [])


def test_payloads_by_scan_equal_those_of_the_words():
    r = random.Random(2)
    vocabulary = ["a", "ab", "b", "abc", "é", "中文", "b1", "x" * 64, "y" * 70, "z" * 1000, "\u0085", " q"]
    for known in ([], ["a"], ["a", "ab", "b", "é"], vocabulary[:8] + ["中文", "\u0085"]):
        payloads = Payloads(sorted(known))
        for _ in range(60):
            text = "".join(r.choice(vocabulary) + r.choice([" ", "  ", "-", "\n", ". ,", "\x00"]) for _ in range(r.randint(0, 12)))
            text = r.choice(["", " ", ",,"]) + text
            got, size = payloads.of(text.encode())
            want = WORDS.findall(lower(text))
            assert got.tolist() == [crc(w) for w in want] and size.tolist() == [len(w.encode()) for w in want]


def test_hashes_of_pairs_come_from_the_payloads():
    r = random.Random(4)
    words = ["".join(r.choice("abcé") for _ in range(r.choice([1, 2, 5, 30, 65, 66, 67, 400]))) for _ in range(80)]
    words.append("q" * 70_000)
    sizes = np.array([len(w.encode()) for w in words], np.int64)
    got = feature_hashes(np.array([crc(w) for w in words], np.uint32), sizes, Shift())
    assert got.tolist() == [crc(w) for w in words] + [crc(f"{a} {b}") for a, b in zip(words, words[1:])]
    assert feature_hashes(np.zeros(0, np.uint32), np.zeros(0, np.int64), Shift()).tolist() == []
