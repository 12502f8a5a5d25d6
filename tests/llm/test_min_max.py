import itertools
import random

import numpy as np
import pytest

from llm_fixtures import awkward, frame, sorted_rows, words
from rivalry.llm.components import components
from rivalry.llm.min_max import MinMax, missing_pairs, near_duplicates, one_of_each, sketch
from rivalry.llm.common import table


def shingle_sets(docs, size):
    out = []
    for _, text in docs:
        w = words(text)
        out.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    return out


def groups(sets):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= 80 * len(a | b):
            parent[find(j)] = find(i)
    return [find(i) for i in range(len(sets))]


def brute(docs, size):
    sets = shingle_sets(docs, size)
    root = groups(sets)
    least = {}
    for (doc_id, _), r in zip(docs, root):
        if doc_id is not None:
            least[r] = min(doc_id, least.get(r, doc_id))
    return sorted([(d, len(s), least.get(r) if s else d, d is not None and (not s or d == least.get(r)))
                   for (d, _), s, r in zip(docs, sets, root)], key=repr)


def family(n, seed, heavy):
    """Copies of one text, each with some words changed: light, heavy, and copies of the heavy ones."""
    r = random.Random(seed)
    base = ["b%d" % r.randrange(500) for _ in range(120)]
    out = []
    for i in range(n):
        c = list(base)
        for _ in range(r.randint(0, heavy)):
            c[r.randrange(len(c))] = "e%d" % r.randrange(10**6)
        out.append(c)
        if i % 5 == 0:
            d = list(c)
            d[r.randrange(len(d))] = "f%d" % r.randrange(10**6)
            out.append(d)
    return [" ".join(c) for c in out]


@pytest.mark.parametrize("size, clash", [(4, False), (5, True)])
def test_against_brute_force(spark, size, clash):
    docs = awkward() + [(1000 + i, t) for i, t in enumerate(family(80, 2, 9))]
    got = near_duplicates(frame(spark, docs, clash), size=size).select("doc_id", "n_shingles", "component_id", "kept")
    assert sorted_rows(got, *got.columns) == brute(docs, size)


def test_one_of_each_group_stays(spark):
    docs = awkward() + [(1000 + i, t) for i, t in enumerate(family(30, 4, 6))]
    sets = shingle_sets(docs, 4)
    root = groups(sets)
    kept = one_of_each(frame(spark, docs), size=4)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    n_groups = len({r for r, s in zip(root, sets) if s})
    rows = [tuple(x) for x in kept.select("doc_id", "text").collect()]
    left = shingle_sets(rows, 4)
    assert sum(bool(s) for s in left) == n_groups
    # Rows without words stay, once for each doc_id and text.
    assert sum(not s for s in left) == len({d for d, s in zip(docs, sets) if not s})
    assert len(set(groups([s for s in left if s]))) == n_groups


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).count() == 0
    assert one_of_each(frame(spark, [])).count() == 0


def test_signature_agreement_is_unbiased():
    hasher, r = MinMax(bands=200, rows=4), np.random.default_rng(3)
    a = r.integers(1 << 63, size=1000, dtype=np.uint64)
    b = np.concatenate([a[:800], r.integers(1 << 63, size=200, dtype=np.uint64)])
    agree = (hasher.signature(a) == hasher.signature(b)).mean()
    assert abs(agree - 800 / 1200) < 0.05


def test_sketches_never_differ_more_than_the_sets():
    r = np.random.default_rng(4)
    for n in (0, 1, 30, 400):
        both, a, b = (r.integers(1 << 63, size=k, dtype=np.uint64) for k in (300, n, n // 2))
        x, y = sketch(np.concatenate([both, a])), sketch(np.concatenate([both, b]))
        apart = int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
        assert apart <= n + n // 2 and (apart >= 0.6 * (n + n // 2) or n > 300)


def test_components(spark):
    r = random.Random(9)
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)] + [(r.randrange(2000, 2100), r.randrange(2000, 2100)) for _ in range(60)]
    got = {x.v: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    want = {x: find(x) for x in list(parent)}
    assert {x: got.get(x, x) for x in want} == want


def test_links_beside_the_representative_are_found(spark):
    """Two members that are similar to each other but not to the bucket's main component."""
    base = list(range(100))
    sets = {1: base, 2: base[:98] + [200], 3: base[:60] + list(range(300, 340)), 4: base[:60] + list(range(300, 338)) + [400]}
    frame_ = table(spark.createDataFrame([(k, sorted(v), sketch(np.array(v, np.uint64)).tolist()) for k, v in sets.items()],
                                         "cid long, shingles array<long>, sketch array<long>"), "sets")
    buckets = spark.createDataFrame([(7, k, 1) for k in sets], "b long, cid long, rep long")
    roots = spark.createDataFrame([(2, 1)], "v long, root long")
    assert [tuple(x) for x in missing_pairs(buckets, frame_, roots, 80).collect()] == [(3, 4)]
