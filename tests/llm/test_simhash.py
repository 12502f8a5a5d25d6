import itertools
import random

import numpy as np
import pytest
import xxhash

from llm_fixtures import awkward, frame, sorted_rows, words
from rivalry.llm.common import table
from rivalry.llm.simhash import descend, fingerprint, linked, simhash_groups, stars


def brute_print(text, size=3):
    w = words(text)
    runs = [" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))] if w else []
    h = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def roots(prints, budget=2):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(sorted(parent), 2):
        if (a ^ b).bit_count() <= budget:
            parent[find(b)] = find(a)
    return {p: find(p) for p in parent}


def brute(docs, size=3):
    prints = [brute_print(t, size) for _, t in docs]
    root, least = roots(set(prints)), {}
    for (d, _), p in zip(docs, prints):
        if d is not None:
            least[root[p]] = min(d, least.get(root[p], d))
    return sorted([(d, f"{p:016x}", least.get(root[p])) for (d, _), p in zip(docs, prints)], key=repr)


def dense(n, seed, centres=3, flips=5):
    """Distinct fingerprints around a few centres, and lone ones."""
    r = random.Random(seed)
    middle = [r.getrandbits(64) for _ in range(centres)] + [0, (1 << 64) - 1]
    out = {r.getrandbits(64) for _ in range(n // 3)} | set(middle)
    while len(out) < n:
        x = r.choice(middle)
        for _ in range(r.randint(0, flips)):
            x ^= 1 << r.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("clash", [False, True])
def test_against_brute_force(spark, clash):
    r = random.Random(8)
    base = [f"w{r.randrange(300)}" for _ in range(400)]
    docs = awkward()
    for k in range(40):
        c = list(base)
        for _ in range(r.randint(0, 6)):
            c[r.randrange(len(c))] = f"x{r.randrange(10**6)}"
        docs.append((1000 + k, " ".join(c)))
    got = simhash_groups(frame(spark, docs, clash))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    want = brute(docs)
    assert sorted_rows(got, *got.columns) == want
    assert any(c != d for d, _, c in want if d and d >= 1000)


def test_fingerprints_of_few_words():
    for text in ("", " \n", "one", "One two", "a b c", "x " * 100, "Ünï çödé x ſ"):
        assert fingerprint(text.encode(), 3) == brute_print(text)


@pytest.mark.parametrize("budget", [0, 1, 2, 4])
def test_walk_finds_every_pair_once(budget):
    x = np.array(dense(400, 1), np.uint64)
    found = [p for i, j in descend(x, x, True, budget, most=50) for p in zip(i.tolist(), j.tolist())]
    want = {(i, j) for i, j in itertools.combinations(range(len(x)), 2)
            if int(x[i] ^ x[j]).bit_count() <= budget}
    assert len(found) == len(set(found)) and set(found) == want
    y = np.array(dense(300, 2) + x[:20].tolist(), np.uint64)
    y.sort()
    found = [p for i, j in descend(x, y, False, budget) for p in zip(i.tolist(), j.tolist())]
    assert len(found) == len(set(found))
    assert set(found) == {(i, j) for i in range(len(x)) for j in range(len(y))
                          if int(x[i] ^ y[j]).bit_count() <= budget}


def test_a_unit_returns_one_row_per_linked_fingerprint():
    x = np.array(sorted({1 << k for k in range(64)} | {0}), np.uint64)
    a, b = stars(x, x, True, 2)
    assert len(a) == 64 and set(b.tolist()) == {0}


def test_dense_regions_are_cut_into_small_units(spark):
    prints = dense(900, 3)
    frame_ = table(spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints], "fp long"), "prints")
    edges = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in linked(frame_, 2, leaf=40).collect()]
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    want = roots(prints)
    assert {p: find(p) for p in prints} == {p: min(q for q in prints if want[q] == want[p]) for p in prints}


def test_empty_table(spark):
    assert simhash_groups(frame(spark, [])).count() == 0
