import hashlib
import math
import random

import numpy as np
import pytest

from llm_fixtures import sorted_rows
from rivalry.llm.centroids import (assign, cluster_vectors, first_centroids, loosening, means, reassign, squared,
                                   tightened, whole_vectors)
from rivalry.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows, extra=False):
    if extra:
        return spark.createDataFrame([(i, v, 1, "?", "?", "?") for i, v in rows],
                                     f"{SCHEMA}, cluster string, distance string, v string")
    return spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)


def vectors(n, dim, seed, centres=6, spread=0.2):
    r = random.Random(seed)
    middle = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(centres)]
    return [(i, [x + r.gauss(0, spread) for x in r.choice(middle)]) for i in range(n)]


def brute(rows, k, rounds, dim, scale=256, seed=2):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(float(np.float32(x)) * scale) for x in v]))
    order = sorted(kept, key=lambda t: (hashlib.sha256(f"{seed}:{'' if t[0] is None else t[0]}".encode()).hexdigest(), t[1]))
    cs = [list(v) for _, v in order[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for j in range(len(cs)):
            mine = [v for (_, v), c in zip(kept, own) if c == j]
            if mine:
                cs[j] = [sum(x) // len(mine) for x in zip(*mine)]
    last = [nearest(v) for _, v in kept]
    inertia = [sum(d for d, c in last if c == j) for j in range(len(cs))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted([(i, c, d, inertia[c], sum(inertia), sha[c]) for (i, _), (d, c) in zip(kept, last)], key=repr)


COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
AWKWARD = [(900, None), (901, []), (902, [0.5] * 7), (903, [0.5] * 9), (904, [None] + [0.5] * 7),
           (905, [float("nan")] + [0.5] * 7), (906, [float("inf")] + [0.5] * 7), (907, [float("-inf")] * 8),
           (None, [0.25] * 8), (None, [0.125] * 8), (908, [0.0] * 8), (908, [0.0] * 8), (909, [-0.001] * 8)]


@pytest.mark.parametrize("extra", [False, True])
def test_against_brute_force(spark, extra):
    rows = vectors(300, 8, 1) + AWKWARD
    got = cluster_vectors(frame(spark, rows, extra), k=9, rounds=5, dim=8)
    assert sorted_rows(got, *COLUMNS) == brute(rows, 9, 5, 8)


def test_ties_go_to_the_smaller_number(spark):
    rows = [(i, [float(i % 4), float(i // 4 % 4)]) for i in range(64)]
    got = cluster_vectors(frame(spark, rows), k=7, rounds=4, dim=2, scale=2)
    assert sorted_rows(got, *COLUMNS) == brute(rows, 7, 4, 2, scale=2)


def test_few_and_no_vectors(spark):
    rows = vectors(3, 4, 2)
    assert sorted_rows(cluster_vectors(frame(spark, rows), k=5, dim=4), *COLUMNS) == brute(rows, 5, 5, 4)
    assert sorted_rows(cluster_vectors(frame(spark, rows), k=1, dim=4), *COLUMNS) == brute(rows, 1, 5, 4)
    for empty in ([], AWKWARD[:8]):
        got = cluster_vectors(frame(spark, empty), dim=8)
        assert got.count() == 0 and got.columns[:6] == list(COLUMNS)


def test_components_too_large_are_an_error(spark):
    with pytest.raises(Exception, match="can't be clustered exactly"):
        cluster_vectors(frame(spark, [(1, [1e9, 0.0])]), dim=2).collect()


def test_large_components_are_exact(spark):
    rows = [(i, [x * 1e5 for x in v]) for i, v in vectors(60, 3, 5)]
    assert sorted_rows(cluster_vectors(frame(spark, rows), k=4, dim=3), *COLUMNS) == brute(rows, 4, 5, 3)


def test_tightened_drift_bounds_every_point_of_the_sphere():
    r = np.random.default_rng(3)
    for dim in (2, 3, 20):
        for _ in range(60):
            old = r.normal(0, 10, (5, dim))
            new = old + r.normal(0, r.choice([0.01, 1, 10]), (5, dim))
            new[4] = old[4]
            radius = np.abs(r.normal(0, r.choice([0.1, 3, 20]), 5))
            most = tightened(old, new, radius)
            full = np.sqrt(((new - old) ** 2).sum(1))
            assert (most <= full + 1e-6).all()
            for i in range(5):
                x = r.normal(size=(400, dim))
                x = old[i] + radius[i] * x / np.sqrt((x ** 2).sum(1))[:, None] * r.uniform(0, 1, (400, 1)) ** 0.2
                nearer = (np.sqrt(((x[:, None] - old) ** 2).sum(2)) - np.sqrt(((x[:, None] - new) ** 2).sum(2)))
                assert (nearer.max(axis=0) <= most[i] + 1e-9).all()


def test_bounds_spare_scans_and_more_of_them_than_full_drift(spark):
    rows = vectors(3000, 16, 4, centres=12, spread=0.4)
    whole = table(whole_vectors(frame(spark, rows), 16, 256), "whole")
    centroids = first_centroids(whole, 12, 2)

    def full(old, new, radius):
        return np.broadcast_to(np.sqrt(((new - old).astype(float) ** 2).sum(1)), (len(old), len(old))).copy()

    count = {}
    for name, bound in (("tight", tightened), ("full", full)):
        c, state, n = centroids, table(assign(whole, centroids), "state"), 0
        for _ in range(5):
            moved, radius = means(state, c)
            state = table(reassign(state, moved, loosening(c, moved, radius, bound)), "state")
            c = moved
            n += state.where("scanned").count()
        count[name] = n
        # Whatever the bounds spare, the assignment is that of a full scan.
        assert sorted_rows(state, "vec_id", "cluster", "distance") == sorted_rows(assign(whole, c), "vec_id", "cluster", "distance")
    assert count["tight"] < count["full"] < 5 * len(rows)


def test_squared_distances_in_doubles_and_whole_numbers():
    r = np.random.default_rng(1)
    x, c = r.integers(-1 << 22, 1 << 22, (50, 64)), r.integers(-1 << 22, 1 << 22, (7, 64))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(u, v)) for v in c] for u in x]
    assert squared(x, c).tolist() == want
    assert squared(x * 32, c * 32).tolist() == [[d * 1024 for d in row] for row in want]
