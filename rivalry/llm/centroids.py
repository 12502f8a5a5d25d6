"""Clustering around centroids (Lloyd's rounds) with geometrically tightened bounds.

Vectors are whole numbers, so distances and means are exact.  Besides its
cluster every vector carries a lower bound on its distance to all other
centroids.  When centroids move, a bound must loosen by how much nearer another
centroid can have come to any vector of the cluster.  The cluster lies within a
sphere around its old centroid; in the plane of that centre and the other
centroid's path, the sphere's nearer tangent says how much of the move can
count (``tightened``): at most the full move, mostly far less, and a centroid
that leaves raises the bound.  A vector that is still nearer to its centroid
than the bound, or than half the way to the next centroid, stays; all others
are scanned exactly.

A round is one pass over a written table and one sum of per-task partial sums;
the driver holds the centroids and the clusters' radii, never vectors.  No
vector is shuffled, so a cluster may hold any share of them.

Vectors that are null, of another length, or have null or non-finite
components are left out.  A null vec_id counts as the empty text in the choice
of the first centroids; ties there go by the components.  Repeated rows are
vectors of their own.  With fewer vectors than ``k`` each is a first centroid;
an empty table gives an empty result.  Components beyond 2 ** 27 after scaling
can't be summed exactly in 64 bits and raise an error.  Other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from rivalry.llm.common import table

MOST = 1 << 27  # components: 64 squares of twice as much stay within 64 bits
EXACT = 1 << 22  # components: as much for sums of products in doubles
STATE = "vec_id long, v array<int>, cluster int, distance long, lower double, scanned boolean"


def whole_vectors(vectors: DataFrame, dim: int, scale: float, vec_id: str = "vec_id",
                  column: str = "embedding") -> DataFrame:
    """vec_id, v (whole numbers) of the vectors that are complete."""
    v = F.col(column).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.where(F.coalesce((F.size(v) == dim) & finite, F.lit(False)))
    scaled = F.transform(v, lambda x: x * F.lit(float(scale)))
    fits = F.forall(scaled, lambda x: F.abs(x) <= MOST)
    whole = F.transform(scaled, lambda x: F.floor(x).cast("int"))
    return kept.select(F.col(vec_id).cast("long").alias("vec_id"),
                       F.when(fits, whole).otherwise(F.raise_error(F.lit(
                           f"components beyond {MOST} can't be clustered exactly"))).alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``seed:vec_id``."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(order.alias("o"), "v").orderBy("o", "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all centroids."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT:
        a, c = x.astype(float), centroids.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], axis=1)


def scanned(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cluster, squared distance, and distance to the second nearest centroid."""
    d = squared(x, centroids)
    rows = np.arange(len(x))
    cluster = d.argmin(axis=1)  # ties: the smaller number
    nearest = d[rows, cluster]
    if len(centroids) == 1:
        return cluster, nearest, np.full(len(x), np.inf)
    d[rows, cluster] = np.iinfo(np.int64).max
    return cluster, nearest, np.sqrt(d.min(axis=1).astype(float))


def tightened(old: np.ndarray, new: np.ndarray, radius: np.ndarray, parts: int = 16) -> np.ndarray:
    """For clusters i and centroids j: the most by which j's move can have come nearer to a point within ``radius[i]``
    of ``old[i]``; negative if it can only have moved away.

    On its way j comes nearer to a point at a rate of the cosine of the angle between its direction and the point.  That
    angle only grows on the way, and over a sphere it is at least the angle to the sphere's centre less the one under
    which the sphere is seen.  Its value at the start of each of ``parts`` steps bounds the step.
    """
    old, new = old.astype(float), new.astype(float)
    k, move = len(old), new - old
    length = np.sqrt((move ** 2).sum(1))
    way = move / np.maximum(length, 1e-300)[:, None]
    out = np.zeros((k, k))
    for step in range(parts):
        at = old + move * (step / parts)
        sight = old[:, None, :] - at[None, :, :]  # from centroid j on its way to the centre of sphere i
        far = np.sqrt((sight ** 2).sum(2))
        along = (sight * way[None, :, :]).sum(2) / np.maximum(far, 1e-300)
        centre = np.arccos(np.clip(along, -1, 1))
        seen = np.where(far > radius[:, None], np.arcsin(np.clip(radius[:, None] / np.maximum(far, 1e-300), 0, 1)), np.pi)
        out += np.cos(np.clip(centre - seen, 0, np.pi)) * (length / parts)[None, :]
    # Rounding errors of the angles.
    return np.minimum(out + 1e-6 * (length[None, :] + 1), length[None, :] + 1e-9)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray, bound=tightened) -> np.ndarray:
    """Of each cluster: by how much its vectors' lower bounds go down."""
    if len(old) == 1:
        return np.zeros(1)
    each = bound(old, new, radius)
    np.fill_diagonal(each, -np.inf)
    return each.max(axis=1)


def half_gaps(centroids: np.ndarray) -> np.ndarray:
    """Half the distance to the next centroid."""
    if len(centroids) == 1:
        return np.full(1, np.inf)
    d = squared(centroids, centroids).astype(float)
    np.fill_diagonal(d, np.inf)
    return np.sqrt(d.min(axis=1)) / 2


def rows_of(batch) -> np.ndarray:
    """The vectors of an Arrow batch as a matrix."""
    v = batch.column("v")
    n = len(v)
    return v.flatten().to_numpy().astype(np.int64).reshape(n, -1) if n else np.zeros((0, 1), np.int64)


def state_batch(batch, cluster, distance, lower, was_scanned):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays(
        [batch.column("vec_id"), batch.column("v"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64()),
         pa.array(lower, pa.float64()), pa.array(was_scanned, pa.bool_())],
        names=["vec_id", "v", "cluster", "distance", "lower", "scanned"])


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Every vector's cluster, distance and lower bound, by a full scan."""
    def scan(batches):
        for batch in batches:
            if batch.num_rows:
                yield state_batch(batch, *scanned(rows_of(batch), centroids), np.ones(batch.num_rows, bool))

    return vectors.mapInArrow(scan, STATE)


def reassign(state: DataFrame, centroids: np.ndarray, loosened: np.ndarray) -> DataFrame:
    """The same after the centroids have moved; ``scanned`` tells the vectors whose bounds did not hold."""
    gaps = half_gaps(centroids)

    def scan(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = rows_of(batch)
            cluster = batch.column("cluster").to_numpy().astype(np.int64)
            lower = batch.column("lower").to_numpy() - loosened[cluster]
            distance = ((x - centroids[cluster]) ** 2).sum(1)
            safe = np.maximum(lower, gaps[cluster]) * (1 - 1e-9) - 1e-6
            open_ = np.flatnonzero(~(np.sqrt(distance.astype(float)) < safe))
            if len(open_):
                cluster[open_], distance[open_], lower[open_] = scanned(x[open_], centroids)
            was_scanned = np.zeros(len(x), bool)
            was_scanned[open_] = True
            yield state_batch(batch, cluster, distance, lower, was_scanned)

    return state.mapInArrow(scan, STATE)


def means(state: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The floored means of all clusters (an empty one keeps its centroid), and their radii around ``centroids``."""
    k, dim = centroids.shape

    def add(batches):
        import pyarrow as pa
        sums, n, far = np.zeros((k, dim), np.int64), np.zeros(k, np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if batch.num_rows:
                x, cluster = rows_of(batch), batch.column("cluster").to_numpy()
                order = np.argsort(cluster, kind="stable")
                own, first = np.unique(cluster[order], return_index=True)
                sums[own] += np.add.reduceat(x[order], first, axis=0)
                n += np.bincount(cluster, minlength=k)
                np.maximum.at(far, cluster, batch.column("distance").to_numpy())
        own = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int32()), pa.array(n[own]), pa.array(far[own]), pa.array(list(sums[own]), pa.list_(pa.int64()))],
            names=["cluster", "n", "far", "sums"])

    parts = state.select("v", "cluster", "distance").mapInArrow(add, "cluster int, n long, far long, sums array<long>")
    rows = (parts.select("cluster", "n", "far", F.posexplode("sums").alias("place", "x")).groupBy("cluster", "place").agg(
        F.sum("n").alias("n"), F.max("far").alias("far"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))).collect()
    out, radius = centroids.copy(), np.zeros(k)
    for r in rows:
        out[r["cluster"], r["place"]] = int(r["x"]) // r["n"]
        radius[r["cluster"]] = np.sqrt(float(r["far"])) * (1 + 1e-12)
    return out, radius


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: float = 256, seed: int = 2,
                    vec_id: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance (squared, to the final centroid), cluster_inertia, inertia, centroid_sha256, and
    scanned (whether the last assignment needed a scan) of every complete vector.

    Each round assigns every vector to the nearest centroid and replaces the centroids by the floored means; then
    vectors are assigned once more.
    """
    whole = table(whole_vectors(vectors, dim, scale, vec_id, column), "whole-vectors")
    centroids = first_centroids(whole, k, seed)
    spark = vectors.sparkSession
    ends = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        state, rows = spark.createDataFrame([], STATE), []
    else:
        state = table(assign(whole, centroids), "cluster-state")
        for _ in range(rounds):
            moved, radius = means(state, centroids)
            state = table(reassign(state, moved, loosening(centroids, moved, radius)), "cluster-state")
            centroids = moved
        sums = state.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()
        total = sum(r["d"] for r in sums)
        rows = [(r["cluster"], r["d"], total, hashlib.sha256(
            ",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest()) for r in sums]
    # At most k rows.
    return (state.join(F.broadcast(spark.createDataFrame(rows, ends)), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "scanned"))
