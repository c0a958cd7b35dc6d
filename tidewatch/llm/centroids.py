"""Exact centroid clustering with geometrically tightened drift bounds.

Every vector keeps, with its cluster, an upper bound of the distance to its centroid
and a lower bound of the distance to any other.  When centroids move, the upper bound
grows by its centroid's drift.  The lower bound falls by less than the largest drift:
all vectors of a cluster lie in a sphere about their centroid, so for each other
centroid that moves from c to c' it can fall by no more than the largest value, over
that sphere, of |x - c| - |x - c'|.  The points where this difference is at least 2a
form the convex inside of a branch of a hyperbola with the foci c and c'; in the plane
of the foci and the sphere's centre any tangent that parts it from the circle proves
2a to be a bound (``loosening``).  Vectors whose bounds leave the nearest centroid in
doubt are scanned exactly, in integers.

The vectors stay where they are: a round is one pass over a written table that holds
vectors and bounds, followed by one sum of what changed cluster.  Only the centroids
(clusters x components) pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm._shared import dropped, written

SIZE, CLUSTERS, ROUNDS, SCALE = 64, 8, 10, 1024
LIMIT = 1 << 26    # components are held to +-2**26, so that squared distances fit a long
EXACT = 1 << 22    # up to here products of components are exact in doubles
ANGLES = 64        # tangents tried for a bound
SLACK = 1e-9       # relative; covers the rounding of bounds

STATE = "vec_id long, v binary, cluster int, before int, upper double, lower double"


def loosening(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> float:
    """The most by which the distance of a point in the sphere to a centroid falls when it moves.

    In the plane of both foci and the sphere's centre, with the origin half-way between
    the foci and the centre at (t, s), s >= 0: a line of normal (cos w, -sin w) parts
    the circle from the branch |x - old| - |x - new| = 2a where
    a**2 >= (t cos w - s sin w + radius)**2 + (drift / 2)**2 sin(w)**2, the first term
    being zero if its base is negative.  Every w gives a valid bound, the drift is one too.
    """
    move = (new - old).astype(np.float64)
    drift = float(np.sqrt(move @ move))
    if drift == 0.0:
        return 0.0
    to = centre.astype(np.float64) - (old.astype(np.float64) + move / 2)
    t = float(to @ move) / drift
    s = float(np.sqrt(max(0.0, float(to @ to) - t * t)))
    w = np.linspace(0, np.pi / 2, ANGLES)
    base = np.maximum(0.0, t * np.cos(w) - s * np.sin(w) + radius)
    best = 2 * np.sqrt(base ** 2 + (drift / 2 * np.sin(w)) ** 2).min()
    return min(drift, float(best) + SLACK * (1 + radius + drift + abs(t) + s))


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances (long) of the rows of ``v`` to the rows of ``c``."""
    if max(np.abs(v).max(initial=0), np.abs(c).max(initial=0)) <= EXACT // 2:
        a, b = v.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)).astype(np.int64)
    out = np.empty((len(v), len(c)), np.int64)
    for j, row in enumerate(c):
        gap = v.astype(np.int64) - row
        out[:, j] = (gap * gap).sum(axis=1)
    return out


def assign(v: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(cluster, upper, lower, vectors scanned): the nearest rows of ``c``, smaller numbers first."""
    cluster, upper, lower = cluster.copy(), upper.copy(), lower.copy()
    if len(c) > 1:  # half the way to the nearest other centroid bounds as well
        apart = squared(c, c).astype(np.float64)
        np.fill_diagonal(apart, np.inf)
        half = np.sqrt(apart.min(axis=1)) / 2
    else:
        half = np.full(len(c), np.inf)
    known = cluster >= 0
    safe = lambda at: upper[at] * (1 + SLACK) < np.maximum(lower[at], half[cluster[at]]) * (1 - SLACK)
    doubt = np.flatnonzero(known)
    doubt = doubt[~safe(doubt)]
    gap = v[doubt].astype(np.int64) - c[cluster[doubt]]
    upper[doubt] = np.sqrt((gap * gap).sum(axis=1).astype(np.float64))
    doubt = np.concatenate([doubt[~safe(doubt)], np.flatnonzero(~known)])
    if len(doubt):
        d = squared(v[doubt], c)
        cluster[doubt] = d.argmin(axis=1)
        d = np.sqrt(np.sort(d, axis=1).astype(np.float64))
        upper[doubt] = d[:, 0]
        lower[doubt] = d[:, 1] if d.shape[1] > 1 else np.inf
    return cluster, upper, lower, len(doubt)


def _vectors(column: pa.Array) -> np.ndarray:
    n, column = len(column), column.cast(pa.binary())
    if n == 0:
        return np.zeros((0, SIZE), np.int32)
    start = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
    return np.frombuffer(column.buffers()[2], np.int32, n * SIZE, int(start)).reshape(n, SIZE)


def _packed(v: np.ndarray) -> pa.Array:
    n = len(v)
    offsets = np.arange(0, (n + 1) * SIZE * 4, SIZE * 4, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(v, np.int32))])


def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, SIZE)
        v = np.clip(np.floor(SCALE * x), -LIMIT, LIMIT).astype(np.int32)
        n = len(v)
        yield pa.RecordBatch.from_arrays([batch.column(0), _packed(v), pa.array(np.full(n, -1, np.int32)), pa.array(np.full(n, -1, np.int32)),
                                          pa.array(np.zeros(n)), pa.array(np.zeros(n))], names=["vec_id", "v", "cluster", "before", "upper", "lower"])


def kept(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """State rows of the vectors with all components present and finite, as integers."""
    e = F.col(vector_col).cast("array<double>")
    whole = (F.size(e) == SIZE) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.coalesce(whole, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), e.alias("e")).mapInArrow(_integers, STATE)


def _round(c: np.ndarray, drift: np.ndarray, loosen: np.ndarray):
    """One pass: bounds moved with the centroids, then the vectors assigned."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _vectors(batch.column("v"))
            before = batch.column("cluster").to_numpy()
            upper, lower = batch.column("upper").to_numpy(), batch.column("lower").to_numpy()
            cluster, upper, lower, _ = assign(v, before, upper + drift[before], np.maximum(0.0, lower - loosen[before]), c)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(cluster.astype(np.int32)), pa.array(before),
                                              pa.array(upper), pa.array(lower)], names=["vec_id", "v", "cluster", "before", "upper", "lower"])
    return run


def _changes(clusters: int):
    """(cluster, place, total, radius): sums and counts (place SIZE) that joined a cluster less those that left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((clusters, SIZE + 1), np.int64)
        radius = np.zeros(clusters)
        for batch in batches:
            cluster, before, moved = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3)
            np.maximum.at(radius, cluster, batch.column(2).to_numpy())
            at = np.flatnonzero(cluster != before)
            if len(at):
                v = _vectors(moved.drop_null()).astype(np.int64)
                for k in range(clusters):
                    came, left = v[cluster[at] == k], v[before[at] == k]
                    total[k, :SIZE] += came.sum(axis=0) - left.sum(axis=0)
                    total[k, SIZE] += len(came) - len(left)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(clusters, dtype=np.int32), SIZE + 1)),
                                          pa.array(np.tile(np.arange(SIZE + 1, dtype=np.int32), clusters)),
                                          pa.array(total.ravel()), pa.array(np.repeat(radius, SIZE + 1))],
                                         names=["cluster", "place", "total", "radius"])
    return run


def _distances(c: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, cluster = _vectors(batch.column("v")), batch.column("cluster").to_numpy()
            gap = v.astype(np.int64) - c[cluster]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("cluster"), pa.array((gap * gap).sum(axis=1))],
                                             names=["vec_id", "cluster", "distance"])
    return run


def first_centroids(state: DataFrame, clusters: int) -> np.ndarray:
    """The vectors with the smallest sha256 of ``3:<id>``; repeated ids by their components, null ids last."""
    digest = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = state.select(digest.alias("d"), "v").orderBy(F.col("d").asc_nulls_last(), "v").limit(clusters).collect()
    return np.array([np.frombuffer(r["v"], np.int32) for r in rows], np.int64).reshape(-1, SIZE)


def clusters(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", number: int = CLUSTERS,
             rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every kept vector, final centroids).

    Vectors of another length, with null or non-finite components or null altogether
    are left out; components beyond +-2**26 after scaling count as that.  Repeated rows
    are vectors of their own; null ids are clustered and found a centroid last; with
    fewer vectors than clusters every vector founds one; no vectors, no rows.  Other
    columns are ignored.  Rounds end early once no centroid moves.
    """
    state = written(kept(vectors, id_col, vector_col), "vectors")
    c = first_centroids(state, number)
    k = len(c)
    total, count = np.zeros((k, SIZE), object), np.zeros(k, object)
    drift, loosen = np.zeros(k + 1), np.zeros(k + 1)  # the last entry serves vectors without a cluster
    for r in range(rounds + 1 if k else 0):
        last = state
        state = written(last.mapInArrow(_round(c, drift, loosen), STATE), "assigned")
        dropped(last)
        if r == rounds:
            break
        part = state.select("cluster", "before", "upper", F.when(F.col("cluster") != F.col("before"), F.col("v")).alias("v"))
        radius = np.zeros(k)
        for row in (part.mapInArrow(_changes(k), "cluster int, place int, total long, radius double")
                    .groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.max("radius").alias("radius")).collect()):  # one row a component
            j, place = row["cluster"], row["place"]
            radius[j] = row["radius"]
            if place == SIZE:
                count[j] += row["total"]
            else:
                total[j, place] += row["total"]
        old, c = c, np.array([[int(x // count[j]) for x in total[j]] if count[j] else list(c[j]) for j in range(k)], np.int64)
        if (old == c).all():
            break
        drift[:k] = np.sqrt(((c - old).astype(np.float64) ** 2).sum(axis=1)) * (1 + SLACK)
        for a in range(k):
            loosen[a] = max((loosening(old[a], radius[a] * (1 + SLACK), old[j], c[j]) for j in range(k) if j != a), default=0.0)
    out = written(state.mapInArrow(_distances(c), "vec_id long, cluster int, distance long"), "clusters")
    dropped(state)
    return out, c


def with_inertia(found: DataFrame, c: np.ndarray) -> DataFrame:
    """The clustering with (cluster_inertia, inertia, centroid_sha256) of each vector's cluster."""
    sums = dict(found.groupBy("cluster").agg(F.sum("distance")).collect())  # a row per cluster
    per = F.array(*[F.lit(int(sums.get(j, 0))).cast("long") for j in range(len(c))] or [F.lit(0).cast("long")])
    shas = F.array(*[F.lit(hashlib.sha256(",".join(str(int(x)) for x in row).encode()).hexdigest()) for row in c] or [F.lit("")])
    at = F.col("cluster") + 1
    return found.select("vec_id", "cluster", "distance", F.element_at(per, at).alias("cluster_inertia"),
                        F.lit(int(sum(sums.values()))).cast("long").alias("inertia"), F.element_at(shas, at).alias("centroid_sha256"))
