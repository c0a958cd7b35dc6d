import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k=8, rounds=10):
    """[(id, ints)] by plain Lloyd rounds in Python integers."""
    pts = [(i, [min(max(math.floor(1024 * x), -2**26), 2**26) for x in e]) for i, e in rows
           if e is not None and len(e) == 64 and all(x is not None and math.isfinite(x) for x in e)]
    key = lambda p: (p[0] is None, hashlib.sha256(f"3:{p[0]}".encode()).hexdigest() if p[0] is not None else "", np.array(p[1], np.int32).tobytes())
    cents = [list(p[1]) for p in sorted(pts, key=key)[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min(range(len(cents)), key=lambda j: (dist(v, cents[j]), j))
    for _ in range(rounds):
        groups = {}
        for _, v in pts:
            groups.setdefault(near(v), []).append(v)
        cents = [[sum(col) // len(groups[j]) for col in zip(*groups[j])] if j in groups else cents[j] for j in range(len(cents))]
    found = [(i, near(v), dist(v, cents[near(v)])) for i, v in pts]
    per = {}
    for _, j, d in found:
        per[j] = per.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted([(i, j, d, per[j], sum(per.values()), sha[j]) for i, j, d in found], key=str)


def run(df):
    rows = centroids.with_inertia(*centroids.clusters(df)).collect()
    return sorted([tuple(r) for r in rows], key=str)


def test_equal_to_brute_force(spark):
    rng = np.random.default_rng(2)
    mids = rng.normal(0, 0.3, (9, 64))
    rows = [(i, list(map(float, mids[i % 9] * (i % 9 != 4) + rng.normal(0, 0.05 + 0.1 * (i % 3), 64)))) for i in range(700)]
    assert run(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)) == brute(rows)


def test_edge_rows(spark):
    rng = np.random.default_rng(3)
    v = [list(map(float, rng.normal(0, 0.2, 64))) for _ in range(30)]
    rows = [(i, x) for i, x in enumerate(v)] + [(5, v[5])] * 3 + [(5, v[6]), (None, v[7]), (None, v[8])]       # repeated rows and ids, null ids
    rows += [(100, None), (101, []), (102, v[0][:63]), (103, v[0] + [0.0]), (104, [None] + v[0][1:]),
             (105, [float("nan")] + v[0][1:]), (106, [float("inf")] + v[0][1:]), (107, [1e30, -1e30] + v[0][2:])]
    rows += [(200 + i, v[3]) for i in range(60)]                                                                # many copies
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).withColumns(
        {c: F.lit("x") for c in ("v", "cluster", "upper", "lower", "before", "distance", "e", "d")})
    assert run(df) == brute(rows)
    few = rows[:3]
    assert run(spark.createDataFrame([(*r, 1) for r in few], SCHEMA)) == brute(few)
    assert run(spark.createDataFrame([], SCHEMA)) == []
    ties = [(i, [float(i % 2)] + [0.0] * 63) for i in range(40)] + [(90, [0.5] + [0.0] * 63)]                  # equal centroids, ties
    assert run(spark.createDataFrame([(*r, 1) for r in ties], SCHEMA)) == brute(ties)


def test_loosening_bounds_every_point_of_the_sphere_and_is_often_less_than_the_drift():
    rng = np.random.default_rng(4)
    tighter = 0
    for _ in range(300):
        old, move, centre = rng.normal(0, 100, 5), rng.normal(0, 20, 5), rng.normal(0, 100, 5)
        new, radius = old + move, abs(rng.normal(0, 60))
        bound = centroids.loosening(centre, radius, old, new)
        x = rng.normal(0, 1, (4000, 5))
        x = centre + x / np.linalg.norm(x, axis=1, keepdims=True) * radius * rng.random((4000, 1)) ** 0.1
        fall = np.linalg.norm(x - old, axis=1) - np.linalg.norm(x - new, axis=1)
        assert fall.max() <= bound <= np.linalg.norm(move) + 1e-9
        tighter += bound < 0.8 * np.linalg.norm(move)
    assert tighter > 50


def test_most_vectors_are_not_scanned_once_centroids_settle():
    rng = np.random.default_rng(5)
    mids = rng.normal(0, 300, (8, 64))
    v = (mids[rng.integers(0, 8, 5000)] + rng.normal(0, 20, (5000, 64))).astype(np.int32)
    c = mids.astype(np.int64)
    cluster, upper, lower, scanned = centroids.assign(v, np.full(5000, -1, np.int32), np.zeros(5000), np.zeros(5000), c)
    assert scanned == 5000
    moved = c + 1
    drift = np.sqrt(((moved - c) ** 2).sum(axis=1).astype(float))
    again = centroids.assign(v, cluster, upper + drift[cluster], lower - drift.max(), moved)
    assert again[3] == 0 and (again[0] == centroids.squared(v, moved).argmin(axis=1)).all()


@pytest.mark.parametrize("big", [1000, 1 << 26])
def test_squared_distances_are_exact(big):
    rng = np.random.default_rng(6)
    v, c = rng.integers(-big, big + 1, (50, 64)).astype(np.int32), rng.integers(-big, big + 1, (4, 64))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, y)) for y in c] for x in v]
    assert centroids.squared(v, c).tolist() == want
