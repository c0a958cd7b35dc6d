import random

import numpy as np
import pytest

from tidewatch.llm import hamming


def brute(rows, k):
    codes = sorted({(i, tuple((e or 0) > 0 for e in v)) for i, v in rows if i is not None and v})
    width = max((len(c) for _, c in codes), default=0)
    codes = [(i, c + (False,) * (width - len(c))) for i, c in codes]
    out = []
    for i, c in codes:
        if i % 100 == 0:
            near = sorted({(sum(x != y for x, y in zip(c, d, strict=True)), j) for j, d in codes if j != i})
            out += [(i, r + 1, j, n) for r, (n, j) in enumerate(near[:k])]
    return sorted(out)


@pytest.mark.parametrize("dims,n,shard", [(64, 500, 100), (20, 400, 8192), (100, 300, 50), (64, 3, 10)])
def test_equal_to_brute_force(spark, monkeypatch, dims, n, shard):
    monkeypatch.setattr(hamming, "SHARD_CODES", shard)
    rng = np.random.default_rng(dims)
    rows = [(i * 7 % 1000 if n > 3 else i * 100, rng.normal(0, 1, dims).tolist()) for i in range(n)]
    rows += [(5000 + i, rows[0][1]) for i in range(120)] + [(6000, rows[0][1])] * 2  # a hot vector
    rows += [(7000, None), (7100, []), (None, rows[1][1]), (7200, [None, *rows[1][1][1:]]), (7300, rows[2][1][:9])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS code", "2 AS near", "3 AS id", "4 AS query")
    got = hamming.nearest(df, df.where("vec_id % 100 = 0")).collect()
    assert sorted((r.query_id, r["rank"], r.neighbor_id, r.distance) for r in got) == brute(rows, 10)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    one = spark.createDataFrame([(0, [1.0, -1.0])], "vec_id long, embedding array<float>")
    assert hamming.nearest(none, none).count() == 0
    assert hamming.nearest(one, one).count() == 0
    assert hamming.nearest(one, none).count() == 0


def test_search_stops_only_when_covered():
    rng = random.Random(1)
    codes = np.unique(np.frombuffer(rng.randbytes(8 * 700), np.uint8).reshape(-1, 8), axis=0)
    index = hamming.Index(codes, [np.array([i]) for i in range(len(codes))])
    for _ in range(30):
        q = np.frombuffer(rng.randbytes(8), np.uint8)
        far = np.unpackbits(codes ^ q, axis=1).sum(axis=1)
        assert index.search(q, 11) == sorted((int(d), i) for i, d in enumerate(far))[:11]
