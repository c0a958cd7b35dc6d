import random
import re

import numpy as np

from llm_helpers import ascii_lower
from tidewatch.llm import minhash
from tidewatch.llm.components import components


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if not w:
        return frozenset()
    n = min(n, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def brute(rows, n, percent):
    """Least reachable id of each row position."""
    sets = [shingles(t, n) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(sets[i]), least.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows)]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def family(rng, start, base_len, copies, edits):
    base = [f"f{rng.randrange(5000)}" for _ in range(base_len)]
    out = [(start, " ".join(base), "en", "s")]
    for k in range(1, copies):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append((start + k, " ".join(w), "en", "s"))
    return out


def test_groups_equal_brute_force(spark, make_docs, edge_rows):
    rng = random.Random(11)
    rows = list(edge_rows)
    for f in range(6):
        rows += family(rng, 1000 * (f + 1), rng.choice([3, 20, 120]), 25, rng.choice([1, 6, 12]))
    rng.shuffle(rows)
    got = minhash.near_duplicates(make_docs(rows), shingle=2, percent=80).collect()
    assert order((r.doc_id, r.n_shingles, r.component_id) for r in got) == order(brute(rows, 2, 80))
    for r in got:
        if r.n_shingles and r.component_id is not None:
            assert r.kept == (r.doc_id == r.component_id)
        else:
            assert r.kept


def test_empty_table(spark, make_docs):
    assert minhash.near_duplicates(make_docs([])).count() == 0


def test_stage_keeps_one_of_each_group_and_all_columns(spark, make_docs):
    rng = random.Random(3)
    rows = family(rng, 10, 200, 6, 1) + [(1, None, "en", "s"), (2, "", "en", "s"), (None, "alone here", "en", "s")]
    docs = make_docs(rows)
    left = minhash.without_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [1, 2, 10]
    assert left.where("doc_id IS NULL").count() == 1


def test_estimate_is_corrected_for_chance(spark):
    rng = np.random.default_rng(1)
    for share in (0.0, 0.5, 0.8, 1.0):
        got = []
        for _ in range(40):
            pool = rng.integers(0, 2**63, 1000, dtype=np.uint64)
            both = int(600 * share)
            rest = (600 - both) // 2
            a, b = pool[:both + rest], np.concatenate([pool[:both], pool[700:700 + rest]])
            x, y = (minhash.pack(minhash.minima(s)).tolist() for s in (a, b))
            got.append((x, y, both / (both + 2 * rest)))
        df = spark.createDataFrame(got, "x array<long>, y array<long>, j double")
        mean = df.selectExpr("avg(j) AS j").first()["j"], df.select(minhash.estimate("x", "y").alias("e")).selectExpr("avg(e)").first()[0]
        assert abs(mean[0] - mean[1]) < 0.04


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(230)] + [(i, i + 1) for i in range(1000, 1060)] + [(None, 3), (4, 4)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i
    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {i: find(i) for i in root}
