import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import mixing


def brute_targets(sizes, weights, cap=3):
    total, w = sum(sizes), [weights[i % len(weights)] for i in range(len(sizes))]
    fixed = {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        rest = total - sum(fixed.values())
        share = {i: rest * w[i] / sum(w[j] for j in free) for i in free}
        over = [i for i in free if share[i] > cap * sizes[i] + 1e-9]
        if not over:
            return [fixed.get(i, share.get(i, 0.0)) for i in range(len(sizes))]
        fixed |= {i: cap * sizes[i] for i in over}


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 1, 1, 5], [0, 7, 100], [1], [300, 2, 90, 4, 4000, 10]])
def test_targets_reshare_the_excess(sizes):
    got = mixing.source_targets(sizes)
    assert np.allclose(got, brute_targets(sizes, (1, 2, 3)))
    assert abs(sum(got) - sum(sizes)) < 1e-6 or all(abs(t - 3 * s) < 1e-9 for t, s in zip(got, sizes, strict=True))


def test_leaves_split_the_quotas_into_disjoint_runs():
    quotas = np.array([1000, 3, 0, 77, 512])
    leaves = [mixing.leaf(quotas, s, 13, seed=4) for s in range(13)]
    assert (sum(n for _, n in leaves) == quotas).all()
    at = np.zeros_like(quotas)
    for first, n in leaves:
        assert (first == at).all()
        at = at + n
    totals = [int(n.sum()) for _, n in leaves]
    assert max(totals) - min(totals) <= 4  # shards of equal size


@pytest.mark.parametrize("seed", range(8))
def test_fill_comes_nearest_to_the_rest(seed):
    rng = np.random.default_rng(seed)
    words = (rng.pareto(0.8, 12) * 40).astype(int) + rng.integers(0, 2, 12)  # a few blocks hold most words
    sums = (np.arange(1 << 12)[:, None] >> np.arange(12) & 1) @ words
    for rest in (0, 0.4, 1, *(words.sum() * rng.random(6)), words.max() - 1, words.sum()):
        got = mixing.nearest_fill(words, float(rest))
        assert len(set(got)) == len(got)
        assert np.isclose(abs(words[got].sum() - rest), abs(sums - rest).min())


def test_fill_of_large_sources_is_close():
    rng = np.random.default_rng(3)
    for words in (rng.integers(1, 1 << 24, 900), np.append(rng.integers(1, 1000, 500), 10**9), rng.integers(1, 9000, 3000)):
        rest = words.sum() * 0.37
        taken = words[mixing.nearest_fill(words, float(rest))].sum()
        best = min(abs(rest - words[words < words.max()].sum()), abs(rest - words.max())) if words.max() > 1e8 else 0
        assert abs(taken - rest) <= best + 0.002 * rest


def rows_of(mixed):
    return sorted(((r.doc_id is None, r.doc_id or 0, r.source or "", r.mix.size, tuple(map(tuple, r.mix.draws)))
                   for r in mixed.collect()))


def test_mix_meets_targets_and_reruns_agree(spark, make_docs, edge_rows):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 40)), "en", None if i % 9 == 0 else f"s{'abc'[i % 3]}") for i in range(600)]
    docs = make_docs(rows)
    mixed = mixing.mix(docs)
    first = rows_of(mixed)
    assert len(first) == len(rows)
    assert first == rows_of(mixing.mix(docs.repartition(5)))
    assert set(docs.columns) == set(mixed.columns)  # the column that clashed is replaced
    per = {}
    for r in mixed.collect():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", dict((x[0], x[1]) for x in rows)[r.doc_id]))
        assert r.mix.size == words and len(r.mix.draws) <= 3
        p = per.setdefault(r.source, [0, r.mix.source_size, r.mix.target, 0])
        p[0] += words * len(r.mix.draws)
        p[3] += words
    for taken, size, target, words in per.values():
        assert size == words and abs(taken - target) <= 40
    mixed_rows = mixing.mixture(docs)
    assert mixed_rows.columns == docs.columns
    assert mixed_rows.count() == sum(len(r[4]) for r in first)


def test_skewed_sources_meet_their_targets(spark, make_docs):
    """Sources of few documents, one of which holds most words: the best subset of documents is taken."""
    rng = np.random.default_rng(11)
    sizes = {f"s{k}": [int(x) + 1 for x in rng.pareto(0.7, 9) * 30] for k in range(6)}
    rows = [(10 * k + i, "w " * n, "en", s) for k, (s, ns) in enumerate(sizes.items()) for i, n in enumerate(ns)]
    per = {}
    for r in mixing.mix(make_docs(rows)).collect():
        p = per.setdefault(r.source, [0, r.mix.target])
        p[0] += r.mix.size * len(r.mix.draws)
    for s, (taken, target) in per.items():
        ns = np.array(sizes[s])
        sums = (np.arange(1 << 9)[:, None] >> np.arange(9) & 1) @ ns
        whole = int(target // ns.sum())
        assert np.isclose(abs(taken - target), abs(sums + whole * ns.sum() - target).min() if whole < 3 else 0), s


def test_a_map_column_passes(spark, make_docs, edge_rows):
    docs = make_docs(edge_rows).withColumn("meta", F.create_map(F.lit("k"), F.col("source")))
    assert mixing.mix(docs).count() == len(edge_rows)
    mixed = mixing.mixture(docs)
    assert mixed.schema == docs.schema and mixed.count() > 0


def test_edge_rows_and_empty_table(spark, make_docs, edge_rows):
    got = mixing.mix(make_docs(edge_rows)).collect()
    assert len(got) == len(edge_rows)
    assert all(r.mix.size == 0 for r in got if not (r.text or "").strip())
    same = {tuple(map(tuple, r.mix.draws)) for r in got if r.doc_id == 2}
    assert len(same) == 1
    assert mixing.mix(make_docs([])).count() == 0
