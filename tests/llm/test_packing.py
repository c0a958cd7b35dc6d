from itertools import combinations

import numpy as np
import pytest

from tidewatch.llm import packing


def brute(lengths, counts, buckets):
    best = None
    for k in range(1, min(buckets, len(lengths)) + 1):
        for cut in combinations(range(len(lengths) - 1), k - 1):
            bounds = [lengths[i] for i in cut] + [lengths[-1]]
            cost = sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts, strict=True))
            best = cost if best is None else min(best, cost)
    return best


@pytest.mark.parametrize("seed", range(6))
def test_bounds_are_optimal(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.choice(60, 9, replace=False) + 1)
    counts = rng.integers(1, 30, 9)
    for buckets in (1, 2, 4, 9, 12):
        bounds = packing.optimal_bounds(lengths.astype(float), counts.astype(float), buckets)
        assert len(bounds) <= buckets and bounds[-1] == lengths[-1]
        cost = sum(c * (min(b for b in bounds if b >= x) - x) for x, c in zip(lengths, counts, strict=True))
        assert cost == brute(list(lengths), list(counts), buckets)


@pytest.mark.parametrize("seed", range(3))
def test_bounds_are_optimal_for_long_documents_too(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.choice(200_000, 120, replace=False) + 1)
    counts = rng.integers(1, 1000, 120)
    before, cost = np.concatenate([[0], np.cumsum(counts)]), {0: 0}
    total = np.concatenate([[0], np.cumsum(lengths * counts)])
    for _ in range(16):
        cost = {0: 0} | {j: min(c + int(lengths[j - 1]) * int(before[j] - before[i]) - int(total[j] - total[i])
                                for i, c in cost.items() if i < j) for j in range(1, 121)}
    bounds = np.array(packing.optimal_bounds(lengths, counts, 16))
    assert len(bounds) == 16 and set(bounds) <= set(lengths)
    assert int(((bounds[np.searchsorted(bounds, lengths)] - lengths) * counts).sum()) == cost[120]


def test_bounds_are_lengths_of_documents(spark, make_docs):
    sizes = [5, 700, 701, 2003, 2003, 9001]
    got = packing.pack(make_docs([(i, "w " * n, "en", "s") for i, n in enumerate(sizes)]), buckets=6).collect()
    assert all(r["pack"].padding == 0 and r["pack"].bound == sizes[r.doc_id] + 1 for r in got)


def test_batches_keep_the_budget_and_every_row(spark, make_docs, edge_rows):
    rows = edge_rows + [(100 + i, " ".join(["w"] * (i % 50)), "en", "s") for i in range(500)]
    got = packing.pack(make_docs(rows), token_budget=256).collect()
    assert len(got) == len(rows)
    batches = {}
    for r in got:
        p = r["pack"]
        assert p.n_tokens == len((r.text or "").split()) + 1 or r.doc_id == 10
        assert p.padding == p.bound - p.n_tokens >= 0
        batches.setdefault((p.bucket, p.batch), []).append(p)
    for ps in batches.values():
        assert sorted(p.slot for p in ps) == list(range(len(ps)))
        assert len(ps) == 1 or sum(p.bound for p in ps) <= 256
    for b in {k[0] for k in batches}:  # only a bucket's last batch is short
        sizes = [len(batches[(b, i)]) for i in range(len([k for k in batches if k[0] == b]))]
        assert len(set(sizes[:-1])) <= 1
    assert packing.pack(make_docs([])).count() == 0
