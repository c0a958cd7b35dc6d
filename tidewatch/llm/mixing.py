"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source's documents fall by hash into blocks.  A source whose target is
``e`` and a fraction times its size contributes all its blocks ``e`` times and a
permuted part of them once more, so its target becomes an exact quota of block
draws.  A binary tree over the output shards splits the vector of quotas: at a
node the left half's share of every source is one multivariate-hypergeometric
draw.  A leaf knows how many draws of each source it holds and how many lie to
its left, which makes its draws a run of the source's permuted sequence,
disjoint from every other leaf's.  A leaf is found by walking down from the root
with one seeded generator per node, so shards are laid out independently, in
tasks.  One number per source passes through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm._shared import unboxed, word_count, written

BLOCKS = 1024          # blocks of a source, more where a block would exceed BLOCK_WORDS on average
BLOCK_WORDS = 1 << 24
SHARDS = 64            # output shards, more where a shard would exceed BLOCK_WORDS on average
MAX_EPOCHS = 3
FILL_BITS = 1 << 19    # sums told apart when the last blocks of a source are chosen
FILL_BLOCKS = 1024     # blocks chosen so: 64 MB of sums in the task
WEIGHTS = (1, 2, 3)


def source_targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS) -> list[float]:
    """Words wanted of each source (given in order): shares of the total by weight,
    none above ``max_epochs`` times its size, the excess reshared by weight."""
    w = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    caps = [float(max_epochs) * s for s in sizes]
    out, free, rest = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        unit = rest / sum(w[i] for i in sorted(free))
        full = [i for i in sorted(free) if w[i] * unit > caps[i]]
        if not full:
            for i in free:
                out[i] = w[i] * unit
            break
        for i in full:
            out[i] = caps[i]
            rest -= caps[i]
            free.discard(i)
    return out


def leaf(quotas: np.ndarray, shard: int, shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(first draw, number of draws) of every source in one shard."""
    lo, hi, have, before = 0, shards, quotas.copy(), np.zeros_like(quotas)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        left = rng.multivariate_hypergeometric(have, int(have.sum()) * (mid - lo) // (hi - lo), method="marginals")
        if shard < mid:
            hi, have = mid, left
        else:
            lo, have, before = mid, have - left, before + left
    return before, have


def _leaves(quotas: np.ndarray, keys: list[str], shards: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                first, n = leaf(quotas, int(shard), shards, seed)
                who = np.flatnonzero(n)
                if len(who):
                    yield pd.DataFrame({"key": [keys[i] for i in who], "lo": first[who], "hi": first[who] + n[who] - 1,
                                        "shard": int(shard)})
    return run


def nearest_fill(words: np.ndarray, rest: float) -> list[int]:
    """Indices of blocks, the earliest that do, whose words come nearest to ``rest`` (at a tie, the lower sum).

    Sums that can be reached are bits of one integer per block, in units of one word up to
    FILL_BITS / 2 words, beyond that of as many words as keep the sums within FILL_BITS.
    Of more than FILL_BLOCKS blocks the first ones are taken as they fit.
    """
    taken = []
    free = len(words) - FILL_BLOCKS
    for i in range(free):
        if words[i] <= rest:
            taken.append(i)
            rest -= words[i]
    unit = max(1, math.ceil(2 * rest / FILL_BITS))
    goal, limit = rest / unit, (1 << int(2 * rest / unit) + 1) - 1  # a sum beyond 2 * rest is worse than none
    at, reach = [i for i in range(max(0, free), len(words)) if words[i]], [1]
    scaled = [round(int(words[i]) / unit) for i in at]
    for w in scaled:
        reach.append(reach[-1] | reach[-1] << w & limit if w <= limit.bit_length() else reach[-1])
    below = (reach[-1] & (1 << int(goal) + 1) - 1).bit_length() - 1
    above = reach[-1] >> int(goal) + 1
    total = below
    if above:
        up = int(goal) + 1 + (above & -above).bit_length() - 1
        total = up if up - goal < goal - below else below
    for k in range(len(at), 0, -1):  # the earliest blocks: a later one only where the sum needs it
        if not reach[k - 1] >> total & 1:
            taken.append(at[k - 1])
            total -= scaled[k - 1]
    return sorted(taken)


def _draw(seed: int):
    """The draws of one source: whole passes over its blocks, then of a permutation of
    them those that come nearest to the rest of the target."""
    def run(blocks: pd.DataFrame) -> pd.DataFrame:
        target, size = float(blocks["target"].iat[0]), int(blocks["source_size"].iat[0])
        blocks = blocks.sort_values("block", ignore_index=True)
        words = blocks["words"].to_numpy()
        whole = int(target // size) if size else 0
        rng = np.random.default_rng([seed, size, len(blocks), *blocks["key"].iat[0].encode()])
        parts = [(rng.permutation(len(blocks)), p) for p in range(whole)]
        order = rng.permutation(len(blocks))
        if whole < MAX_EPOCHS:
            parts.append((order[nearest_fill(words[order], target - whole * size)], whole))
        order = np.concatenate([p for p, _ in parts])
        return pd.DataFrame({"key": blocks["key"].iat[0], "seq": np.arange(len(order)),
                             "block": blocks["block"].to_numpy()[order],
                             "pass": np.concatenate([np.full(len(p), k) for p, k in parts])})
    return run


def _key(source: str) -> Column:
    """A source as a non-null key; the null source is a source of its own."""
    return F.when(F.col(source).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(source).cast("string")))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights: tuple[float, ...] = WEIGHTS, shards: int | None = None, blocks: int = BLOCKS, seed: int = 1,
        out: str = "mix") -> DataFrame:
    """``docs`` with a struct column ``out``: (size, source_size, target, draws).

    ``draws`` holds one (pass, shard) for each time the mix takes the document:
    none, or up to three.  Sources rank by code point, null last, and weigh
    ``weights`` in turn.  A null or empty text has size 0 and is drawn with its
    block without adding words; a source of no words has target 0.  Repeated rows
    share a block and are taken alike.  A column named ``out`` is replaced; all
    others stay, whatever their type.  A very long text is a block or part of one
    and is taken whole.  An empty table gives an empty result.  Equal inputs and seed
    give equal draws, whatever the partitioning.
    """
    sized = written(docs.select(_key(source_col).alias("key"), word_count(F.col(text_col)).alias("size"),
                                F.xxhash64(F.col(id_col), F.col(text_col)).alias("h")), "sizes")
    sources = sorted(sized.groupBy("key").agg(F.sum("size").alias("size")).collect(),
                     key=lambda r: (r["key"] == "", r["key"]))
    sizes = [int(r["size"]) for r in sources]
    targets = source_targets(sizes, weights)
    n_blocks = max(blocks, sum(sizes) // BLOCK_WORDS)
    shards = shards or max(SHARDS, sum(sizes) // BLOCK_WORDS)

    spark = docs.sparkSession
    wanted = spark.createDataFrame([(r["key"], s, t) for r, s, t in zip(sources, sizes, targets, strict=True)],
                                   "key string, source_size long, target double")
    table = written(sized.groupBy("key", F.pmod("h", F.lit(n_blocks)).alias("block")).agg(F.sum("size").alias("words"))
                    .join(wanted, "key"), "blocks")
    draws = written(table.groupBy("key").applyInPandas(_draw(seed), "key string, seq long, block long, pass int"), "draws")
    quota = {r["key"]: r["n"] for r in draws.groupBy("key").agg(F.count("*").alias("n")).collect()}
    keys = [r["key"] for r in sources]
    quotas = np.array([quota.get(k, 0) for k in keys], np.int64)
    runs = spark.range(shards).mapInPandas(_leaves(quotas, keys, shards, seed), "key string, lo long, hi long, shard int")
    placed = runs.select("key", "shard", F.explode(F.sequence("lo", "hi")).alias("seq"))
    by_block = (draws.join(placed, ["key", "seq"]).groupBy("key", "block")
                .agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("draws")))
    # at most one row per block, with at most MAX_EPOCHS + 1 draws
    plan = table.join(by_block, ["key", "block"], "left").select(
        "key", "block", "source_size", "target", F.coalesce("draws", F.array().cast("array<struct<pass:int,shard:int>>")).alias("draws"))
    keep = [c for c in docs.columns if c != out]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), _key(source_col).alias("key"),
                       F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(n_blocks)).alias("block"),
                       word_count(F.col(text_col)).alias("size"))
    return rows.join(plan, ["key", "block"]).select(*unboxed(keep), F.struct("size", "source_size", "target", "draws").alias(out))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, **options) -> DataFrame:
    """The mixed rows themselves: a document once per draw, dealt by shard and
    shuffled inside it.  Columns are those of ``docs``, of any type; rows of equal
    id and text lie in any order."""
    out = "mix"
    while out in docs.columns:
        out += "_"
    rows = mix(docs, id_col=id_col, text_col=text_col, seed=seed, out=out, **options)
    rows = rows.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.explode(f"{out}.draws").alias("draw"))
    order = F.xxhash64(F.lit(seed), "draw.pass", F.col("row")[id_col], F.col("row")[text_col])
    return (rows.withColumn("order", order).repartition("draw.shard").sortWithinPartitions("draw.shard", "order")
            .select(*unboxed(docs.columns)))
