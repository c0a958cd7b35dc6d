"""Exact nearest binary codes by incremental multi-index hashing.

Equal codes are one entry that remembers its k + 1 least ids, so any number of
copies weighs as one.  Entries are dealt into shards by hash.  A shard indexes
every code once per segment of about log2(entries) bits.  A query visits, per
segment, the buckets at radius 0, then 1, and so on; after radius r every code
within m * (r + 1) - 1 of the query has been verified (m segments), and the search
ends as soon as its kth verified distance lies within that bound.  The stated
query set meets the shards in blocks; each returns a short list per query.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidewatch.llm._shared import written

SHARD_CODES = 8192
BLOCK_QUERIES = 65536


def sign_codes(vectors: list, longs: int) -> np.ndarray:
    """One bit per dimension, set where positive; missing dimensions and nulls are 0."""
    out = np.zeros((len(vectors), longs * 64), bool)
    for i, v in enumerate(vectors):
        x = np.array([0.0 if e is None else e for e in v], np.float64) if not isinstance(v, np.ndarray) else v
        out[i, :len(x)] = x > 0
    return np.packbits(out, axis=1)


def _codes(longs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = sign_codes([v.values.to_numpy(zero_copy_only=False) if v.values.null_count == 0 else v.as_py()
                                for v in batch.column(1)], longs)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.tobytes() for c in codes], pa.binary())],
                                             names=["id", "code"])
    return run


@lru_cache(maxsize=256)
def flips(width: int, radius: int) -> np.ndarray:
    """All masks of ``radius`` set bits among ``width``."""
    return np.array([sum(1 << b for b in bits) for bits in combinations(range(width), radius)], np.int64)


class Index:
    """Multi-index over distinct codes given as bits."""

    def __init__(self, codes: np.ndarray, ids: list[np.ndarray]):
        self.codes, self.ids = codes.view(np.uint64).reshape(len(codes), -1), ids
        self.copies = np.array([len(i) for i in ids])
        bits = np.unpackbits(codes, axis=1)
        total = bits.shape[1]
        wide = int(np.clip(np.ceil(np.log2(max(2, len(codes)))), 4, 18))
        edges = np.linspace(0, total, max(1, round(total / wide)) + 1).astype(int)
        self.parts = list(zip(edges[:-1], edges[1:], strict=True))
        self.tables = []
        for lo, hi in self.parts:
            value = bits[:, lo:hi].astype(np.int64) @ (1 << np.arange(hi - lo, dtype=np.int64))
            order = np.argsort(value, kind="stable")
            self.tables.append((order, np.searchsorted(value[order], np.arange((1 << (hi - lo)) + 1))))

    def search(self, code: np.ndarray, need: int) -> list[tuple[int, int]]:
        """The ``need`` least (distance, id) pairs."""
        bits, words = np.unpackbits(code), code.view(np.uint64)
        values = [int(bits[lo:hi].astype(np.int64) @ (1 << np.arange(hi - lo, dtype=np.int64))) for lo, hi in self.parts]
        seen = np.zeros(len(self.codes), bool)
        far = np.zeros(len(self.codes), np.int64)
        for radius in range(max(hi - lo for lo, hi in self.parts) + 1):
            found = []
            for (lo, hi), value, (order, start) in zip(self.parts, values, self.tables, strict=True):
                if radius > hi - lo:
                    continue
                at = value ^ flips(hi - lo, radius)
                first, last = start[at], start[at + 1]
                n = last - first
                if n.sum():
                    keep = n > 0
                    first, n = first[keep], n[keep]
                    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    found.append(order[np.repeat(first, n) + step])
            if found:
                new = np.unique(np.concatenate(found))
                new = new[~seen[new]]
                seen[new] = True
                far[new] = np.bitwise_count(self.codes[new] ^ words).sum(axis=1)
            covered = len(self.parts) * (radius + 1) - 1
            if self.copies[seen & (far <= covered)].sum() >= need:
                break
        near = np.flatnonzero(seen)
        if len(near) > need:  # no code beyond the need-th distance can give one of the pairs
            near = near[far[near] <= np.partition(far[near], need - 1)[need - 1]]
        picked = sorted((int(far[i]), int(k)) for i in near for k in self.ids[i][:need])
        return picked[:need]


def _search(k: int):
    def run(codes: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": [], "near": []}, dtype=object)
        if not len(codes) or not len(queries):
            return empty
        bits = np.frombuffer(b"".join(codes["code"]), np.uint8).reshape(len(codes), -1)
        index = Index(bits, list(codes["ids"]))
        near = [[{"distance": d, "id": i} for d, i in index.search(np.frombuffer(q, np.uint8), k + 1)] for q in queries["query"]]
        return pd.DataFrame({"query": queries["query"], "near": near})
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k nearest codes of every query, exactly.

    Codes are the signs of the vectors' dimensions; distance is Hamming's; ties go
    to the smaller id; a query's own id is left out.  A null or empty vector has no
    code: it is neither found nor answered.  Null ids are ignored, repeated rows
    count once, other columns are ignored.  With fewer than k other codes all are
    returned; empty tables give empty results.
    """
    def clean(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(
            "id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    rows, asked = clean(vectors), clean(queries)
    width = rows.unionByName(asked).agg(F.max(F.size("v"))).first()[0] or 1
    code = lambda df: df.mapInArrow(_codes(-(-width // 64)), "id long, code binary").distinct()
    asked = written(code(asked), "queries")
    # the partial group limit leaves k + 1 rows of a code per task before the shuffle
    place = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    entries = written(code(rows).withColumn("place", place).where(F.col("place") <= k + 1)
                      .groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")), "codes")
    n, m = entries.count(), asked.select("code").distinct().count()
    shards, blocks = max(1, -(-n // SHARD_CODES)), max(1, -(-m // BLOCK_QUERIES))
    dealt = entries.withColumn("shard", F.pmod(F.xxhash64("code"), F.lit(shards)))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    sent = asked.select(F.col("code").alias("query")).distinct().withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
    sent = sent.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    # a partition per shard and block, by number: a shard is few bytes but much work, and is not to be merged with others
    parts = shards * blocks
    dealt, sent = (x.repartition(parts, "shard", "block") for x in (dealt, sent))
    near = (dealt.groupBy("shard", "block").cogroup(sent.groupBy("shard", "block"))
            .applyInPandas(_search(k), "query binary, near array<struct<distance:int,id:long>>"))
    merged = (near.groupBy("query").agg(F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k + 1).alias("near")))
    answers = asked.withColumnRenamed("code", "query").join(merged, "query")
    own = F.filter("near", lambda x: x["id"] != F.col("id"))
    return (answers.select(F.col("id").alias("query_id"), F.posexplode(F.slice(own, 1, k)).alias("rank", "x"))
            .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("x.id").alias("neighbor_id"), F.col("x.distance").alias("distance")))
