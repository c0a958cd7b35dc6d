"""Length buckets of least padding and token-budget batches inside them.

The global histogram of lengths decides the bucket bounds by dynamic programming:
among all ways to cut the lengths into at most ``buckets`` runs, the one whose
documents, padded to their run's longest length, need the fewest padding tokens.
The histogram that reaches the driver has a row per distinct length, so at most the
square root of twice the corpus's tokens.  A batch of a bucket holds as many
documents as the token budget allows at the bucket's bound.  Batch places come from
counts per chunk of a bucket and positions inside the chunk; no task sees a whole
bucket.
"""

from __future__ import annotations

from array import array
from collections import deque
from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidewatch.llm._shared import unboxed, word_count, written

BUCKETS = 16
TOKEN_BUDGET = 16384
CHUNK_ROWS = 50_000


def optimal_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` runs of the sorted ``lengths`` that minimise
    sum(bound - length) over all documents.

    A run that starts behind the i-th length and ends at bound b pads a part that depends on
    b alone and best[i] + words[i] - b * docs[i]: a line in b.  Bounds rise and so do the
    docs before a cut, so the least line is the front of a hull that is walked once.
    """
    m = len(lengths)
    longest = [int(x) for x in lengths]
    docs = [0, *accumulate(int(c) for c in counts)]
    words = [0, *accumulate(x * int(c) for x, c in zip(longest, counts, strict=True))]
    best: list[int | None] = [0] + [None] * m
    cuts = []
    for _ in range(min(buckets, m)):
        nxt: list[int | None] = [0] + [None] * m
        cut = array("q", [0]) * (m + 1)
        hull: deque[tuple[int, int, int]] = deque()  # (docs before, height, cut)
        for j in range(1, m + 1):
            start = best[j - 1]
            if start is not None:
                n, height = docs[j - 1], start + words[j - 1]
                while len(hull) > 1:
                    (n0, h0, _), (n1, h1, _) = hull[-2], hull[-1]
                    if (height - h0) * (n1 - n0) > (h1 - h0) * (n - n0):
                        break
                    hull.pop()
                hull.append((n, height, j - 1))
            b = longest[j - 1]
            while len(hull) > 1 and hull[1][1] - b * hull[1][0] < hull[0][1] - b * hull[0][0]:
                hull.popleft()
            nxt[j] = hull[0][1] - b * hull[0][0] + b * docs[j] - words[j]
            cut[j] = hull[0][2]
        cuts.append(cut)
        best = nxt
    bounds, j = [], m
    for cut in reversed(cuts):
        if j == 0:
            break
        bounds.append(longest[j - 1])
        j = cut[j]
    return bounds[::-1]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS,
         token_budget: int = TOKEN_BUDGET, seed: int = 1, length: Column | None = None, out: str = "pack") -> DataFrame:
    """``docs`` with a struct column ``out``: (n_tokens, bucket, bound, batch, slot, padding).

    A document's length is its words plus an end token unless ``length`` is given.
    Batch ``batch`` of bucket ``bucket`` holds at most token_budget // bound
    documents, but one at least: a document longer than the budget is a batch of
    its own, whole.  Null and empty texts have length 1.  Repeated rows take a
    place each.  A column named ``out`` is replaced; an empty table gives an empty
    result.  Equal inputs and seed give equal batches, up to the order of equal rows.
    """
    keep = [c for c in docs.columns if c != out]
    length = word_count(F.col(text_col)) + 1 if length is None else length
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), length.cast("long").alias("n_tokens"),
                       F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("h"))
    seen = written(rows.select("n_tokens", "h"), "lengths")
    hist = seen.groupBy("n_tokens").agg(F.count("*").alias("n")).toArrow().sort_by("n_tokens")
    counts = hist["n"].to_numpy()
    bounds = optimal_bounds(hist["n_tokens"].to_numpy(), counts, buckets) or [1]
    chunks = max(64, int(counts.sum()) // CHUNK_ROWS)

    bucket = F.lit(0)
    for b in bounds[:-1]:
        bucket = bucket + (F.col("n_tokens") > b).cast("int")
    # never null, and said so: else the join would have Spark test both, lengths counted anew, on every row
    bucket = F.coalesce(bucket, F.lit(0))
    chunk = F.coalesce(F.pmod(F.shiftright("h", 8), F.lit(chunks)), F.lit(0))
    counts = seen.groupBy(bucket.alias("bucket"), chunk.alias("chunk")).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("bucket").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("bucket", "chunk").orderBy("h")) - 1
    rows = (rows.withColumns({"bucket": bucket, "chunk": chunk}).withColumn("place", place)
            .join(offsets, ["bucket", "chunk"]))
    at = F.col("before") + F.col("place")
    bound = F.element_at(F.array(*[F.lit(b).cast("long") for b in bounds]), F.col("bucket") + 1)
    cap = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / bound))
    return rows.select(*unboxed(keep), F.struct(
        "n_tokens", "bucket", bound.alias("bound"), F.floor(at / cap).cast("long").alias("batch"),
        F.pmod(at, cap).cast("long").alias("slot"), (bound - F.col("n_tokens")).alias("padding")).alias(out))
