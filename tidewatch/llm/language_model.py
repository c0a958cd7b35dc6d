"""Whole-document log-likelihood under a recurrent language model learned from the corpus.

1. Every training text is counted: one row per distinct word of a batch, summed by
   Spark.  Words are known by a 64-bit hash (two of 10**9 words collide with
   chance 3 percent) and by a bucket of their last two bytes.
2. The most frequent words become the model's words; all others stand behind the
   symbol of their bucket, inside which counts over the whole corpus decide.
3. All segments of the training texts are dealt to rounds and workers, as many as
   the segments call for.  In each round a worker trains on its part from the common
   weights; the round's result is the mean of all workers' weights by the tokens
   they learned from, summed up in groups of a few.
4. Every text is scored whole, its state carried across windows.  Counts of the
   words beyond a broadcast table of fixed size come from a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import gru
from tidewatch.llm._shared import fold, written
from tidewatch.llm._words import mix, slices, words

MODEL_WORDS = 4096        # words with a symbol of their own
CLASSES = 40              # output classes of those
BUCKETS = 48              # symbols of all other words, by their last two bytes
TABLE_WORDS = 1 << 18     # words whose counts are broadcast: 20 bytes each
SEGMENT = 128             # tokens of a training segment
WORKERS, ROUNDS = 6, 4    # workers at least
WORKER_SEGMENTS = 80_000  # segments of a worker in all rounds, where there are enough for WORKERS
FAN_IN = 16               # weights that are summed up in one task
BATCH = 128               # segments per update
RATES = (0.01, 0.006, 0.003, 0.0015)
SCORE_DOCS = 8192         # texts that run side by side

_suffix = (mix(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)
_low = np.arange(256, dtype=np.int64)
_low[65:91] += 32


def bucket_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Bucket of each word by its last two bytes, A-Z as a-z."""
    last = _low[data[end - 1]]
    before = np.where(end - start > 1, _low[data[np.maximum(end - 2, 0)]], 0)
    return _suffix[last * 256 + before]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = []
        for _, data, offsets in slices(batch.column(0)):
            h, start, end, _ = words(data, offsets)
            u, at, n = np.unique(h, return_index=True, return_counts=True)
            parts.append((u, bucket_of(data, start[at], end[at]) if len(u) else np.zeros(0, np.int64), n))
        if parts:
            u, at, back = np.unique(np.concatenate([x[0] for x in parts]), return_index=True, return_inverse=True)
            n = np.bincount(back, np.concatenate([x[2] for x in parts]), len(u)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(np.concatenate([x[1] for x in parts])[at].astype(np.int32)),
                                              pa.array(n)], names=["word", "bucket", "n"])


class Table:
    """Places of sorted 64-bit keys, found through their leading bits."""

    def __init__(self, keys: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.order = keys[order], order
        self.shift = np.uint64(64 - max(4, (4 * len(keys)).bit_length()))
        lead = (self.keys >> self.shift).astype(np.int64)
        self.first = np.searchsorted(lead, np.arange((1 << (64 - int(self.shift))) + 1)).astype(np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index into the keys as given, or -1."""
        out = np.full(len(h), -1, np.int64)
        if not len(self.keys):
            return out
        lead = (h >> self.shift).astype(np.int64)
        at, stop = self.first[lead], self.first[lead + 1]
        left = np.flatnonzero(at < stop)
        while len(left):
            i = at[left]
            hit = self.keys[i] == h[left]
            out[left[hit]] = self.order[i[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < stop[left]]
        return out


@dataclass
class Model:
    table: Table
    counts: np.ndarray          # of the table's words
    symbol: np.ndarray          # of the table's words; -1 for those that share their bucket's symbol
    first_bucket: int
    bucket_log: np.ndarray      # log10 of what a bucket's counts are divided by
    lay: gru.Layout
    weights: dict[str, np.ndarray]
    tokens: int                 # N
    distinct: int               # V
    texts: int                  # c of the end

    def read(self, column: pa.Array):
        """Per slice: (first text, place of each word or -1, bucket, hash, first word of each text)."""
        for i, data, offsets in slices(column):
            h, start, end, first = words(data, offsets)
            yield i, self.table.find(h), bucket_of(data, start, end) if len(h) else np.zeros(0, np.int64), h, first

    def symbols(self, place: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        own = np.where(place >= 0, self.symbol[place], -1) if len(self.symbol) else np.full(len(place), -1)
        return np.where(own >= 0, own, self.first_bucket + bucket).astype(np.int32)


def with_ends(sym: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols with an end after each text, and the texts' offsets."""
    out = np.zeros(len(sym) + len(first) - 1, np.int32)
    n = np.diff(first)
    out[np.arange(len(sym)) + np.repeat(np.arange(len(n)), n)] = sym
    return out, first + np.arange(len(first))


def repeats(key: np.ndarray) -> np.ndarray:
    """How many equal keys stand before each."""
    order = np.argsort(key, kind="stable")
    _, first, n = np.unique(key[order], return_index=True, return_counts=True)
    out = np.empty(len(key), np.int64)
    out[order] = np.arange(len(key)) - np.repeat(first, n)
    return out


def _segments(shared):
    """Every segment of (doc_id, text) and its mark.  A batch's further copies of a text have
    marks of their own, by their ids, the task and their places among the copies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, task = shared.value, np.uint64(TaskContext.get().partitionId() << 32)
        for batch in batches:
            kept, keys = [], np.zeros(batch.num_rows, np.uint64)
            for i, place, bucket, h, first in model.read(batch.column(1)):
                sym, off = with_ends(model.symbols(place, bucket), first)
                kept.append((i, sym.astype(np.uint16), off))
                full = np.flatnonzero(np.diff(first))
                if len(full):
                    keys[i + full] = np.bitwise_xor.reduceat(h, first[full])
            ids, copy = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False).view(np.uint64), repeats(keys).astype(np.uint64)
            keys = np.where(copy > 0, mix(keys + mix(ids + mix(copy + task))), keys)
            for i, sym, off in kept:
                rows, marks = [], []
                for t in range(len(off) - 1):
                    begins = range(int(off[t]), int(off[t + 1]), SEGMENT)
                    marks.append(mix(np.arange(len(begins), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + keys[i + t]) >> np.uint64(1))
                    for lo in begins:
                        hi = min(lo + SEGMENT, int(off[t + 1]))
                        rows.append(sym[lo - 1:hi].tobytes() if lo > off[t] else b"\0\0" + sym[lo:hi].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(marks).view(np.int64)), pa.array(rows, pa.binary())], names=["mark", "symbols"])
    return run


def segments(texts: DataFrame, model: Model) -> DataFrame:
    """(mark, symbols) of every segment of all texts: 16-bit symbols, the first one input only."""
    doc_id = F.col("doc_id").cast("long") if "doc_id" in texts.columns else F.lit(None).cast("long")
    shared = texts.sparkSession.sparkContext.broadcast(model)
    return texts.select(doc_id.alias("doc_id"), "text").mapInArrow(_segments(shared), "mark long, symbols binary")


def dealt(segs: DataFrame, workers: int) -> DataFrame:
    """Segments with the round and the worker that train on them."""
    return segs.withColumns({"round": F.pmod(F.shiftright("mark", 8), F.lit(ROUNDS)), "worker": F.pmod(F.shiftright("mark", 16), F.lit(workers))})


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    held: list[np.ndarray] = []
    for batch in batches:
        for s in batch.column("symbols"):
            held.append(np.frombuffer(s.as_py(), np.uint16))
            if len(held) == BATCH:
                yield held
                held = []
    if held:
        yield held


def _by_worker(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of the batches with the worker that trains on them."""
    for batch in batches:
        worker = batch.column("worker").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(worker)) + 1), len(worker)]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                yield int(worker[lo]), batch.slice(lo, hi - lo)


def _train(shared, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lay, weights = shared.value
        for worker, own in groupby(_by_worker(batches), key=lambda x: x[0]):
            p = {n: v.copy() for n, v in weights.items()}
            seen = gru.train(p, lay, _batches(b for _, b in own), rate)
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gru.NAMES, pa.string()), pa.array([worker] * len(gru.NAMES), pa.int64()), pa.array([seen] * len(gru.NAMES), pa.int64()),
                     pa.array([(p[n].astype(np.float64) * seen).tobytes() for n in gru.NAMES], pa.binary())], names=["name", "worker", "n", "weights"])
    return run


WEIGHTS = "name string, worker long, n long, weights binary"


def _sum(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(len(rows["weights"].iat[0]) // 8, np.float64)
    for w in rows["weights"]:
        total += np.frombuffer(w, np.float64)
    return pd.DataFrame({"name": [rows["name"].iat[0]], "worker": [rows["worker"].iat[0] // FAN_IN], "n": [rows["n"].sum()],
                         "weights": [total.tobytes()]})


def learn(texts: DataFrame, workers: int | None = None) -> tuple[Model, DataFrame]:
    """The model and the counts (word, bucket, n) of a table with column ``text`` and, to tell
    copies of a text apart, ``doc_id``."""
    spark = texts.sparkSession
    counts = written(texts.select("text").mapInArrow(_count, "word long, bucket int, n long").groupBy("word", "bucket")
                     .agg(F.sum("n").alias("n")), "counts")
    n_texts = texts.count()
    per_bucket = np.zeros((BUCKETS, 2), np.int64)
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        per_bucket[r["bucket"]] = r["n"], r["v"]
    tokens, distinct = int(per_bucket[:, 0].sum()) + n_texts, int(per_bucket[:, 1].sum()) + (n_texts > 0)
    top = counts.orderBy(F.col("n").desc(), "word").limit(TABLE_WORDS).toArrow().combine_chunks()  # fixed bound
    key, bucket, n = (top.column(c).to_numpy() for c in ("word", "bucket", "n"))
    symbol = np.full(len(key), -1, np.int64)
    k = min(MODEL_WORDS, len(key))
    symbol[:k] = 1 + np.arange(k)
    for b in range(BUCKETS):
        mine = bucket[:k] == b
        per_bucket[b] -= int(n[:k][mine].sum()), int(mine.sum())
    lay = gru.layout(n[:k], CLASSES, BUCKETS)
    weights = gru.initial(lay, np.concatenate([[n_texts], n[:k], per_bucket[:, 0]]).astype(np.float64))
    model = Model(Table(key.astype(np.int64).view(np.uint64)), n, symbol, 1 + k, np.log10(per_bucket.sum(axis=1) + 1.0), lay, weights,
                  tokens, distinct, n_texts)
    segs = written(segments(texts, model), "segments")
    workers = workers or max(WORKERS, segs.count() // WORKER_SEGMENTS)
    for r in range(ROUNDS):
        now = spark.sparkContext.broadcast((lay, weights))
        part = (dealt(segs, workers).where(F.col("round") == r).select("mark", "symbols", F.col("worker").cast("int"))
                .repartitionById(workers, "worker").sortWithinPartitions("worker", "mark"))
        sums = part.mapInArrow(_train(now, RATES[r]), WEIGHTS)
        groups = workers
        while groups > 1:
            groups = -(-groups // FAN_IN)
            sums = sums.groupBy("name", F.floor(F.col("worker") / FAN_IN).alias("group")).applyInPandas(_sum, WEIGHTS)
        for m in sums.groupBy("name").applyInPandas(_sum, WEIGHTS).collect():  # one set of weights
            weights[m["name"]] = (np.frombuffer(m["weights"], np.float64) / m["n"]).astype(np.float32).reshape(weights[m["name"]].shape)
        now.unpersist()
    return model, counts


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        row = TaskContext.get().partitionId() << 40  # rows are numbered by task and place
        for big in batches:
            for lo in range(0, big.num_rows, SCORE_DOCS):
                part = big.slice(lo, SCORE_DOCS)
                yield _score_batch(model, part, row)
                row += part.num_rows
    return run


def _score_batch(model: Model, batch: pa.RecordBatch, row: int = 0) -> pa.RecordBatch:
    n = batch.num_rows
    parts, offs, at = [], [np.zeros(1, np.int64)], 0
    n_tokens, known = np.ones(n, np.int64), np.full(n, int(model.texts > 0))
    base_log = np.full(n, np.log10(model.texts + 1.0))
    inside = np.zeros(n)
    rare: list[np.ndarray] = []
    for i, place, bucket, h, first in model.read(batch.column(1)):
        sym, off = with_ends(model.symbols(place, bucket), first)
        parts.append(sym)
        offs.append(off[1:] + at)
        at += len(sym)
        m = len(first) - 1
        text = np.repeat(np.arange(m), np.diff(first))
        n_tokens[i:i + m] += np.diff(first)
        found = place >= 0
        count_log = np.log10(np.where(found, model.counts[place] if len(model.counts) else 0, 0) + 1.0)
        known[i:i + m] += np.bincount(text, found, m).astype(np.int64)
        base_log[i:i + m] += np.bincount(text, count_log, m)
        # a word behind its bucket: its share there, but for the counts that the join brings
        behind = sym_behind(model, place)
        inside[i:i + m] += np.bincount(text, behind * (count_log - model.bucket_log[bucket]), m)
        rare.extend(np.split(h[~found].view(np.int64), np.cumsum(np.bincount(text[~found], minlength=m))[:-1]))
    symbols = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    own = gru.score(model.weights, model.lay, symbols, np.concatenate(offs)) / np.log(10)
    rows = row + np.arange(n, dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(rows), batch.column(0), pa.array(n_tokens), pa.array(known), pa.array(base_log), pa.array(own + inside),
         pa.array(rare, pa.list_(pa.int64()))],
        names=["row", "doc_id", "n_tokens", "known", "base_log", "score", "rare"])


def sym_behind(model: Model, place: np.ndarray) -> np.ndarray:
    if not len(model.symbol):
        return np.ones(len(place))
    return ((place < 0) | (model.symbol[place] < 0)).astype(float)


def language_scores(docs: DataFrame, workers: int | None = None) -> DataFrame:
    """One row per document: (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Learns from documents whose crc32 fold modulo 7 is not 2; a null id is in fold 0.
    A null text is empty and consists of its end alone.  A word without training
    counts has the share of a word never seen.  Repeated rows come out as often;
    other columns are ignored; an empty table gives an empty result; without
    training texts all words are unseen.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model, counts = learn(rows.where(fold(F.col("doc_id"), 7) != 2), workers)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = written(rows.mapInArrow(_score(shared), "row long, doc_id long, n_tokens long, known long, base_log double, score double, rare array<long>"), "scored")
    extra = (scored.select("row", F.explode("rare").alias("word")).join(counts.select("word", "n"), "word")
             .groupBy("row").agg(F.sum(F.log10(F.col("n") + 1)).alias("log"), F.count("*").alias("known_more")))
    denominator = float(np.log10(model.tokens + model.distinct + 1.0))
    log = F.coalesce("log", F.lit(0.0))
    return scored.drop("rare").join(extra, "row", "left").select(
        "doc_id", (fold(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("known_more", F.lit(0))).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base_log") + log - F.col("n_tokens") * denominator).alias("base_score"), (F.col("score") + log).alias("score"))
