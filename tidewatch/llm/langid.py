"""Language of a text by language-bitmask trigram filters.

Training counts code-point trigrams of words per language over all learnable
texts.  A language's filter holds the trigrams that make up ``COVERAGE`` of its
text, however many these are, without those that are many times as frequent in
another language.  All filters share one bit-sliced Bloom filter, built in tasks:
every slot holds one bit per language, so the AND of a trigram's slots is the set
of languages that contain it.  A text's matches are counted per
language, corrected by each filter's false-positive rate, and the largest decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidewatch.llm._shared import fold, written
from tidewatch.llm._words import mix

COVERAGE = 0.9999      # of a language's trigrams, told by frequency, that its filter holds at least
MIN_SHARE = 0.1        # least frequency relative to the language where a trigram is most frequent
HASHES = 4
SLOTS_PER_GRAM = 16
MAX_SLOTS = 1 << 22    # 32 MB per 64 languages; fuller filters have more false positives, which are corrected for
SLICE_CHARS = 1 << 20

_alpha: np.ndarray | None = None


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _alpha
    if _alpha is None:
        _alpha = np.array([chr(i).isalpha() for i in range(0x110000)])
    return _alpha


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of all texts, three code points to a long, and the first of each text.

    Lower-cased; runs of anything but letters are one space; a trigram has a letter
    in its middle.
    """
    joined = " " + " \0 ".join(texts).lower() + " "
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    cut = c == 0
    c = np.where(letters()[c], c, 32)
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
    keep |= cut
    c, cut = c[keep].astype(np.int64), cut[keep]
    if len(c) < 3:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    middle = c[1:-1] != 32
    grams = (c[:-2] << 42 | c[1:-1] << 21 | c[2:])[middle]
    before = np.concatenate([[0], np.cumsum(middle)])
    first = np.concatenate([[0], before[np.minimum(np.flatnonzero(cut), len(before) - 1)]])
    return grams, first


def text_slices(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    part, at, size = [], 0, 0
    for i, t in enumerate(texts):
        # the separator is not a letter in any text
        part.append(t.replace("\0", " "))
        size += len(t)
        if size >= SLICE_CHARS:
            yield at, part
            part, at, size = [], i + 1, 0
    if part:
        yield at, part


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            parts = [np.unique(trigrams(p)[0], return_counts=True) for _, p in text_slices(texts)]
            grams, back = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
            n = np.bincount(back, np.concatenate([k for _, k in parts]), len(grams)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)],
                                             names=["lang", "gram", "n"])


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray      # (slots, longs per mask)
    false_rate: np.ndarray  # per language
    default: str | None

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """The set of languages of each trigram, as bits."""
        return np.bitwise_and.reduce(self.table[slots(grams, len(self.table))], axis=0)


def _filter_size(grams: int) -> int:
    return min(MAX_SLOTS, 1 << max(10, (SLOTS_PER_GRAM * max(1, grams) - 1).bit_length()))


def slots(grams: np.ndarray, size: int) -> np.ndarray:
    """The slots of every trigram, a row per hash function."""
    h = mix(grams.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.array([(h + np.uint64(k) * step) & np.uint64(size - 1) for k in range(HASHES)])


def _model(table: np.ndarray, langs: list[str], default: str | None) -> Model:
    fill = np.array([np.mean((table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)) for i in range(len(langs))])
    return Model(langs, table, fill ** HASHES, default)


def build(rows: list[tuple[str, int]], langs: list[str], default: str | None) -> Model:
    """The bit-sliced filter of (language, trigram) pairs."""
    size = _filter_size(len({g for _, g in rows}))
    table = np.zeros((size, max(1, -(-len(langs) // 64))), np.uint64)
    for i, lang in enumerate(langs):
        at = slots(np.array([g for name, g in rows if name == lang], np.int64), size)
        table[at.ravel(), i // 64] |= np.uint64(1) << np.uint64(i % 64)
    return _model(table, langs, default)


def _set_bits(langs: list[str], size: int):
    """The bits that one task's (language, trigram) pairs set, a row per slot and 64 languages."""
    number = {lang: i for i, lang in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            at = slots(batch.column(1).to_numpy(), size).astype(np.int64)
            key = (at * (1 + len(langs) // 64) + who // 64).ravel()
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.diff(key[order], prepend=-1))
            if len(first):
                bit = np.tile(np.uint64(1) << (who % 64).astype(np.uint64), HASHES)[order]
                key = key[order[first]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key // (1 + len(langs) // 64)), pa.array(key % (1 + len(langs) // 64)),
                     pa.array(np.bitwise_or.reduceat(bit, first).view(np.int64))], names=["slot", "part", "bits"])
    return run


def train(docs: DataFrame, coverage: float = COVERAGE, min_share: float = MIN_SHARE) -> Model:
    """Learn from documents with text and language whose fold modulo 4 is not 2.

    One row per language and frequency class and the filter's bits, at most MAX_SLOTS
    longs per 64 languages, reach the driver; trigrams stay in tasks.
    """
    rows = (docs.where(fold(F.col("doc_id"), 4) != 2).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
            .where("lang IS NOT NULL AND text IS NOT NULL"))
    counts = written(rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
                     .withColumn("class", F.floor(F.log2("n") * 8).cast("int")), "trigrams")
    # frequency classes from the most frequent down, until the language is covered; some hundred rows a language
    classes = counts.groupBy("lang", "class").agg(F.sum("n").alias("n"))
    by_lang = Window.partitionBy("lang")
    more = F.coalesce(F.sum("n").over(by_lang.orderBy(F.col("class").desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    least = (classes.withColumns({"more": more, "all": F.sum("n").over(by_lang)}).where(F.col("more") < coverage * F.col("all"))
             .groupBy("lang").agg(F.min("class").alias("least"), F.first("all").alias("all")))
    share = F.col("n") / F.col("all")
    top = F.max("share").over(Window.partitionBy("gram"))  # a row per language at most
    kept = written(counts.join(least, "lang").where(F.col("class") >= F.col("least")).select("lang", "gram", "n", share.alias("share"))
                   .withColumn("top", top).where(F.col("share") >= min_share * F.col("top")).select("lang", "gram", "n"), "filters")
    sizes = {r["lang"]: r["n"] for r in kept.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(sizes)
    size = _filter_size(kept.select("gram").distinct().count())
    bits = (kept.select("lang", "gram").mapInArrow(_set_bits(langs, size), "slot long, part long, bits long")
            .groupBy("slot", "part").agg(F.bit_or("bits").alias("bits")).toArrow())
    table = np.zeros((size, max(1, -(-len(langs) // 64))), np.uint64)
    table[bits["slot"].to_numpy(), bits["part"].to_numpy()] = bits["bits"].to_numpy().view(np.uint64)
    return _model(table, langs, max(langs, key=lambda x: (sizes[x], x), default=None))


def decide(model: Model, texts: list[str]) -> list[tuple[str, float]]:
    out: list[tuple[str, float]] = []
    for _, part in text_slices(texts):
        grams, first = trigrams(part)
        masks = model.masks(grams)
        ends = np.append(first[1:], len(grams))
        n = ends - first
        counts = np.zeros((len(part), len(model.langs)))
        for i in range(len(model.langs)):
            bits = np.concatenate([[0], np.cumsum((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1), dtype=np.int64)])
            counts[:, i] = bits[ends] - bits[first]
        real = np.maximum(0, counts - n[:, None] * model.false_rate) / np.maximum(1e-9, 1 - model.false_rate)
        for k, t in enumerate(part):
            if n[k] == 0 or not model.langs:
                out.append(("und", 0.0))
                continue
            order = np.argsort(-real[k], kind="stable")
            best = real[k, order[0]]
            if best <= 0:
                out.append((model.default, 0.0))
                continue
            second = real[k, order[1]] if len(order) > 1 else 0.0
            out.append((model.langs[order[0]], float(best / (best + second))))
    return out


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = decide(shared.value, [t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([g[0] for g in got], pa.string()),
                                              pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score"])
    return run


def language_id(docs: DataFrame, coverage: float = COVERAGE, min_share: float = MIN_SHARE) -> DataFrame:
    """One row per document: (doc_id, held_out, lang_pred, score).

    ``lang_pred`` is ``und`` with score 0 for a text that is null or has no letter,
    or if nothing was learned; a text without any known trigram gets the language
    of most trigrams with score 0; ties go to the first language by name.  The
    score is the winner's share of the two largest corrected counts.  A null id is
    learned from; repeated rows come out as often; other columns are ignored.  A very
    long text is read whole; an empty table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, coverage, min_share))  # MAX_SLOTS longs per 64 languages
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_predict(model), "doc_id long, lang_pred string, score double").select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
