"""Near-duplicate groups by b-bit MinHash with exact confirmation.

1. Each text becomes its set of word shingles (64-bit hashes).  Texts with equal
   sets share a 128-bit class key; from here on only classes take part, so a
   group of any number of copies weighs as much as one text.
2. A class has ``BANDS * ROWS`` minima.  Groups of ``ROWS`` full minima are band
   keys; the low four bits of all minima are packed into seven longs.
3. Candidates come from equal band keys in three passes.  A bucket's centre is the
   member whose buckets are fullest, in a group of edited copies the one nearest
   to all.  First each class against the best centre of its buckets; then against
   the centres of its other buckets that the first links left in another
   component; last, the members of one bucket that still lie in different
   components and whose sizes and shingles that no other such member has leave
   room for the threshold.  No pass lists all pairs of a group.
4. A candidate stays if the similarity estimated from equal 4-bit slots, corrected
   for chance collisions, reaches the threshold less a margin of about five
   standard errors; it is then confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm._shared import boxed, join_each, unboxed, written
from tidewatch.llm._words import shingle_hashes, slices, words
from tidewatch.llm.components import components

BANDS, ROWS = 28, 4  # a pair at similarity 0.8 shares no band with chance 4e-7
BITS = 4
SLOTS = BANDS * ROWS
PACKED = SLOTS * BITS // 64
MARGIN = 0.22
FINE_BITS, FINE_SLOTS, FINE_MARGIN = 2, 2048, 0.055  # of the longer signature

_rng = np.random.default_rng(7)
_MUL = _rng.integers(1, 2**63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, SLOTS, dtype=np.uint64)
_FINE_MUL = _rng.integers(1, 2**63, FINE_SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FINE_ADD = _rng.integers(0, 2**63, FINE_SLOTS, dtype=np.uint64)
_BAND_MUL = _rng.integers(1, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(hashes: np.ndarray, mul: np.ndarray = _MUL, add: np.ndarray = _ADD) -> np.ndarray:
    """Least value of each hash function, as 32-bit numbers."""
    low = np.full(len(mul), 2**64 - 1, np.uint64)
    for k in range(0, len(mul), 128):
        for i in range(0, len(hashes), 256):
            part = hashes[i:i + 256, None] * mul[k:k + 128]
            part += add[k:k + 128]
            np.minimum(low[k:k + 128], part.min(axis=0), out=low[k:k + 128])
    return low >> np.uint64(32)


def pack(low: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The low ``bits`` bits of each minimum, as many to a long as fit."""
    slots = (low & np.uint64(2 ** bits - 1)).reshape(-1, 64 // bits)
    return (slots << (np.arange(64 // bits, dtype=np.uint64) * np.uint64(bits))).sum(axis=1, dtype=np.uint64).view(np.int64)


def band_keys(low: np.ndarray) -> np.ndarray:
    mixed = (low.reshape(BANDS, ROWS) + np.uint64(1)) * _BAND_MUL
    mixed = np.bitwise_xor.accumulate(mixed ^ (mixed >> np.uint64(29)), axis=1)[:, -1] * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def text_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted shingle set of each text."""
    for _, data, offsets in slices(column):
        h, _, _, first = words(data, offsets)
        for i in range(len(offsets) - 1):
            yield np.unique(shingle_hashes(h[first[i]:first[i + 1]], size))


def set_key(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, key, sig, bands = [], [], [], []
            for s in text_sets(batch.column(2), size):
                n.append(len(s))
                if len(s):
                    low = minima(s)
                    key.append(set_key(s))
                    sig.append(pack(low))
                    bands.append(band_keys(low))
                else:
                    key.append(None)
                    sig.append(None)
                    bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                 pa.array(sig, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_shingles", "key", "sig", "bands"])
    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.tobytes() for s in text_sets(batch.column(1), size)], pa.binary())],
                names=["key", "set"])
    return run


def _confirm(percent: int):
    """Keep pairs with 100 * |intersection| >= percent * |union|, counted on the sorted sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2), batch.column(3)
            keep = []
            for x, y in zip(a, b, strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
                    keep.append(False)
                    continue
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _fine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sigs = [pack(minima(np.frombuffer(x.as_py(), np.uint64), _FINE_MUL, _FINE_ADD), FINE_BITS) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigs, pa.list_(pa.int64()))], names=["key", "fine"])


def estimate(x: str, y: str) -> Column:
    """Similarity from the packed signatures, corrected for equal low bits by chance."""
    differ = F.lit(0)
    for i in range(PACKED):
        z = F.col(x)[i].bitwiseXOR(F.col(y)[i])
        some = z.bitwiseOR(F.shiftright(z, 1)).bitwiseOR(F.shiftright(z, 2)).bitwiseOR(F.shiftright(z, 3))
        differ = differ + F.bit_count(some.bitwiseAND(F.lit(0x1111111111111111)))
    chance = 2.0 ** -BITS
    return (1 - differ / float(SLOTS) - chance) / (1 - chance)


def fine_estimate(x: str, y: str) -> Column:
    """As ``estimate``, from the longer signatures."""
    def differ(p: Column, q: Column) -> Column:
        z = p.bitwiseXOR(q)
        return F.bit_count(z.bitwiseOR(F.shiftright(z, 1)).bitwiseAND(F.lit(0x5555555555555555)))

    n = F.aggregate(F.zip_with(x, y, differ), F.lit(0), lambda acc, d: acc + d)
    chance = 2.0 ** -FINE_BITS
    return (1 - n / float(FINE_SLOTS) - chance) / (1 - chance)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) whose full sets are alike enough."""
    with_a = pairs.join(sets.select(F.col("key").alias("a"), F.col("set").alias("sa")), "a")
    with_b = with_a.join(sets.select(F.col("key").alias("b"), F.col("set").alias("sb")), "b")
    return with_b.select("a", "b", "sa", "sb").mapInArrow(_confirm(percent), "a binary, b binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: (doc_id, text_hash, n_shingles, component_id, kept, class_key).

    Documents are linked when 100 * intersection >= ``percent`` * union of their
    sets of ``shingle``-word shingles; ``component_id`` is the least id reachable.
    Null or wordless texts have an empty set, link with nothing and are kept.  A
    repeated row is returned each time; rows that share the least id are all
    kept.  A null id can join a component but not name it; if no row of the
    component has an id, ``component_id`` is null and all its rows are kept.  Other
    columns are ignored.  ``percent`` must be 70 or more: the bands are laid out for that.
    """
    if percent < 70:
        raise ValueError("the bands find pairs of 70 percent or more")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    sketch = written(docs.select("doc_id", "text_hash", "text").mapInArrow(
        _sketch(shingle), "doc_id long, text_hash long, n_shingles long, key binary, sig array<long>, bands array<long>"),
        "sketch")
    classes = written(sketch.where("key IS NOT NULL").groupBy("key").agg(
        F.first("sig").alias("sig"), F.first("bands").alias("bands"),
        F.min(F.struct("doc_id", "text_hash")).alias("rep")), "classes")

    slots = classes.select("key", F.posexplode("bands").alias("band", "value"))
    shared = slots.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    crowd = written(slots.join(shared, ["band", "value"]), "crowd")
    weight = crowd.groupBy("key").agg(F.sum("n").alias("weight"))
    tops = crowd.join(weight, "key").groupBy("band", "value").agg(F.max(F.struct("weight", "key")).alias("top"))
    members = written(crowd.select("band", "value", "key").join(tops, ["band", "value"]), "members")

    # the sets of all classes that share a bucket with another, from one text of each
    reps = members.select("key").distinct().join(classes.select("key", "rep"), "key").select(
        "key", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_hash").alias("rep_hash"))
    texts = docs.join(reps,
                      docs.doc_id.eqNullSafe(reps.rep_id) & (docs.text_hash == reps.rep_hash)).select("key", "text")
    sets = written(texts.mapInArrow(_sets(shingle), "key binary, set binary").dropDuplicates(["key"]), "sets")

    limit = percent / 100 - MARGIN
    sigs = classes.select("key", "sig")

    def alike(pairs: DataFrame) -> DataFrame:
        """Distinct pairs (a, b) that pass the estimate, confirmed on the full sets."""
        near = (pairs.join(sigs.select(F.col("key").alias("a"), F.col("sig").alias("x")), "a")
                .join(sigs.select(F.col("key").alias("b"), F.col("sig").alias("y")), "b")
                .where(estimate("x", "y") >= limit).select("a", "b"))
        return _confirmed(near, sets, percent)

    centres = members.where(F.col("top.key") != F.col("key"))
    best = centres.groupBy("key").agg(F.max("top").alias("top")).select(F.col("top.key").alias("a"), F.col("key").alias("b"))
    links = written(alike(best), "first")
    roots = written(components(links), "roots")
    other = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    own = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    apart = (centres.select(F.col("top.key").alias("a"), F.col("key").alias("b")).distinct()
             .join(other, "a", "left").join(own, "b", "left")
             .where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b"))
    links = links.unionByName(written(alike(apart), "second"))
    roots = written(components(links), "roots")

    placed = (members.join(roots.withColumnRenamed("node", "key"), "key", "left")
              .withColumn("root", F.coalesce("root", "key")))
    mixed = (placed.groupBy("band", "value").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
             .where("lo <> hi").select("band", "value"))
    open_ = placed.select("band", "value", "key", "root").join(mixed, ["band", "value"])
    fine = written(sets.join(open_.select("key").distinct(), "key").select("key", "set").mapInArrow(_fine, "key binary, fine array<long>"), "fine")
    open_ = written(open_.join(classes.select("key", "sig", "bands"), "key").join(fine, "key"), "open")
    side = lambda **names: open_.select("band", "value", *[F.col(v).alias(k) for k, v in names.items()])
    pairs = side(a="key", ra="root", x="sig", fx="fine", bx="bands").join(side(b="key", rb="root", y="sig", fy="fine", by="bands"), ["band", "value"])
    first_shared = F.array_position(F.zip_with("bx", "by", lambda p, q: p == q), True) == F.col("band") + 1
    rest = written(pairs.where((F.col("ra") < F.col("rb")) & (estimate("x", "y") >= limit) & first_shared
                               & (fine_estimate("fx", "fy") >= percent / 100 - FINE_MARGIN)).select("a", "b"), "rest")
    links = links.unionByName(written(_confirmed(rest, sets, percent), "third"))

    final = components(links).withColumnRenamed("node", "key")
    roots_of = sketch.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("least")).join(final, "key", "left")
    roots_of = roots_of.withColumn("root", F.coalesce("root", "key"))
    named = roots_of.groupBy("root").agg(F.min("least").alias("component_id"))
    # a component may hold a third of all classes, a class a third of all rows
    by_class = join_each(roots_of, named, "root", ["key"]).select("key", "component_id")
    return (join_each(sketch.select("doc_id", "text_hash", "n_shingles", "key"), by_class, "key", ["doc_id", "text_hash"])
            .select("doc_id", "text_hash", "n_shingles",
                    F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                    F.when(F.col("n_shingles") == 0, F.lit(True)).otherwise(
                        F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())).alias("kept"),
                    F.hex("key").alias("class_key")))


def without_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, that ``near_duplicates`` keeps: of each group
    the document with the least id."""
    kept = near_duplicates(docs, shingle=shingle, percent=percent).where("kept").select("doc_id", "text_hash").distinct()
    rows = boxed(docs).withColumn("hash", F.xxhash64(F.col("row.text").cast("string")))
    same = F.col("row.doc_id").cast("long").eqNullSafe(kept.doc_id) & (F.col("hash") == kept.text_hash)
    return rows.join(kept, same, "left_semi").select(*unboxed(docs.columns))
