"""The prefix trie of conversations, rolled up in depth bands.

A node of depth d is a distinct sequence of first d turns, the root the empty one.  It
is known by its depth and a 128-bit hash: two sums, 64 bits each by exclusive or, of
the digests of (place, turn).  So the prefixes of a conversation of any length come from
running sums over slices of it, and a conversation that holds a third of all rows is
dealt over tasks like the rest.

Sums over subtrees: depths fall into bands of ``BAND``.  A node's values go to its
ancestors within its band only; the top node of a band (its band root) stands for all
below it.  Band roots form a tree of their own, ``BAND`` times as shallow, whose totals
come by the same rule; a completed total then goes to the ancestors in the band above.
So a value is copied at most ``BAND`` times and there are log_BAND(depth) rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm._shared import dropped, word_count, written

BAND = 16
SHARED, HEADS = 20, 4   # conversations of one score share a head of up to HEADS - 1 turns
HOT_SHARE, HOT_LEAST = 1000, 1000  # a parent of more than a thousandth of all nodes, and of 1,000: there are under 1,000 of these
CHUNK = 4096            # ids that are written as one piece of text


def _long(digest: Column, at: int) -> Column:
    """64 bits of a hex digest as a long."""
    part = lambda i: F.conv(F.substring(digest, at + i, 8), 16, 10).cast("long")
    return F.shiftleft(part(0), 32).bitwiseOR(part(8))


def _running(over: Window) -> Window:
    return over.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def turns(conversations: DataFrame) -> DataFrame:
    """(conv, turn, digest, words): narrow rows; texts go no further than this."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), word_count(text).alias("words"))


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv, depth, a, b, words, pa, pb, last) of every prefix of every rebuilt conversation,
    (conv, length) of all), from ``turns``.

    Conversation c takes the first h turns of c - c % 20, then its own after its first h;
    h = crc32(c) % 4.  Turns go by number, null first, those of one number by digest.
    Rows are dealt into ranges of (conv, turn, digest); what a conversation's earlier
    ranges hold reaches its rows as one row per range.
    """
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    rows = written(rows.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()), "trie-turns")
    here = Window.partitionBy("conv", "part").orderBy(*order)
    ranks = rows.withColumn("rank", F.row_number().over(here))
    # heads: the first turns of the conversations that others begin with
    early = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", "digest", "words")
    heads = (ranks.where((F.col("conv") % SHARED == 0) & (F.col("rank") < HEADS)).groupBy(F.col("conv").alias("base"))
             .agg(F.slice(F.array_sort(F.collect_list(early)), 1, HEADS - 1).alias("head")))
    parts = rows.groupBy("conv", "part").agg(F.count("*").alias("n"))
    convs = parts.groupBy("conv").agg(F.sum("n").alias("n"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).cast("int")
    convs = convs.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % SHARED).alias("base"))
    convs = convs.join(heads, "base", "left").select(
        "conv", "h", F.slice(F.coalesce("head", F.array().cast("array<struct<numbered:boolean,turn:bigint,digest:string,words:bigint>>")),
                             F.lit(1), F.col("h")).alias("head"), "n")
    convs = written(convs.select("conv", "h", "head", F.size("head").cast("long").alias("m"),
                                 (F.size("head") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).cast("long").alias("length")), "trie-convs")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).join(
        convs.select("conv", "h", "m", "length"), "conv").select("conv", "part", "start", "h", "m", "length")
    # own turns at their new depths (1 is the first turn's), with the exclusive or of a slice's digests so far
    own = ranks.join(starts, ["conv", "part"])
    place = F.col("start") + F.col("rank") - 1
    own = own.where(place >= F.col("h")).select("conv", "part", (F.col("m") + place - F.col("h") + 1).alias("depth"), "digest", "words", "length")
    own = _marked(own)
    by = Window.partitionBy("conv", "part").orderBy("depth")
    own = own.withColumns({"sa": F.bit_xor("ma").over(_running(by)), "sb": F.bit_xor("mb").over(_running(by))})
    head = _marked(convs.select("conv", "length", F.posexplode("head").alias("at", "x")).select(
        "conv", F.lit(-1).alias("part"), (F.col("at") + 1).cast("long").alias("depth"), "x.digest", "x.words", "length"))
    first = Window.partitionBy("conv").orderBy("depth")  # three rows at most
    head = head.withColumns({"sa": F.bit_xor("ma").over(_running(first)), "sb": F.bit_xor("mb").over(_running(first))})
    # what the slices before, head included, add up to: a row per conversation and range
    slices = (own.select("conv", "part", "ma", "mb").unionByName(head.select("conv", "part", "ma", "mb"))
              .groupBy("conv", "part").agg(F.bit_xor("ma").alias("xa"), F.bit_xor("mb").alias("xb")))
    slices = slices.select("conv", "part", F.coalesce(F.bit_xor("xa").over(before), F.lit(0)).alias("xa"), F.coalesce(F.bit_xor("xb").over(before), F.lit(0)).alias("xb"))
    zero = F.lit(0).cast("long")
    out = own.join(slices, ["conv", "part"]).unionByName(head.withColumns({"xa": zero, "xb": zero}))
    a, b = F.col("sa").bitwiseXOR(F.col("xa")), F.col("sb").bitwiseXOR(F.col("xb"))
    out = out.select("conv", "depth", a.alias("a"), b.alias("b"), "words", a.bitwiseXOR(F.col("ma")).alias("pa"), b.bitwiseXOR(F.col("mb")).alias("pb"),
                     (F.col("depth") == F.col("length")).alias("last"))
    out = out.unionByName(convs.select("conv", zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("words"),
                                       F.lit(None).cast("long").alias("pa"), F.lit(None).cast("long").alias("pb"), (F.col("length") == 0).alias("last")))
    out = written(out, "trie-prefixes")
    dropped(rows)
    return out, convs


def _marked(rows: DataFrame) -> DataFrame:
    """``ma`` and ``mb``: 64 bits each of the digest of (depth, turn)."""
    mark = F.sha2(F.concat_ws(":", F.col("depth").cast("string"), F.col("digest")).cast("binary"), 256)
    return rows.withColumn("mark", mark).withColumns({"ma": _long(F.col("mark"), 1), "mb": _long(F.col("mark"), 17)}).drop("mark")


def lines(prefixes: DataFrame) -> DataFrame:
    """Prefixes (conv, pos, k, ...) with ``band`` and ``line``: the nodes from the band's root to the row's own.

    A band root also ends the line of the band above: such rows are ``tail`` and their
    line holds that whole band without the root itself.
    """
    band = F.floor(F.col("pos") / BAND).cast("long")
    tail = (F.col("pos") % BAND == 0) & (F.col("pos") > 0)
    rows = prefixes.select("*", F.explode(F.when(tail, F.array(band, band - 1)).otherwise(F.array(band))).alias("band"))
    over = Window.partitionBy("conv", "band").orderBy("pos")
    rows = rows.withColumns({"line": F.collect_list("k").over(_running(over)), "tail": F.col("band") < band})  # BAND + 1 nodes at most
    return rows.withColumn("line", F.when(F.col("tail"), F.slice("line", 1, BAND)).otherwise(F.col("line")))


def subtree_sums(prefixes: DataFrame, own: DataFrame, values: list[str], deepest: int, found: DataFrame | None = None) -> DataFrame:
    """(k, values): sums over the subtree of every node, from ``own`` (k, values).

    ``prefixes`` (conv, pos, k) holds every node under its depth; ``found`` its distinct
    (k, pos, tail, line) where these are known.
    """
    if found is None:
        found = written(lines(prefixes).groupBy("k", "tail").agg(F.first("pos").alias("pos"), F.first("line").alias("line")), "trie-lines")
    nodes = found.where(~F.col("tail")).select("k", "line").join(own, "k")
    give = nodes.select(F.explode("line").alias("k"), *values)
    if deepest >= BAND:
        # band roots: what their own band holds, then the sums over the tree of band roots
        roots = written(nodes.groupBy(F.col("line")[0].alias("k")).agg(*[F.sum(v).alias(v) for v in values]), "trie-roots")
        above = prefixes.where(F.col("pos") % BAND == 0).select("conv", (F.col("pos") / BAND).cast("long").alias("pos"), "k")
        totals = subtree_sums(above, roots, values, deepest // BAND)
        tails = found.where("tail").select("k", "line").join(totals, "k")
        give = give.unionByName(tails.select(F.explode("line").alias("k"), *values))
    return written(give.groupBy("k").agg(*[F.sum(v).alias(v) for v in values]), "trie-sums")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, first, text) of runs of up to CHUNK ids of one node, from rows sorted by (k, conv)."""
    rows: list[tuple] = []
    node, held = None, []

    def close() -> None:
        if held:
            rows.append((*node, held[0], ",".join(map(str, held))))
            held.clear()

    def batch_of() -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.string()]
        out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["depth", "a", "b", "first", "text"])
        rows.clear()
        return out

    for batch in batches:
        for *k, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if k != node or len(held) == CHUNK:
                close()
                node = k
            held.append(conv)
            if len(rows) >= 10_000:
                yield batch_of()
    close()
    if rows:
        yield batch_of()


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, sha) from chunks sorted by (k, first): one digest is held at a time."""
    rows: list[tuple] = []
    node, sha = None, None

    def batch_of() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int64()] * 3 + [pa.string()])],
                                         names=["depth", "a", "b", "ends_sha256"])
        rows.clear()
        return out

    for batch in batches:
        for *k, _, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if k == node:
                sha.update(b"," + text.encode())
                continue
            if sha is not None:
                rows.append((*node, sha.hexdigest()))
            node, sha = k, hashlib.sha256(text.encode())
            if len(rows) >= 10_000:
                yield batch_of()
    if sha is not None:
        rows.append((*node, sha.hexdigest()))
    if rows:
        yield batch_of()


def ends(prefixes: DataFrame) -> DataFrame:
    """(k, ends_sha256) of the nodes where conversations end.

    A digest runs over its ids in order, so a node's ids pass one task, as pieces of
    thousands that other tasks have sorted and written out, and are never held together.
    """
    key = ["depth", "a", "b"]
    last = prefixes.where("last").select(*key, "conv")
    pieces = (last.repartitionByRange(*key, "conv").sortWithinPartitions(*key, "conv")
              .mapInArrow(_chunks, "depth long, a long, b long, first long, text string"))
    done = pieces.repartition(*key).sortWithinPartitions(*key, "first").mapInArrow(_ends, "depth long, a long, b long, ends_sha256 string")
    return done.select(F.struct(*key).alias("k"), "ends_sha256")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    Rows without a conv_id belong to no conversation.  Null roles and texts are empty;
    turns of one number go by the digest of role and text; repeated rows are turns of
    their own.  A conversation without turns left is a member of the root alone; no
    conversations, no nodes.  Other columns are ignored.
    """
    prefixes, _ = rebuilt(written(turns(conversations), "trie-digests"))  # the ranges are sampled from it: texts are read once
    k, parent = F.struct("depth", "a", "b"), F.struct((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    seq = prefixes.select("conv", F.col("depth").alias("pos"), k.alias("k"), parent.alias("parent"), "words")
    found = written(lines(seq).groupBy("k", "tail").agg(
        F.first("pos").alias("pos"), F.first("line").alias("line"), F.first("parent").alias("parent"), F.max("words").alias("words"),
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")), "trie-nodes")
    nodes = found.where(~F.col("tail")).select("k", "pos", "parent", "words", "conv_id", "n_convs")
    children = nodes.where("pos > 0").groupBy(F.col("parent").alias("k")).agg(F.count("*").alias("n_children"))
    nodes = written(nodes.join(children, "k", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "trie-children")
    own = nodes.select("k", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    size = nodes.agg(F.count("*").alias("n"), F.max("pos").alias("deepest")).first()
    sums = subtree_sums(seq.select("conv", "pos", "k"), own, ["n_leaves", "saved_tokens"], size["deepest"] or 0, found)
    # parents of very many nodes are few and broadcast, all others are joined by their key
    many = F.col("n_children") > max(HOT_LEAST, size["n"] // HOT_SHARE)
    up = nodes.select(F.col("k").alias("parent"), F.col("conv_id").alias("parent_conv_id"), many.alias("many"))
    hot = F.broadcast(up.where("many").select("parent", F.col("parent_conv_id").alias("hot_conv_id")))
    below = nodes.join(hot, "parent", "left")
    cold = below.where(F.col("hot_conv_id").isNull()).join(up.where("NOT many").select("parent", "parent_conv_id"), "parent", "left")
    warm = below.where(F.col("hot_conv_id").isNotNull()).withColumn("parent_conv_id", F.col("hot_conv_id"))
    named = cold.unionByName(warm).select("k", "pos", "conv_id", "parent_conv_id", "n_convs", "n_children")
    return named.join(sums, "k").join(ends(prefixes), "k", "left").select(
        "conv_id", F.col("pos").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
