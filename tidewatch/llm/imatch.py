"""I-Match fingerprints, in DataFrame functions only.

The lexicon is the band of terms whose inverse document frequency over all
documents lies between two bounds.  It is split at random, by the digest of the
term, into sixteen subsets, each at five sampling rates (all, 1/4, ... 1/256).  A
document's fingerprint is, for every subset and rate, a short hash of its sorted
distinct terms there, or a mark where it has none.  An edit changes the subsets
it touches and leaves the others; the rates keep short and long texts comparable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidewatch.llm._shared import lower_az, text_or_empty, written

MIN_IDF, MAX_IDF = 2.5, 6.5   # natural logarithm of documents / documents with the term
SUBSETS, RATES = 16, 5
WIDTH = 4                     # hex digits of a subset's hash
NONE = "-" * WIDTH
CROWDED = 10                  # a rate counts where at most so many of its subsets are occupied
#: A band has at most (mean distinct terms of a document) * exp(MAX_IDF) terms whatever the
#: corpus; up to this many, about 100 bytes each, it is broadcast, beyond it is joined by shuffle.
MAX_BROADCAST = 300_000


def terms(text: Column) -> Column:
    """Distinct lower-case words; may include one empty string, which no lexicon holds."""
    return F.array_distinct(F.split(lower_az(text), r"[\x20\x09-\x0D]+"))


def lexicon(texts: DataFrame) -> DataFrame:
    """(term, subset, rate): the terms of the band, of a table with column ``text``."""
    n = texts.count()
    df = texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(F.lit(float(max(n, 1))) / F.col("df"))
    digest = F.md5("term")
    value = F.conv(F.substring(digest, 2, 2), 16, 10).cast("int")
    rate = sum(((value < F.lit(4 ** k)).cast("int") for k in range(RATES - 1)), F.lit(0))
    return written(df.where((F.col("term") != "") & idf.between(MIN_IDF, MAX_IDF)).select(
        "term", F.conv(F.substring(digest, 1, 1), 16, 10).cast("int").alias("subset"), rate.alias("rate")), "lexicon")


def parts(found: str = "found") -> Column:
    """The hashes of all (rate, subset) pairs from an array of (term, subset, rate), sorted by term."""
    def above(rate: int):
        return lambda x: x["rate"] >= rate

    def joined(of: Column) -> Column:
        """The terms of one subset at each rate."""
        return F.array(*[F.array_join(F.transform(F.filter(of, above(r)) if r else of, lambda x: x["term"]), " ") for r in range(RATES)])

    by_subset = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)),
                                      lambda i: joined(F.filter(F.col(found), lambda x: x["subset"] == i))))
    hashed = F.transform(by_subset, lambda t: F.when(t == "", NONE).otherwise(F.substring(F.md5(t), 1, WIDTH)))
    return hashed


def by_rate(hashed: Column) -> Column:
    """``parts`` in the order of the fingerprint: rate by rate.

    The array is bound to a lambda variable, so it is evaluated once a row; named twice
    as a column, merged projections would evaluate it for every one of its elements.
    """
    return F.element_at(F.transform(F.array(hashed), lambda h: F.transform(
        F.sequence(F.lit(0), F.lit(RATES * SUBSETS - 1)),
        lambda j: F.element_at(h, (F.pmod(j, F.lit(SUBSETS)) * RATES + F.floor(j / SUBSETS) + 1).cast("int")))), 1)


def matches(a: str, b: str) -> Column:
    """Per rate (occupied in either, equal) subsets of two arrays of hashes; null if either is."""
    kinds = F.zip_with(a, b, lambda x, y: F.when(x != y, 1).when(x == NONE, 0).otherwise(2))
    return F.transform(F.sequence(F.lit(0), F.lit(RATES - 1)), lambda r: F.aggregate(
        F.slice(kinds, r * SUBSETS + 1, SUBSETS), F.struct(F.lit(0).alias("occupied"), F.lit(0).alias("equal")),
        lambda n, k: F.struct((n["occupied"] + (k > 0).cast("int")).alias("occupied"), (n["equal"] + (k == 2).cast("int")).alias("equal"))))


def likeness(same_print: Column, found: str) -> Column:
    """Share of equal among occupied subsets, over the rates at which few are occupied
    (over all where none is); 1 for equal fingerprints, 0 for a digest against another."""
    zero = F.struct(*[F.lit(0).alias(c) for c in ("fo", "fe", "o", "e")])
    total = F.aggregate(F.col(found), zero, lambda n, m: F.struct(
        (n["fo"] + F.when(m["occupied"] <= CROWDED, m["occupied"]).otherwise(0)).alias("fo"),
        (n["fe"] + F.when(m["occupied"] <= CROWDED, m["equal"]).otherwise(0)).alias("fe"),
        (n["o"] + m["occupied"]).alias("o"), (n["e"] + m["equal"]).alias("e")),
        lambda n: F.when(n["fo"] > 0, n["fe"] / n["fo"]).otherwise(F.when(n["o"] > 0, n["e"] / n["o"]).otherwise(0.0)))
    return F.when(same_print, 1.0).otherwise(F.coalesce(total, F.lit(0.0))).cast("double")


def successors(docs: DataFrame) -> DataFrame:
    """(a, b, doc_id, n_chars, next_a, next_b) of every distinct row, from columns a, b,
    doc_id, n_chars: the next row by (doc_id, null last, b), after the last the first.

    Ids are dealt into ranges; only the first row of each range, as many rows as
    there are partitions, meet in one task.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.col("b").asc()]
    ids = written(docs.select("a", "b", "doc_id", "n_chars").distinct().repartitionByRange(*order)
                  .withColumn("range", F.spark_partition_id()), "ranges")
    here = Window.partitionBy("range").orderBy(*order)
    key = F.struct("a", "b")
    rows = ids.withColumns({"next": F.lead(key).over(here), "place": F.row_number().over(here)})
    firsts = ids.groupBy("range").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "b", "a")).alias("x"))
    firsts = firsts.select("range", F.struct("x.a", "x.b").alias("first"))
    over = Window.orderBy("range")
    heads = firsts.select("range", F.coalesce(F.lead("first").over(over), F.first("first").over(over)).alias("head"))
    nxt = rows.join(heads, "range").withColumn("next", F.coalesce("next", "head"))
    return written(nxt.select("a", "b", "doc_id", "n_chars", F.col("next.a").alias("next_a"), F.col("next.b").alias("next_b")), "successors")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next).

    The edited text has the last quarter of the code points replaced by the first as
    many, or all, of the next document by ascending id.  A null text counts as empty.
    Null ids come last, rows of one id in the order of a hash of their text; equal
    rows count as one in that order and come out as often as they are.  A single
    document is its own next.  Other columns are ignored; no rows, no result.
    """
    text = text_or_empty(text_col)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    base = base.withColumns({"a": F.coalesce("doc_id", F.lit(0)).cast("long"), "b": F.xxhash64("text", F.isnull("doc_id"))})
    words = lexicon(base.select("text"))
    if words.count() <= MAX_BROADCAST:
        words = F.broadcast(words)
    order = successors(base.withColumn("n_chars", F.length("text")))
    # each row's cut, and that of the row before it, which asks for its first characters
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    before = order.select(F.col("next_a").alias("a"), F.col("next_b").alias("b"), F.col("a").alias("to_a"),
                          F.col("b").alias("to_b"), cut.alias("ask"))
    placed = order.select("a", "b", "n_chars", cut.alias("cut")).join(before, ["a", "b"])
    placed = written(placed, "placed")
    # repeated rows count in the lexicon and come back at the end; between, each text is worked on once
    whole = base.select("a", "b", "text").dropDuplicates(["a", "b"]).join(placed, ["a", "b"])
    patch = whole.select(F.col("to_a").alias("a"), F.col("to_b").alias("b"), F.expr("left(text, ask)").alias("patch"))
    edited = whole.join(patch, ["a", "b"]).select(
        "a", "b", "n_chars", "text", F.expr("concat(left(text, CAST(n_chars AS INT) - cut), patch)").alias("edited"))
    both = edited.select("a", "b", F.inline(F.array(F.struct(F.lit(0).alias("v"), F.col("text").alias("t")),
                                                    F.struct(F.lit(1).alias("v"), F.col("edited").alias("t")))))
    # rows of one text stay in the task that read it: no shuffle of terms
    found = (both.select("a", "b", "v", F.explode(terms(F.col("t"))).alias("term")).join(words, "term")
             .groupBy("a", "b", "v").agg(F.sort_array(F.collect_set(F.struct("term", "subset", "rate"))).alias("found")))
    prints = found.select("a", "b", "v", by_rate(parts()).alias("p")).groupBy("a", "b").agg(
        F.max(F.when(F.col("v") == 0, F.col("p"))).alias("p0"), F.max(F.when(F.col("v") == 1, F.col("p"))).alias("p1"))
    shas = edited.select("a", "b", F.md5("text").alias("m0"), F.md5("edited").alias("m1"),
                         F.sha2("edited", 256).alias("edited_sha256"))
    whole_print = lambda p, m: F.coalesce(F.array_join(p, ""), F.concat(F.lit("="), F.col(m)))
    done = written(shas.join(prints, ["a", "b"], "left").select(
        "a", "b", "edited_sha256", "p0", whole_print("p0", "m0").alias("fingerprint"), whole_print("p1", "m1").alias("edited_fingerprint"),
        matches("p0", "p1").alias("with_edited")), "prints")
    nexts = done.select(F.col("a").alias("next_a"), F.col("b").alias("next_b"), F.col("fingerprint").alias("next_print"), F.col("p0").alias("q0"))
    rows = done.join(order, ["a", "b"]).join(nexts, ["next_a", "next_b"]).withColumn("with_next", matches("p0", "q0"))
    rows = rows.select(
        "a", "b", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint") == F.col("edited_fingerprint"), "with_edited").alias("near_edited"),
        likeness(F.col("fingerprint") == F.col("next_print"), "with_next").alias("near_next"))
    return (base.select("doc_id", "a", "b").join(rows, ["a", "b"])
            .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"))
