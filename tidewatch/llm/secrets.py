"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of a path is addressed by the SHA-256 of its content.  The ledger
holds the (blob, rule, rule version) triples that were scanned before; a scan
takes one text of each blob with an unseen triple, finds the spans, records them
and then the triples, and joins the findings of all blobs back to every path
that ever held them; the paths of one blob are dealt over many tasks.  A crash
between the two writes leaves the triples unseen, so the blobs are scanned again
and nothing is lost.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidewatch.llm._shared import boxed, dropped, join_each, text_or_empty, written
from tidewatch.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """Non-overlapping leftmost matches of ``pattern`` whose group ``group`` has
    ``least`` characters or more.  ``hint`` is a cheaper pattern that every text
    with a kept match contains."""
    kind: str
    version: int
    pattern: str
    group: int
    least: int
    hint: str


_KEYWORD = r"(?i:password|passwd|secret|token|api_?key)"
RULES = (
    Rule("assign", 1, rf"({_KEYWORD})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12, rf"{_KEYWORD}[\"']?\x20*[:=]"),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 18, r"AKIA[A-Z0-9]{14}"),
    Rule("hex", 1, r"[0-9a-f]+", 0, 16, r"[0-9a-f]{16}"),
)


def _found(blobs: DataFrame, rule: Rule) -> DataFrame:
    """(blob, kind, rule_version, start, end) of one rule, in code points.

    The pieces between matches and the matches alternate, so a match starts at
    the summed lengths before it.
    """
    text = F.col("text")
    parts = F.arrays_zip(
        F.transform(F.split(text, rule.pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.length).alias("width"),
        F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), F.length).alias("inner"))
    rows = (blobs.where(F.array_contains("kinds", rule.kind) & text.rlike(rule.hint))
            .select("blob", F.posexplode(parts).alias("i", "p")).where("p.width IS NOT NULL"))
    so_far = Window.partitionBy("blob").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("p.gap") + F.col("p.width")).over(so_far)
    return (rows.select("blob", (end - F.col("p.width")).alias("start"), end.alias("end"), F.col("p.inner").alias("inner"))
            .where(F.col("inner") >= rule.least)
            .select("blob", F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("rule_version"),
                    F.col("start").cast("long"), F.col("end").cast("long")))


TRIPLE = "blob binary, kind string, rule_version int"
FINDING = TRIPLE + ", start long, end long"


def _read(spark: SparkSession, path: str, part: str, schema: str) -> DataFrame:
    """All increments of one part of a ledger; an empty table before the first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{part}")
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(schema).parquet(f"{path}/{part}") if there else spark.createDataFrame([], schema)


def scan_into(versions: DataFrame, ledger: str, path_col: str = "path", text_col: str = "text",
              rules: tuple[Rule, ...] = RULES) -> None:
    """Scan the unseen (blob, rule version) pairs of ``versions`` into the ledger."""
    spark = versions.sparkSession
    v = versions.select(F.col(path_col).alias("path"), text_or_empty(text_col).alias("text"))
    v = v.withColumn("blob", F.unhex(F.sha2("text", 256)))
    wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("rule_version")) for r in rules])
    pairs = v.select("blob").distinct().select("blob", F.inline(wanted))
    unseen = written(pairs.join(_read(spark, ledger, "scanned", TRIPLE), ["blob", "kind", "rule_version"], "left_anti"), "unseen")
    todo = unseen.groupBy("blob").agg(F.collect_set("kind").alias("kinds"))
    # each task keeps one text of a blob before the shuffle, and the texts are written once for all rules
    texts = v.where(text_rlike_any(rules)).groupBy("blob").agg(F.first("text").alias("text"))
    texts = written(texts.join(todo, "blob"), "unseen-texts")
    found = None
    for rule in rules:
        part = _found(texts, rule)
        found = part if found is None else found.unionByName(part)
    found.write.mode("append").parquet(f"{ledger}/findings")
    unseen.select("blob", "kind", "rule_version").write.mode("append").parquet(f"{ledger}/scanned")
    dropped(texts)
    dropped(unseen)


def text_rlike_any(rules: tuple[Rule, ...]) -> Column:
    test = F.lit(False)
    for r in rules:
        test = test | F.col("text").rlike(r.hint)
    return test


def blob_spans(spark: SparkSession, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans) of every blob with a finding of these rule versions, spans as in ``findings``."""
    rank = F.lit(len(rules))
    current = F.lit(False)
    for i, r in enumerate(rules):
        rank = F.when(F.col("kind") == r.kind, i).otherwise(rank)
        current = current | ((F.col("kind") == r.kind) & (F.col("rule_version") == r.version))
    # a scan that was cut short leaves findings that the next one repeats
    known = _read(spark, ledger, "findings", FINDING).where(current).distinct()
    # collected per blob: bounded by the length of one text
    return known.groupBy("blob").agg(F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end"))).alias("spans"))


def findings(versions: DataFrame, ledger: str, path_col: str = "path", text_col: str = "text",
             rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per version: (path, blob, spans), spans an array of (start, rank, kind,
    end) ordered by start, then by the rules' order."""
    v = versions.select(F.col(path_col).alias("path"), F.unhex(F.sha2(text_or_empty(text_col), 256)).alias("blob"))
    return join_each(v, blob_spans(versions.sparkSession, ledger, rules), "blob", ["path"]).select(
        "path", "blob", F.coalesce("spans", F.array().cast("array<struct<start:long,rank:int,kind:string,end:long>>")).alias("spans"))


def scan(versions: DataFrame, path_col: str = "path", text_col: str = "text", ledger: str | None = None,
         rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Update the ledger (a new one under the shared folder by default) and return
    the findings of every version.

    A null text counts as empty and has no spans.  Null and repeated paths are
    returned row by row.  Very long texts are taken whole.  Other columns are ignored.
    An empty table gives an empty result.
    """
    ledger = ledger or scratch_path(versions.sparkSession, "llm-ledger")
    scan_into(versions, ledger, path_col, text_col, rules)
    return findings(versions, ledger, path_col, text_col, rules)


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each span replaced by ``mark``; overlapping spans by one mark."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("done"))
    done = F.aggregate(spans, start, lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(s["start"] >= acc["at"],
               F.concat(acc["done"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark)))
        .otherwise(acc["done"]).alias("done")))
    return F.concat(done["done"], F.substring(text, (done["at"] + 1).cast("int"), F.lit(2**31 - 1)))


def without_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every secret span replaced by a mark and ``n_chars``, where there is
    such a column, set to the new length.  Rows without findings stay as they are."""
    ledger = scratch_path(docs.sparkSession, "llm-ledger")
    scan_into(docs, ledger, id_col, text_col)
    text = F.col("row")[text_col]
    rows = boxed(docs).withColumn("blob", F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)))
    rows = rows.withColumn("id", F.col("row")[id_col])
    rows = join_each(rows, blob_spans(docs.sparkSession, ledger), "blob", ["id"])
    hit = F.col("spans").isNotNull()
    rows = rows.select("row", F.when(hit, redact(text, F.col("spans"))).alias("clean"))
    changed = F.col("clean").isNotNull()
    out = {text_col: F.when(changed, F.col("clean")).otherwise(text),
           "n_chars": F.when(changed, F.length("clean").cast("long")).otherwise(F.col("row")["n_chars"]) if "n_chars" in docs.columns else None}
    return rows.select(*[(out[c] if c in out else F.col("row")[c]).alias(c) for c in docs.columns])
