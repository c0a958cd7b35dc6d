"""From raw documents to packed training batches.

Stages, in order: toxic documents go; of each group of near-duplicates one
document stays; secrets are replaced by a mark; sources are mixed to their target
weights, a document once per draw; documents are packed into batches of like
length.  Every stage works on all that its predecessor kept and returns the columns
of ``documents``; the last adds each row's place, with an underscore behind a name that is taken.  Between stages the rows are
written to the cluster's shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import minhash, mixing, packing, secrets, toxicity
from tidewatch.llm._shared import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half by the classifier fitted on the labelled documents of the
    training folds in ``sf_dir``, whichever documents are given."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group alike at 0.8 or more in five-word shingles."""
    return minhash.without_near_duplicates(docs, shingle=5, percent=80)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secret spans replaced by a mark."""
    return secrets.without_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents once per draw of the mix, dealt by shard and shuffled inside."""
    return mixing.mixture(docs)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their length bucket, batch and slot, under names that ``docs`` does not hold."""
    taken = {c.lower() for c in docs.columns}

    def free(name: str) -> str:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        return name

    out = free("_pack")
    packed = packing.pack(docs, out=out)
    return packed.select(*[F.col(f"`{c}`") for c in docs.columns],
                         *[F.col(out)[c].alias(free(c)) for c in ("n_tokens", "bucket", "bound", "batch", "slot", "padding")])


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]

#: The learned and drawn stages have no SQL form; the tests hold each against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
