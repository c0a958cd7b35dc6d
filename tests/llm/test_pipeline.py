import random
import re

from pyspark.sql import functions as F

import corpus_pipeline
from llm_helpers import SF001
from test_toxicity import corpus


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near-duplicates", "secrets", "mixing", "packing"]


def test_run_over_the_small_tables(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = corpus_pipeline.run(spark, SF001).cache()
    assert out.columns[:5] == docs.columns and out.count() > 0
    ids = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in out.select("doc_id").collect()} <= ids
    for r in out.collect():
        assert r.n_tokens == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) + 1 <= r.bound
        assert not re.search(r"AKIA[A-Z0-9]{14}|[0-9a-f]{16}", r.text or "")


def test_each_stage_on_edge_rows_and_on_none(spark, make_docs, edge_rows):
    for rows in (edge_rows, []):
        for name, stage in corpus_pipeline.STAGES:
            docs = make_docs(rows, clash=False)
            out = stage(spark, docs, SF001)
            kept = out.collect()
            assert out.columns[:len(docs.columns)] == docs.columns, name
            if name in ("toxicity", "secrets", "packing"):
                assert len(kept) == len(rows), name  # nothing toxic in them


def test_each_stage_beside_clashing_and_map_columns(spark, make_docs, edge_rows):
    for name, stage in corpus_pipeline.STAGES:
        docs = make_docs(edge_rows).withColumn("meta", F.create_map(F.lit("k"), F.col("source")))
        out = stage(spark, docs, SF001)
        assert out.columns[:len(docs.columns)] == docs.columns, name
        rows = out.collect()
        assert rows and all(r["score"] == "x" and r["meta"] == {"k": r["source"]} for r in rows), name


def test_second_stage_keeps_the_least_of_planted_copies(spark, make_docs):
    rng = random.Random(8)
    base = [f"w{rng.randrange(999)}" for _ in range(200)]
    near = [*base[:100], "other", *base[101:]]
    docs = make_docs([(5, " ".join(base), "en", "s"), (3, " ".join(near), "en", "s"), (9, " ".join(base), "en", "t"),
                      (4, " ".join(reversed(base)), "en", "s")], clash=False)
    assert sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["near-duplicates"](spark, docs, SF001).collect()) == [3, 4]


def test_first_stage_on_ids_without_labels(spark, make_docs, tmp_path):
    rows, labels = corpus(make_docs, spark)
    make_docs(rows, clash=False).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stage = dict(corpus_pipeline.STAGES)["toxicity"]
    new = make_docs([(10**6 + r[0], *r[1:]) for r in rows], clash=False)
    kept = {r.doc_id - 10**6 for r in stage(spark, new, str(tmp_path)).collect()}
    clean = {i for i, _, toxic in labels if not toxic}
    assert len(kept & clean) >= 0.95 * len(clean) and len(kept - clean) <= 0.05 * (len(rows) - len(clean))


def test_last_stage_beside_columns_of_its_names(spark, make_docs, edge_rows, tmp_path):
    names = ("n_tokens", "bucket", "bound", "Batch", "batch_", "slot", "padding", "_pack")
    docs = make_docs(edge_rows).withColumns({c: F.lit("x") for c in names})
    out = dict(corpus_pipeline.STAGES)["packing"](spark, docs, SF001)
    out.write.parquet(f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.columns[:len(docs.columns)] == docs.columns
    assert back.columns[len(docs.columns):] == ["n_tokens_", "bucket_", "bound_", "batch__", "slot_", "padding_"]
    rows = back.collect()
    assert len(rows) == len(edge_rows) and all(r[c] == "x" for r in rows for c in names) and all(r.n_tokens_ >= 1 for r in rows)
