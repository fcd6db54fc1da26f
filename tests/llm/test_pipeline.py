from __future__ import annotations

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
D = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    """Each stage equals what its operator decides on what the stage before it kept."""
    import corpus_pipeline
    from tidemark.llm.exact_dedup import dedup
    from tidemark.llm.near_duplicates import near_groups
    from tidemark.llm.quality_rules import judge

    docs = spark.read.parquet(f"{D}/documents.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality_rules"](spark, docs, D)
    assert ids(good) == ids(judge(docs).where("kept")) and good.columns == docs.columns
    clean = stages["toxicity"](spark, good, D)
    assert set(ids(clean)) < set(ids(good)) and clean.columns == docs.columns
    once = stages["exact_dedup"](spark, clean, D)
    assert ids(once) == ids(dedup(clean).where("kept")) and once.columns == docs.columns
    near = stages["simhash_dedup"](spark, once, D)
    assert ids(near) == ids(near_groups(once).where("doc_id = component_id")) and near.columns == docs.columns
    packed = stages["packing"](spark, near, D)
    assert {r.doc_id for r in packed.collect()} == set(ids(near))


def test_stages_on_odd_rows_and_clashing_columns(spark, docs):
    """Nulls, empty texts, repeated rows and ids, and extra columns called like anything inside the operators."""
    from pyspark.sql import functions as F

    import corpus_pipeline
    from tidemark.llm.exact_dedup import dedup
    from tidemark.llm.near_duplicates import near_groups
    from tidemark.llm.quality_rules import judge

    names = ("_hash", "_digest", "_text", "predicted", "matched", "n_words", "text_hash", "component_id", "keep_id", "kept", "gone_id_0", "GONE_DIGEST_0", "words", "_words", "token")
    docs = docs.select("*", *(F.lit("y").alias(c) for c in names if c not in docs.columns))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, D)
        assert out.columns == docs.columns and out.where("_hash <> 'y' OR score <> 'x'").count() == 0, name
    ids = lambda df: sorted((r.doc_id is not None, r.doc_id or 0) for r in df.select("doc_id").collect())
    stages = dict(corpus_pipeline.STAGES)
    assert ids(stages["quality_rules"](spark, docs, D)) == ids(judge(docs).where("kept"))
    assert ids(stages["exact_dedup"](spark, docs, D)) == ids(dedup(docs).where("kept"))
    assert ids(stages["simhash_dedup"](spark, docs, D)) == ids(near_groups(docs).where("doc_id <=> component_id"))
    packed = stages["packing"](spark, docs, D)
    assert packed.where("start = 0").count() == docs.count()


def test_run_and_empty_input(spark, tmp_path):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, D).count() > 0
    for t in ("documents", "labels"):
        spark.read.parquet(f"{D}/{t}.parquet").where("doc_id < 0").write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
