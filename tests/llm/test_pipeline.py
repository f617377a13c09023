"""The pipeline's stages, one after another, against what each should keep."""

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from bayline.llm import decontaminate, minhash_dedup, pii, toxicity

SF001 = "/root/testdata/sf0.01"


def test_stages(spark, odd_docs, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    docs = docs.union(odd_docs.select(F.col("doc_id") + 100_000, *docs.columns[1:]))
    columns, at = docs.columns, {}
    for name, stage in pipeline.STAGES:
        at[name] = docs
        stage(spark, docs, SF001).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        at[f"{name} out"] = docs
        if name != "mix":
            assert docs.columns == columns
    ids = lambda df: sorted((r[0] is None, r[0] or 0) for r in df.select("doc_id").collect())
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    scored = toxicity.score_texts(at["toxicity"], toxicity.fit_toxicity(at["toxicity"], labels))
    assert ids(at["toxicity out"]) == ids(scored.where("score < 0.7"))
    near = minhash_dedup.near_duplicates(at["near_dedup"])
    assert set(ids(at["near_dedup out"])) == set(ids(near.where("coalesce(kept, true)")))
    leaks = decontaminate.find_leaks(at["decontaminate"], bench).select("doc_id").distinct()
    assert ids(at["decontaminate out"]) == ids(at["decontaminate"].join(leaks, "doc_id", "left_anti"))
    assert ids(at["pii out"]) == ids(at["pii"]) and at["pii out"].where("n_chars <> length(text)").count() == 0
    found = pii.find_pii(at["pii out"], pii.train(pii.labelled_sequences(at["pii"])))
    assert found.agg(F.sum(F.expr("n_email + n_ip + n_card + n_phone"))).first()[0] == 0
    assert ids(at["mix out"]) == ids(at["mix"])
    total = at["mix out"].agg(F.sum("size").alias("size"), F.sum("taken").alias("taken")).first()
    assert 0.97 * total.size <= total.taken <= total.size


def test_empty(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF001}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []
