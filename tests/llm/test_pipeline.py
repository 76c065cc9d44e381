"""The pipeline's stages in order, and what each must do to its own input."""

import corpus_pipeline
from pyspark.sql import functions as F


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "near_dedup", "mixing", "packing"]
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert sorted(out.columns) == sorted(columns)
        path = corpus_pipeline.save(out, "test-stage")
        n = path.count()
        if name in ("quality_classifier", "near_dedup"):
            assert 0 < n <= rows
        if name == "line_dedup":
            assert n == rows
        docs, rows = path.select(*columns), n
    pieces = corpus_pipeline.packing_stage(spark, docs, sf)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert pieces.filter("start = 0").count() == docs.count()


def test_clean_documents_stay(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    kept = corpus_pipeline.quality_stage(spark, docs, sf)
    clean = labels.filter("quality = 1 and toxic = 0").join(docs, "doc_id").select("doc_id")
    assert clean.join(kept, "doc_id", "left_anti").count() == 0
    gone = corpus_pipeline.near_dedup_stage(spark, docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 10**6)), sf)
    assert gone.filter("doc_id >= 1000000 and length(trim(text)) > 0").count() == 0
