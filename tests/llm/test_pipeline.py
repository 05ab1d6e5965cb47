"""The pipeline over the smallest tables, stage by stage."""

from pyspark.sql import functions as F

import corpus_pipeline
from merchpulse.llm import crf, decontam, neardup, suffixdedup
from merchpulse.llm.tables import written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("clash"))
    labels, bench = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, SF), name)
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        if name == "toxicity":
            gone = {r.doc_id for r in crf.toxicity(docs, labels).where("predicted = 1").collect()}
        elif name == "near_dedup":
            gone = {r.doc_id for r in neardup.near_duplicates(docs).where("not kept").collect()}
        elif name == "passage_dedup":
            gone = set()
            assert suffixdedup.repeats(out).count() == 0 or out.where("n_chars <> length(text)").count() == 0
        else:
            gone = {r.doc_id for r in decontam.contamination(docs, bench).where("n_hit > 0").collect()}
        assert ids == before - gone and (gone or name == "passage_dedup"), name
        assert out.columns == columns
        docs, before = out, ids
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert sorted(r.doc_id for r in packed.collect()) == sorted(before)
