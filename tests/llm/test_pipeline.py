"""The pipeline's stages against what they promise."""
import corpus_pipeline
from barsight.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_in_a_row(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id for r in docs.collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if i < 4:
            assert out.columns == docs.columns, name
            docs = corpus_pipeline.cut(out)
            assert {r.doc_id for r in docs.select("doc_id").collect()} <= before
        else:
            assert out.count() == docs.count() and out.where("not lossless").count() == 0


def test_awkward_documents_pass_every_stage(spark, awkward, no_documents):
    for rows in (awkward, no_documents):
        docs = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.cut(stage(spark, docs, SF))
            assert docs.columns == rows.columns
        out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert out.where("not lossless").count() == 0
