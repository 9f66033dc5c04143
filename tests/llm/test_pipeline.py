"""The pipeline's stages, each on its own input, and the registered queries."""

import inspect

import corpus_pipeline
import __spark_entry__
from deskmill.llm import near_dedup, pii, quality
from deskmill.llm.queries import CHECKS, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.materialized(stage(spark, docs, SF), name)
        assert out.columns == columns and out.schema == docs.schema
        before, after = ({r.doc_id for r in d.select("doc_id").collect()} for d in (docs, out))
        assert after <= before
        if name == "quality_rules":
            assert after == {r.doc_id for r in quality.quality(docs).filter("kept").collect()}
        if name == "near_dedup":
            assert after == {r.doc_id for r in near_dedup.near_duplicates(docs).filter("kept").collect()}
        if name == "personal_data":
            assert after == before
            assert pii.personal_data(out).filter("n_email + n_ip + n_card + n_phone > 0").count() == 0
            assert out.filter("n_chars <> length(text)").count() == 0
        docs = out
    assert 0 < docs.count() < n
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in last.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_every_operator_has_its_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(CHECKS) <= set(QUERIES)
    names = __spark_entry__.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert [len(inspect.signature(stage).parameters) for _, stage in corpus_pipeline.STAGES] == [3] * 5
