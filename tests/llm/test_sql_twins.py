"""Queries with SQL, and the pipeline, on whole tables; and what the pipeline promises."""

import pytest

import corpus_pipeline
import oracle
from sluiceway.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    assert oracle.compare([tuple(r) for r in df.collect()], df.columns, queries.ORACLE_SQL[name], con) is None


def test_pipeline_matches_sql(spark, con):
    df = corpus_pipeline.run(spark, SF)
    assert oracle.compare([tuple(r) for r in df.collect()], df.columns, corpus_pipeline.ORACLE_SQL, con) is None


def test_stages_keep_the_columns(make_docs, spark):
    clashing = ["row", "id", "own", "copy", "copies", "digest", "gone_id", "_quality", "plan_id", "key", "n_tokens", "bucket_length"]
    rows = [(1, " ".join(f"the word{i}" for i in range(60)), "en", "a"), (2, None, None, None)]
    docs = make_docs(rows, clashing)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns, name
        assert [tuple(r) for r in kept.where("doc_id = 1").collect()] == [tuple(docs.first())], name
    assert sorted(r["doc_id"] for r in corpus_pipeline.packing_stage(spark, docs, SF).collect()) == [1, 2]


def test_stages_take_an_empty_table(make_docs, spark):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, make_docs([]), SF).collect() == [], name
