"""The registered queries beside their SQL, and the pipeline."""

import pytest
from llm_cases import folder, shipped  # noqa: F401

import __spark_entry__ as registered
import check_queries
import corpus_pipeline
from docklens.llm import oracle, queries


def test_all_are_registered():
    names = [n.split("_")[0] for n in queries.QUERIES]
    assert sorted(names) == sorted(["pipeline", *(f"op{n}" for n in range(1, 14))])
    assert queries.QUERIES.items() <= registered.queries().items()
    assert oracle.SQL.items() <= registered.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_and_sql(spark, folder, name):
    connection = check_queries.connect(folder)
    assert check_queries.compare(spark, connection, folder, name) == ""


@pytest.mark.parametrize("name", ["op1_toxicity", "op9_pii", "op5_label_propagation"])
def test_one_row_for_each_document(spark, folder, name):
    n = spark.read.parquet(f"{folder}/documents.parquet").count()
    assert queries.QUERIES[name](spark, folder).select("doc_id").distinct().count() == n


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = {r.doc_id for r in docs.collect()}
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        rows = docs.collect()
        kept = {r.doc_id for r in rows}
        assert kept <= before and all(r.n_chars == len(r.text) for r in rows)
        assert (kept == before) == (name == "personal_data")
        before = kept
    packed = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == before
