"""Registered queries against DuckDB, and the pipeline's stages."""

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.oracle import compare, connect
from turnout.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), SQL[name]) is None


def test_pipeline(spark):
    assert {"pipeline", *QUERIES} <= set(contract.queries())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    result = corpus_pipeline.run(spark, SF)
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    kept = {r.doc_id for r in result.select("doc_id").distinct().collect()}
    assert 0.8 * docs.count() <= len(kept) <= docs.count()
