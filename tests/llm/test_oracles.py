"""Every query of the subpackage that SQL can express, on the smallest tables."""

import pytest
from oracle_llm import TABLES, difference

import corpus_pipeline
from lakefold.llm.oracle import ORACLE
from lakefold.llm.registered import QUERIES

SF_DIR = "/root/testdata/sf0.001"
PATHS = {t: f"{SF_DIR}/{t}.parquet" for t in TABLES}


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), ORACLE[name], PATHS) is None


def test_pipeline_equals_sql(spark):
    assert difference(corpus_pipeline.run(spark, SF_DIR), corpus_pipeline.ORACLE_SQL, PATHS) is None


def test_every_operator_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in names}
    assert "pipeline" in names


def test_pipeline_stages_keep_the_columns(spark):
    docs = spark.read.parquet(PATHS["documents"])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns
        assert set(r[0] for r in kept.select("doc_id").collect()) <= set(r[0] for r in docs.select("doc_id").collect())
