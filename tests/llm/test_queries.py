"""Registered corpus queries: oracles, whole tables, and the pipeline."""

import pytest

import corpus_pipeline
from gridloom.llm import near_dup, queries
from gridloom.llm.oracles import ORACLES
from tests.oracle_harness import compare, duck

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    assert compare(queries.QUERIES[name](spark, SMALL).toArrow(), duck(ORACLES[name], SMALL)) == []


#: Queries whose rows are not those of one table.
OWN_ROWS = ("op3_decontamination", "op4_mixing", "op12_collision_search", "op13_filter_audit")


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in OWN_ROWS])
def test_a_row_for_each_row(spark, name):
    table = "pages" if name in ("op5_warc", "op7_html_extraction") else "documents"
    assert queries.QUERIES[name](spark, SMALL).count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()


def test_rows_of_searches_and_audits(spark):
    asked = spark.read.parquet(f"{SMALL}/embeddings.parquet").filter("vec_id % 20 = 0").count()
    assert queries.op12_collision_search(spark, SMALL).count() == 20 * asked
    parts = spark.read.parquet(f"{SMALL}/documents.parquet").selectExpr("coalesce(lang, '')").distinct().count()
    assert queries.op13_filter_audit(spark, SMALL).count() == 120 * 5 * parts


def test_pipeline_matches_its_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    good = corpus_pipeline.STAGES[0][1](spark, docs, SMALL)
    classes = near_dup.classes(good).collect()
    unique = {r.class_id for r in classes}
    clean = {r.doc_id for r in good.collect() if r.doc_id in unique and not any(b in r.text for b in bench)}
    assert {r.doc_id for r in corpus_pipeline.run(spark, SMALL).collect()} == clean
