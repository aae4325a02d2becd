"""The registered queries and the pipeline on the smallest tables."""

import pytest
from compare import connect, differences
from conftest import SF_DIR

import corpus_pipeline
from closepass.llm import decontamination, near_duplicates, repeated_spans, secrets
from closepass.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"op1_inverted_multi_index", "op13_minimum_cut_text"}))
def test_one_row_or_more_per_document(spark, name):
    docs = {r[0] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()}
    assert {r.doc_id for r in QUERIES[name](spark, SF_DIR).collect()} == docs


def test_repeats_match_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    got = QUERIES["op9_suffix_dedup"](spark, SF_DIR).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == repeated_spans.brute_force([r.text for r in rows])


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns
        docs = spark.createDataFrame(kept.collect(), docs.schema)
    classes = near_duplicates.near_duplicates(docs).collect()
    assert all(r.doc_id == r.class_id for r in classes)
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert decontamination.contamination(docs, items).where("n_hit > 0").count() == 0
    assert not any(secrets.spans(r.text or "") for r in docs.collect())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert pieces.select("doc_id").distinct().count() == docs.count()
