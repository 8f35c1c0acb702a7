"""The pipeline's stages, and every query beside its SQL."""

from __future__ import annotations

import pytest

import corpus_pipeline

from check_oracles import compare
from tripmetrics.llm.common import kept, unused
from tripmetrics.llm.queries import ORACLES, QUERIES

from .conftest import SF


@pytest.mark.parametrize("name", ORACLES)
def test_query_agrees_with_sql(spark, name):
    ok, note = compare(spark, SF, name, ORACLES[name])
    assert ok, note


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_stages_keep_the_columns_and_the_decisions(spark):
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = kept(stage(spark, docs, path), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, path)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_stages_on_edges(spark, edge, nothing):
    for docs in (edge, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = kept(stage(spark, docs, SF), name)
            assert docs.columns == edge.columns, name
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()


def test_run_is_the_stages_in_order(spark):
    found = corpus_pipeline.run(spark, SF)
    assert "sequence_id" in found.columns and found.count() > 0


def test_unused_names(spark):
    df = spark.createDataFrame([(1, 2)], "_key int, __KEY int")
    assert unused(df, "_key") == "___key"
