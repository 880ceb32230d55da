"""The registered queries: SQL at sf0.001, and the pipeline's stages."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from quayside.llm import queries as q
from quayside.llm.frames import table, written
from tests.oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert set(q.QUERIES) <= set(entry.queries()) and set(q.ORACLES) <= set(entry.oracle_sql())
    assert [n.split("_")[0] for n in q.QUERIES][:10] == [f"op{i}" for i in range(1, 11)]


def test_queries_match_their_sql(spark):
    found = compare(spark, SF, names=list(q.ORACLES), verbose=False)
    assert {k: v[0] for k, v in found.items()} == dict.fromkeys(q.ORACLES, "OK")


@pytest.mark.parametrize("name", ["op1_quality_classifier", "op8_bpe_automaton",
                                  "op9_quality_rules", "op10_license_scans"])
def test_one_row_per_document(spark, name):
    docs = table(spark, SF, "documents")
    out = q.QUERIES[name](spark, SF)
    assert out.count() == docs.count()
    assert out.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns, name
        after = docs.count()
        assert 0 < after <= before, name
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
