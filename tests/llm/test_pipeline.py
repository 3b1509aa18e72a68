"""Queries against their SQL, and the pipeline's stages against each other."""
import pytest

import corpus_pipeline
from compare import compare, duck

from ridegrid.llm import common as C
from ridegrid.llm.registry import ORACLE, QUERIES

SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", list(ORACLE))
def test_matches_oracle(spark, con, name):
    ok, message = compare(QUERIES[name](spark, SF01), con, ORACLE[name])
    assert ok, message


def test_pipeline_stages(spark):
    docs = C.table(spark, SF01, "documents")
    judged = {r.doc_id: r.kept for r in QUERIES["op10_quality_rules"](spark, SF01).collect()}
    kept = corpus_pipeline.quality(spark, docs, SF01)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, k in judged.items() if k}
    out = corpus_pipeline.run(spark, SF01).collect()
    ids = [r.doc_id for r in out]
    assert len(ids) == len(set(ids)) and set(ids) <= {i for i, k in judged.items() if k}
    bad = {r.doc_id for r in QUERIES["op4_benchmark_decontamination"](spark, SF01).where("contaminated").collect()}
    assert len(ids) > 0.7 * len(judged) and len(set(ids) & bad) <= 0.1 * len(bad)
