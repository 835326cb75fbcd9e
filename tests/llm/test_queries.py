"""Registered queries against their SQL, and the pipeline against brute force."""

import pytest
from oracle import compare, duck

import __spark_entry__ as entry
import corpus_pipeline
from corpusframe.llm.queries import ORACLES, QUERIES
from llm.test_decontaminate import slow as slow_contamination
from llm.test_lines import slow as slow_lines
from llm.test_simhash import slow_components, slow_fingerprint

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(ORACLES) <= set(QUERIES) <= names


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, duck(SF), name, QUERIES[name], ORACLES[name], SF) is None


def test_pipeline_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = corpus_pipeline.written(stage(spark, docs, SF), name)
        rows = sorted(out.collect(), key=lambda r: r.doc_id)
        assert out.columns == columns + (["copies"] if k == 4 else [])
        if k == 1:
            want = slow_lines([(r.doc_id, r.text) for r in before], 1)
            assert [(r.doc_id, r.text) for r in rows] == sorted((i, t) for i, _, t in want)
        elif k == 2:
            ids = slow_components([(r.doc_id, slow_fingerprint(r.text)) for r in before])
            assert [r.doc_id for r in rows] == sorted(set(ids))
        elif k == 3:
            assert [r.doc_id for r in rows] == [r.doc_id for r in before if not slow_contamination(r.text, bench)[-1]]
        docs, before = out, rows
    again = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, again.collect())) == sorted(map(str, before))
