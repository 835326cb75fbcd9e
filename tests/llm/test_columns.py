"""Stages keep columns that are named like their own, with their values."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusframe.llm import decontaminate, lines, mixing, quality, simhash
from llm.conftest import documents

MODULES = {"quality_classifier": [quality], "line_dedup": [lines], "near_dedup": [simhash], "decontamination": [decontaminate], "mixing": [mixing]}
TEXTS = ["a b c\nsame line here\nand this one", "x y z\nsame line here\nand this one", None, "", "a b c\nsame line here\nand this one", "lonely words " * 30]


def used(modules):
    """Every name in quotes that could be a column of the module's own."""
    source = "".join(Path(m.__file__).read_text() for m in modules)
    own = set(re.findall(r'"(_?[a-z][a-z_0-9]{0,24})"', source)) | {"_in9", "copies"}
    return sorted(own - {"doc_id", "text", "lang", "source", "n_chars"})


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_values_come_back(spark, name, stage):
    own = used(MODULES[name])
    docs = documents(spark, TEXTS, [3, 4, -1, None, 3, 7])
    more = docs.select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce("doc_id", F.lit(0))).alias(c) for c in own])
    sf = "/root/testdata/sf0.001"
    out = stage(spark, more, sf)
    last = ["mix_copies"] if name == "mixing" else []
    assert out.columns == more.columns + last
    rows = out.collect()
    assert all(r[c] == f"{c}:{r.doc_id or 0}" for r in rows for c in own)
    plain = sorted(map(str, (tuple(r) for r in stage(spark, docs, sf).collect())))
    assert sorted(str((*(r[c] for c in docs.columns), *(r[c] for c in last))) for r in rows) == plain


def test_decontamination_tells_minus_one_from_null(spark):
    docs = documents(spark, ["a b", "a b", "c"], [-1, None, 0])
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    found = decontaminate.contamination(docs, items).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.contaminated) for r in found) == [((False, -1), True), ((False, 0), False), ((True, 0), True)]
