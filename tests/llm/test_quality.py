import random

import numpy as np
import pyarrow as pa
import pytest

from corpusframe.llm import quality
from corpusframe.llm.tokens import NOT_SPACE, chunked
from llm.conftest import documents

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in quality.op3_attention_quality(spark, SF).collect()}
    labels = [r for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if got[r.doc_id].held_out]
    right = [got[r.doc_id].predicted == r.quality for r in labels]
    assert len(right) > 50 and np.mean(right) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    again = {r.doc_id: r.score for r in quality.op3_attention_quality(spark, SF).collect()}
    assert all(again[i] == pytest.approx(r.score, abs=1e-9) for i, r in got.items())


def slow_forward(model, x):
    x = (x - model.mean) / model.scale
    w = model.weights
    e = [np.tanh(v @ w["E"] + w["e"]) for v in x]
    raw = [float((np.tanh(v @ w["T"]) / (1 + np.exp(-(v @ w["G"])))) @ w["a"]) for v in e]
    part = np.exp(raw) / np.sum(np.exp(raw))
    return 1 / (1 + np.exp(-(sum(p * v for p, v in zip(part, e)) @ w["c"] + w["d"][0])))


def test_attention_equals_the_formula_and_one_passage_decides():
    rng = np.random.default_rng(0)
    bags, label = [], []
    for k in range(120):
        bag = rng.normal(0, 1, (rng.integers(1, 6), 5))
        bag[:, 0] = 0
        if k % 2:
            bag[rng.integers(len(bag)), 0] = 4
        bags.append(bag)
        label.append(k % 2)
    first = np.concatenate(([0], np.cumsum([len(b) for b in bags])))
    model = quality.train(np.concatenate(bags), first, np.array(label, float))
    scores = model.score(np.concatenate(bags), first)
    assert np.mean((scores > 0.5) == np.array(label)) > 0.95
    assert scores == pytest.approx([slow_forward(model, b) for b in bags])


def test_passages_are_encoded_alone():
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["Aa", "b!", "é", "7"], k=n)) for n in (0, 1, 128, 129, 400)]
    _, _, together = next(chunked(pa.array([None, *texts])))
    x, first = quality.encode(together)
    assert np.diff(first).tolist() == [1, 1, 1, 1, 2, 4]
    for t, text in enumerate(texts):
        _, _, alone = next(chunked(pa.array([text]), NOT_SPACE))
        assert quality.encode(alone)[0] == pytest.approx(x[first[t + 1] : first[t + 2]])


def test_edges(spark):
    docs = documents(spark, ["Fine words here.", None, "", "X!! " * 50_000, "Fine words here."], [1, 2, 3, None, 1]).selectExpr("*", "1 as score", "2 as label", "3 as x")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 0, 1), (None, 1, 0), (3, None, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    found = quality.scored(docs, model, out="s").collect()
    assert len(found) == 5 and all(0 <= r.s <= 1 for r in found)
    assert quality.fit(docs, labels.filter("quality = 1")).constant == 1.0
    assert quality.fit(docs, labels.limit(0)).constant == 0.5
    kept = quality.good_documents(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == 5
    assert quality.scored(docs.limit(0), model, out="s").count() == 0
