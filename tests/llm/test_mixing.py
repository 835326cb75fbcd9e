import random
import re
from collections import defaultdict

import numpy as np
import pytest

from corpusframe.llm import mixing
from llm.conftest import DOCS, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_targets(size):
    """{source: words} -> {source: target}, the rule word by word."""
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    target, left, free = {}, float(sum(size.values())), set(order)
    while free:
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        full = {s for s in free if share[s] > 3 * size[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = 3.0 * size[s]
            left -= target[s]
        free -= full
    return target


def sample(n=1500):
    rng = random.Random(8)
    names = ["b", "a", "é", "Z", None, "zz", "tiny"]
    rows = [(i, rng.choice([" ", "\n"]).join(["w"] * int(rng.expovariate(1 / 60))), "en", rng.choices(names, [30, 5, 9, 20, 8, 12, 1])[0], 0) for i in range(n)]
    return rows + [(n, None, "en", "a", 0), (n + 1, "", "en", "none", 0), (n + 2, "x " * 300, "en", "b", 0), (5, rows[5][1], "en", rows[5][3], 0)]


def check(found, rows):
    size = defaultdict(int)
    for _, text, _, source, _ in rows:
        size[source] += len(WORD.findall(text or ""))
    want, taken = slow_targets(size), defaultdict(int)
    assert sorted((r.doc_id, r.size) for r in found) == sorted((i, len(WORD.findall(t or ""))) for i, t, *_ in rows)
    for r in found:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9)
        assert r.taken == r.size * r.copies and r.copies <= 3
        times = want[r.source] / size[r.source] if size[r.source] else 0
        assert times - 1 < r.copies < times + 1 or r.copies == round(times)
        taken[r.source] += r.taken
    return want, taken


@pytest.mark.parametrize("chunk,fan_in", [(10_000, 1_000), (20, 3)])
def test_targets_and_words_taken(spark, monkeypatch, chunk, fan_in):
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    monkeypatch.setattr(mixing, "FAN_IN", fan_in)
    rows = sample()
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as size", "2 as part", "3 as chunk", "4 as s")
    found = mixing.mix_sources(docs).collect()
    want, taken = check(found, rows)
    longest = max(r.size for r in found)
    for source, words in want.items():
        assert abs(taken[source] - words) <= longest
    assert sum(taken.values()) == pytest.approx(sum(want.values()), rel=0.02)
    again = mixing.mix_sources(docs.repartition(7, "n_chars")).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in found)


def test_settle_keeps_words_and_expectations():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 500, 40)
    part = rng.uniform(0, 1, 40)
    ids = np.arange(40)
    total = np.zeros(40)
    for salt in range(2000):
        out = mixing.settle(ids, size, part, salt)
        assert ((out > 0) & (out < 1)).sum() <= 1
        assert (out * size).sum() == pytest.approx((part * size).sum())
        total += out
    assert np.abs(total / 2000 - part).max() < 0.05


def test_edges(spark):
    docs = documents(spark, ["a b", "a b", None, "", "c"], [1, 1, None, 2, 3])
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    kept = mixing.mixed(docs)
    assert kept.columns == [*docs.columns, "copies"]
    assert all(r.copies >= 1 for r in kept.collect())
    empty = mixing.mix_sources(documents(spark, [None, ""])).collect()
    assert [(r.target, r.taken) for r in empty] == [(0.0, 0)] * 2
