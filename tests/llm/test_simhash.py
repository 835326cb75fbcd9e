import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusframe.llm import simhash
from corpusframe.llm.components import components
from llm.conftest import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(items, budget=4):
    """items: [(doc id, fingerprint)] -> id of each item's component, by comparing every two."""
    root = list(range(len(items)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= budget:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(items):
        least[find(i)].append(doc)
    return [min((d for d in least[find(i)] if d is not None), default=None) for i in range(len(items))]


def sample():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdeéß", k=rng.randint(1, 7))) for _ in range(300)]
    texts = []
    for _ in range(40):
        words = rng.choices(vocabulary, k=rng.randint(1, 300))
        for _ in range(rng.choice([1, 1, 4])):
            copy = list(words)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(rng.choice([" ", "\n", " \t"]).join(copy))
    return texts + [None, "", "   ", "one", "ONE", "two words", "a b c d", "A  b\nc d", "x " * 30_000, texts[0], texts[0]]


def test_query_equals_brute_force(spark):
    texts = sample()
    found = simhash.near_duplicates(documents(spark, texts)).collect()
    prints = [slow_fingerprint(t) for t in texts]
    want = dict(enumerate(zip(prints, slow_components(list(enumerate(prints))))))
    assert {r.doc_id: (r._fp % 2**64, r.component_id) for r in found} == want
    assert len(found) == len(texts)


@pytest.mark.parametrize("lead", [1, 2, 3])
def test_trie_join_finds_every_link(spark, monkeypatch, lead):
    rng = np.random.default_rng(lead)
    centres = rng.integers(0, 2**63, 60, dtype=np.uint64)
    values = set()
    for c in centres.tolist():
        for _ in range(12):
            values.add(c ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)))
    values = sorted(values)
    monkeypatch.setattr(simhash, "RUN", {1: 256, 2: 0.01, 3: 0.00001}[lead])
    monkeypatch.setattr(simhash, "SLICE", 300)
    monkeypatch.setattr(simhash, "HOT", 12)
    monkeypatch.setattr(simhash, "PART", 5)
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    links = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "_fp long"))
    for a, b in links.collect():
        assert ((a ^ b) % 2**64).bit_count() <= 64
    root = {r.node: r.root for r in components(links).collect()}
    got = defaultdict(set)
    for v in signed:
        got[root.get(v, v)].add(v)
    want = defaultdict(set)
    for v, c in zip(signed, slow_components([(i, v) for i, v in enumerate(values)])):
        want[c].add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(90)] + [(1000, 1000), (2000, 2001)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 91)}, 2001: 2000}


def test_one_of_each_group_stays(spark):
    docs = documents(spark, ["a b c d e f", "a b c d e f", "other text is here now", None, "", "a b c d e f"], [5, 3, 1, 7, 9, 3])
    docs = docs.withColumn("_fp", F.lit("clash")).withColumn("component_id", F.lit(1)).withColumn("root", F.lit(2))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 7]


def test_null_ids_and_empty_tables(spark):
    docs = documents(spark, ["a b", None, None, "c d e f g"], [None, 2, None, None])
    found = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert found == {(None, None), (2, 2), (None, 2)}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_one(docs.limit(0)).count() == 0
    assert sorted(r.text for r in simhash.keep_one(docs).filter("text is not null").collect()) == ["a b", "c d e f g"]
