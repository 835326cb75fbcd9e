import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from corpusframe.llm import packing
from llm.conftest import documents


@pytest.fixture(scope="module")
def tokenizer():
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    return plain


def numbers(raw):
    return np.frombuffer(raw, "<u4").tolist()


def check(rows, texts, tokenizer, capacity):
    """Every id of every document once and in order; sequences without gaps and not too long. The number of sequences."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for i, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        own, at = sorted(by_doc[i], key=lambda r: r.piece), 0
        assert [r.piece for r in own] == list(range(len(own))) and len(own) == -(-len(ids) // capacity)
        assert all(r.length == capacity for r in own[1:])
        for r in own:
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence)


AWKWARD = [None, "", " ", "  ", "a", "\n\n a\n  b\t\tc  ", "it's we'll 12ab!? §5", "x" * 5000, "é" * 300 + " b", "日本語 テキスト 😀", "<|endoftext|> a  <|endoftext|>", "\x1ca\x1d b\x85c", "r\r\n \r\n q " * 50]


def test_ids_equal_whole_encoding(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 40)
    monkeypatch.setattr(packing, "KEPT", 30)
    encoder = packing.Encoder(packing.VOCABULARY)
    rng = random.Random(2)
    alphabet = ["\0", "a", "b", " ", " ", "\n", "\t", "1", "'s", "é", " ", "​", "!", "word", "\x1f"]
    texts = [t or "" for t in AWKWARD] + ["".join(rng.choices(alphabet, k=rng.randint(0, 300))) for _ in range(400)]
    texts += ["".join(rng.choices(["a", " ", "\n", "b"], k=rng.randint(0, 40))) for _ in range(400)]
    for some in (texts, texts[::-1], [texts[3]], []):
        assert [numbers(encoder.encode(t)) for t in some] == [tokenizer.encode(t, add_special_tokens=False).ids for t in some]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_ids_of_any_text(texts):
    encoder = packing.encoder(packing.VOCABULARY)
    assert [numbers(encoder.encode(t)) for t in texts] == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 40)))
def test_plans_take_each_piece_once(histogram):
    counts = np.zeros(25, np.int64)
    for n, c in histogram.items():
        counts[n] = c
    taken = Counter()
    for lengths, repeats in packing.plan(counts):
        assert repeats > 0 and sum(lengths) <= 24
        for n in lengths:
            taken[n] += repeats
    assert taken == Counter(histogram)


def test_fit_is_a_least_squares_solution():
    """At the minimum no pattern in use could mend anything and no other one would help."""
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 50, 41).astype(float)
    counts[0] = 0
    patterns = packing.exact_patterns(np.flatnonzero(counts), 40)
    assert all(sum(p) == 40 for p in patterns) and len({tuple(p) for p in patterns}) == len(patterns)
    brute = {tuple(sorted((a, b, 40 - a - b), reverse=True)) for a in range(1, 41) for b in range(0, 41 - a)}
    brute = {p for p in brute if all(n == 0 or counts[n] for n in p)}
    assert {tuple(p) for p in patterns} == brute
    x = packing.fit(patterns, counts, 500, least=0.0)
    made = np.zeros(41)
    np.add.at(made, patterns.ravel(), np.repeat(x, 3))
    weight = (np.arange(41) / 40.0) ** 2
    gain = (weight * (counts - np.where(np.arange(41) > 0, made, 0)))[patterns].sum(axis=1)
    assert (x >= 0).all() and gain.max() < 0.02 * counts.max() and abs(gain[x > 0]).max() < 0.02 * counts.max()


@pytest.mark.parametrize("seed", [1, 2])
def test_plans_come_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    counts = np.bincount(np.clip(rng.lognormal(6, 1, 30_000).astype(int), 1, 2048), minlength=2049)
    bound = -(-int((counts * np.arange(2049)).sum()) // 2048)
    assert sum(r for _, r in packing.plan(counts)) <= 1.002 * bound


def test_small_table_and_sequences(spark, tokenizer):
    rng = random.Random(7)
    texts = AWKWARD + [" ".join(rng.choices(["alpha", "bet", "c", "d\n"], k=rng.randint(0, 90))) for _ in range(80)]
    docs = documents(spark, texts).selectExpr("*", "1 as piece", "2 as _at", "3 as length", "4 as sequence_id")
    found = packing.packed(docs, capacity=64).cache()
    rows = found.collect()
    n = check(rows, dict(enumerate(texts)), tokenizer, 64)
    assert n <= 1.02 * sum(r.length for r in rows) / 64 + 1
    made = packing.sequences(found).collect()
    assert len(made) == n and all(len(s.ids) == s.length <= 64 for s in made)
    by_id = {s.sequence_id: s for s in made}
    for r in rows:
        assert numbers(bytes(r.ids)) == by_id[r.sequence_id].ids[r.offset : r.offset + r.length]


def test_null_and_repeated_ids_and_empty_tables(spark):
    docs = documents(spark, ["a b", "a b", None, "c"], [1, 1, None, None])
    rows = packing.packed(docs, with_ids=False).collect()
    assert len(rows) == 4 and sorted((r.doc_id or 0, r.length) for r in rows)[:1] == [(0, 1)]
    assert packing.packed(docs.limit(0)).count() == 0 and packing.sequences(packing.packed(docs.limit(0))).count() == 0


def test_query_on_whole_table(spark, tokenizer):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = packing.op13_pattern_packing(spark, sf).collect()
    assert check(rows, texts, tokenizer, 2048) <= 1.005 * sum(r.length for r in rows) / 2048 + 1
