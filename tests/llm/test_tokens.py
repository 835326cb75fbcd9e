import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpusframe.llm import decontaminate, lattice, substrings
from corpusframe.llm.tokens import NOT_SPACE, SHORT, chunked
from llm.conftest import documents

#: Two unlike words that every polynomial modulo a power of two hashes alike.
THUE_MORSE = "".join("ab"[i.bit_count() % 2] for i in range(2048))
COMPLEMENT = THUE_MORSE.translate(str.maketrans("ab", "ba"))
LEAD = " ".join(f"w{i}" for i in range(19))


def test_words_hash_alike_only_if_equal():
    rng = random.Random(5)
    words = {"".join(rng.choices("ab\0é", k=n)) for n in [*range(1, 3 * SHORT), *[7, 8, 9, 15, 16, 17] * 200] for _ in range(3)}
    words |= {THUE_MORSE, COMPLEMENT, "a", "a\0", "a\0\0", "\0a", "\0"}
    listed = [*sorted(words), *sorted(words, reverse=True)]
    texts = [" ".join(listed[:50]), None, "", *listed[50:], "  "]
    found = {}
    for _, _, part in chunked(pa.array(texts), NOT_SPACE, limit=700):
        for i, h in enumerate(part.hashes().tolist()):
            assert found.setdefault(part.word(i), h) == h
    assert len(found) == len(words) == len(set(found.values()))


def test_hashes_spread_over_all_bits():
    text = " ".join(str(i) for i in range(20_000))
    _, _, words = next(chunked(pa.array([text])))
    bits = np.unpackbits(words.hashes().view(np.uint8).reshape(-1, 8), axis=1)
    assert abs(bits.mean(0) - 0.5).max() < 0.02


def test_unlike_last_words_make_unlike_windows(spark):
    docs = documents(spark, [f"{LEAD} {THUE_MORSE}", f"{LEAD} {COMPLEMENT}", f"{LEAD} {THUE_MORSE}"])
    got = {r.doc_id: r.n_removed for r in substrings.remove_repeats(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 20}


def test_unlike_benchmark_words_are_no_hit(spark):
    lead = " ".join(LEAD.split()[:12])
    docs = documents(spark, [f"{lead} {THUE_MORSE}", f"{lead} {COMPLEMENT}"])
    items = spark.createDataFrame([("q", f"{lead} {COMPLEMENT}")], "item_id string, text string")
    assert {r.doc_id: r.n_hit for r in decontaminate.contamination(docs, items).collect()} == {0: 0, 1: 13}


def test_unseen_words_are_unknown(spark):
    docs = documents(spark, [THUE_MORSE, COMPLEMENT, THUE_MORSE])
    got = {r.doc_id: r.n_known for r in lattice.lattice_scores(docs, F.col("doc_id") > 0).collect()}
    assert got == {0: 2, 1: 1, 2: 2}
