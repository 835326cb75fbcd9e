import hashlib
import random
import re

import pytest

from corpusframe.llm import substrings
from llm.conftest import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(rows, n=20):
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    order = lambda i: (i is None, i or 0)
    for i, w in split:
        for p in range(len(w) - n + 1):
            g = tuple(w[p : p + n])
            first[g] = min(first.get(g, (order(i), p)), (order(i), p))
    own = {}
    out = []
    for r, (i, w) in enumerate(split):
        gone, seen = set(), set()
        for p in range(len(w) - n + 1):
            g = tuple(w[p : p + n])
            if first[g][0] < order(i) or g in seen:
                gone.update(range(p, p + n))
            seen.add(g)
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def sample():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcé", k=rng.randint(1, 4))) for _ in range(200)]
    passages = [rng.choices(vocabulary, k=rng.randint(15, 70)) for _ in range(8)]
    texts = []
    for _ in range(70):
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            lo = rng.randrange(len(p))
            at = rng.randint(0, len(words))
            words[at:at] = p[lo : lo + rng.randint(5, 70)] if rng.random() < 0.6 else p
        texts.append(rng.choice([" ", "\n", "  \t"]).join(words))
    return texts + ["w " * 60, "w " * 45, " ".join(passages[0]), None, "", " \n ", "a b", "A b", texts[0], texts[0], "x" * 100_000 + " " + texts[1], "long " * 30_000]


@pytest.mark.parametrize("block", [6 << 20, 700])
def test_query_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(substrings, "BLOCK_BYTES", block)
    texts = sample()
    ids = list(range(len(texts)))
    random.Random(2).shuffle(ids)
    frame = documents(spark, texts, ids).selectExpr("*", "1 as block", "'x' as digest", "2 as n", "3 as `order`")
    got = sorted(tuple(r)[:4] for r in substrings.remove_repeats(frame).collect())
    assert got == sorted(slow(list(zip(ids, texts))))


def test_kept_words(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = {r.doc_id: r for r in substrings.remove_repeats(documents(spark, [text, "x " + text + " y"])).collect()}
    assert rows[0].n_removed == 0 and rows[1].n_removed == 30 and rows[1].kept == "x y"


def test_null_and_equal_ids(spark):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(None, text), (None, text), (3, text), (3, text), (4, "x " + text)]
    frame = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    got = sorted((tuple(r)[:4] for r in substrings.remove_repeats(frame).collect()), key=str)
    assert got == sorted(slow(rows), key=str)


def test_empty_table(spark):
    assert substrings.remove_repeats(documents(spark, ["a"]).limit(0)).count() == 0


def test_rows_are_made_and_shuffled_once(spark, monkeypatch):
    kept, written = [], substrings.written
    monkeypatch.setattr(substrings, "written", lambda df, label: kept.append(df) or written(df, label))
    kept.append(substrings.remove_repeats(documents(spark, sample())))
    for df in kept:  # phrases, then windows
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert len(kept) == 2 and plan.count("MapInArrow") == 1
