import hashlib
import random
import re

from corpusframe.llm import decontaminate as d
from llm.conftest import documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def slow(doc, items, n=13):
    w = words(doc)
    hit, ids = set(), set()
    for item_id, text in items:
        b = words(text)
        k = min(n, len(b))
        grams = {tuple(b[i : i + k]) for i in range(len(b) - k + 1)} if b else set()
        for i in range(len(w) - k + 1):
            if k and tuple(w[i : i + k]) in grams:
                hit.update(range(i, i + k))
                if item_id is not None:
                    ids.add(str(item_id))
    digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
    return len(w), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(w)


def sample():
    rng = random.Random(5)
    common, rare = ["the", "of", "Und", "é"], [f"w{i}" for i in range(80)]
    items = [(i, " ".join(rng.choices(common + rare, k=rng.choice([1, 5, 13, 14, 40])))) for i in range(12)]
    items += [(12, items[3][1]), (13, ""), (14, None), (None, "zz yy zz yy"), (3, "qq rr ss"), (15, "the the the the the the the the the the the the the the")]
    docs = []
    for _ in range(60):
        text = rng.choices(common + rare, k=rng.randint(0, 120))
        b = words(rng.choice(items)[1])
        if b:
            lo = rng.randrange(len(b))
            text[len(text) // 2 : len(text) // 2] = b[lo : lo + rng.randint(1, 40)]
        docs.append(rng.choice([" ", ", ", "\n", "-"]).join(text).upper() if rng.random() < 0.2 else " ".join(text))
    return docs + [None, "", "...", "the " * 20_000, items[4][1], items[4][1]], items


def test_query_equals_brute_force(spark, monkeypatch):
    docs, items = sample()
    ids = [*range(len(docs) - 2), 7, 7]
    frame = documents(spark, docs, ids).selectExpr("*", "1 as window", "2 as start", "3 as n_words")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((i, *slow(t, items)) for i, t in zip(ids, docs))
    for bound in (10**6, 30):
        monkeypatch.setattr(d, "DICTIONARY", bound)
        got = sorted(tuple(r) for r in d.contamination(frame, bench).drop("_key").collect())
        assert got == want
    kept = d.decontaminated(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(w[0] for w in want if not w[-1])


def test_proximity(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = documents(spark, ["alpha beta gamma delta", "alpha x beta gamma delta", "alpha x x x x x beta", "gamma delta"])
    got = {(r.doc_id, r.exact) for r in d.find_passages(docs, bench, slop=1).collect()}
    assert got == {(0, True), (1, False)}


def test_empty_tables(spark):
    docs, bench = documents(spark, ["a b", None]), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert d.contamination(docs.limit(0), bench).count() == 0
    none = d.contamination(docs, bench.limit(0)).collect()
    assert {(r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in none} == {(0, 2, 0, False), (1, 0, 0, False)}
    null_ids = documents(spark, ["a b", "a b", "c"], [None, None, None])
    assert sorted(r.contaminated for r in d.contamination(null_ids, bench).collect()) == [False, True, True]
    assert [r.text for r in d.decontaminated(null_ids, bench).collect()] == ["c"]
