import random
from itertools import permutations

import numpy as np

from corpusframe.llm import audit
from llm.conftest import DOCS

LABELS = "doc_id long, quality int, toxic int"


def slow_masks(rows, labels):
    out = []
    for doc_id, text, _, source, _ in rows:
        text = text or ""
        words = [w for w in text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
        upper = sum("A" <= c <= "Z" for c in text)
        earlier = any(i is not None and (doc_id is None or i < doc_id) and (t or "") == text for i, t, *_ in rows)
        failed = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * upper > 2 * len(text), any(c in text for c in "#$%&*|"), earlier]
        own = [(q, x) for i, q, x in labels if i is not None and i == doc_id]
        out.append((source or "", "".join(f for f, bad in zip("ABCDE", failed) if bad), any(q == 1 for q, _ in own), any(x == 1 for _, x in own)))
    return out


def slow(masks):
    """Every order applied to the documents one by one."""
    out, removed_by = {}, {}
    for part in {m[0] for m in masks}:
        for order in permutations("ABCDE"):
            left = [m for m in masks if m[0] == part]
            everything = left
            for step, f in enumerate(order, 1):
                gone, kept = [m for m in left if f in m[1]], [m for m in left if f not in m[1]]
                redundant = sum(f in m[1] for m in everything) - len(gone)
                out[part, "".join(order), step] = [len(kept), len(gone), redundant, sum(m[1] == f for m in everything), sum(m[2] for m in gone), sum(m[3] for m in gone)]
                removed_by[part, f] = removed_by.get((part, f), 0) + len(gone)
                left = kept
    return {key: [*values, removed_by[key[0], key[1][key[2] - 1]]] for key, values in out.items()}


def counted(df):
    return {(r.part, r.filter_order, r.step): [r[c] for c in audit.COUNTS] for r in df.collect()}


def sample():
    rng = random.Random(3)
    pool = [f"word{k}" for k in range(400)]
    texts = [None, "", " ", " ", "a b", "A" * 5, "x" * 100_000 + " #"]
    for _ in range(40):
        words = rng.choices(pool if rng.random() < 0.7 else pool[:60], k=rng.choice([150, 199, 200, 201, 320]))
        texts.append(rng.choice([" ", "\n"]).join(w.upper() if rng.random() < 0.02 else w for w in words) + rng.choice(["", "", " 5%", "|", "É"]))
    rows = [(k, rng.choice(texts), "en", rng.choice(["s", "t", None, ""]), 1) for k in range(120)]
    rows += [(None, texts[8], "en", "s", 1), (None, "only here", "en", "s", 1), (5, rows[5][1], "en", "s", 1), (-7, rows[9][1], None, "t", None)]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 120, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (999, 1, 1)]
    return rows, labels


def test_equals_all_orders_by_hand(spark):
    rows, labels = sample()
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as mask", "2 as id", "3 as part", "4 as same")
    marks = spark.createDataFrame(labels, LABELS).selectExpr("*", "'x' as text", "1 as good")
    found = audit.failures(docs, marks)
    want = slow_masks(rows, labels)
    names = lambda m: "".join(c for k, c in enumerate("ABCDE") if m >> k & 1)
    assert sorted((r.part, names(r.mask), r.good, r.toxic) for r in found.collect()) == sorted(want)
    assert counted(audit.audit(found)) == slow(want)


def test_walk_equals_counting_every_subset():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 6):
        cells = rng.integers(0, 9, (3, 2, 1 << n))
        want = [[cells[..., [m for m in range(1 << n) if not m & s]].sum(-1)] for s in range(1 << n)]
        assert (audit.walk(cells) == np.stack([w[0] for w in want], axis=-1)).all()


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert audit.audit(audit.failures(docs, labels)).count() == 0
    some = spark.createDataFrame([(1, "a", "en", None, 1)], DOCS)
    assert counted(audit.audit(audit.failures(some, labels)))["", "ABCDE", 1] == [0, 1, 0, 1, 0, 0, 120]
