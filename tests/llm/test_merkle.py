import hashlib
import random

import pytest
from pyspark.sql import functions as F

from corpusframe.llm import merkle
from corpusframe.llm.places import places
from llm.conftest import DOCS


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def slow_leaf(values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes, fan):
    """Levels from the leaves to the top."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([H(*at[i : i + fan]) for i in range(0, len(at), fan)])
    return levels


def way(levels, i, fan):
    """(left, right) siblings of leaf i, level by level."""
    out = []
    for at in levels[:-1]:
        low = i - i % fan
        out.append(("".join(at[low:i]), "".join(at[i + 1 : low + fan])))
        i //= fan
    return out


def slow(rows, fan):
    """(doc_id, leaf) -> (subroot, root, proof) for rows (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for doc_id, text, lang, source, n_chars in rows:
        groups.setdefault(lang, []).append((doc_id, slow_leaf([doc_id, source, lang, n_chars, text])))
    order = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        groups[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[lang] = climb([h for _, h in groups[lang]], fan)
    top = climb([trees[lang][-1][0] for lang in order], fan)
    out = []
    for j, lang in enumerate(order):
        for i, (doc_id, h) in enumerate(groups[lang]):
            out.append((doc_id, h, trees[lang][-1][0], top[-1][0], way(trees[lang], i, fan) + way(top, j, fan)))
    return out


def found(spark, rows, **options):
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as tree", "2 as _at", "3 as proof", "4 as sub")
    out = []
    for r in merkle.proofs(docs, **options).collect():
        proof = [(bytes(s.left).hex(), bytes(s.right).hex()) for s in r.proof]
        out.append((r.doc_id, bytes(r.leaf).hex(), bytes(r.subroot).hex(), bytes(r.root).hex(), proof))
    return out


def sample(n, langs, seed):
    rng = random.Random(seed)
    rows = [(i, "tExt " * rng.randint(0, 5) + "é", rng.choice(langs), rng.choice(["a", None]), i) for i in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,langs,fan", [(1, ["en"], 8), (9, ["en"], 8), (64, [None], 8), (150, ["en", "de", None, "é"], 8), (70, ["a"], 2), (90, [f"l{k}" for k in range(20)] + [None], 2), (7, list("abcdefg"), 3)])
def test_equals_brute_force(spark, n, langs, fan, monkeypatch):
    monkeypatch.setattr(merkle, "SPREAD", 3)
    rows = sample(n, langs, n)
    assert sorted(map(str, found(spark, rows, fan=fan))) == sorted(map(str, slow(rows, fan)))


def test_ties_nulls_repeats_long_texts_and_empty_tables(spark):
    rows = [(None, None, None, None, None), (None, "b", None, None, 1), (3, "", "en", "s", None), (3, "", "en", "s", None), (3, "x" * 2_000_000, "en", "s", 5), (-4, "A", "", "", -1)]
    assert sorted(map(str, found(spark, rows))) == sorted(map(str, slow(rows, 8)))
    assert found(spark, []) == []


def test_a_changed_row_is_found_and_only_that(spark):
    docs = spark.createDataFrame([(i, f"Text {i}" if i % 2 else f"text {i}", "en" if i % 3 else "de", "s", i) for i in range(40)], DOCS)
    out = merkle.proofs(docs, changed={"text": F.lower("text"), "where": F.col("doc_id") < 20})
    rows = out.select("doc_id", (merkle.fold(F.coalesce("changed_leaf", "leaf"), F.col("proof")) == merkle.hexed(F.col("root"))).alias("ok")).collect()
    assert {r.doc_id: r.ok for r in rows} == {i: not (i % 2 and i < 20) for i in range(40)}


def test_places_span_tasks_and_keep_nulls(spark):
    rows = [(None if k % 7 == 0 else "x" if k % 2 else f"g{k % 3}", k * 37 % 101) for k in range(400)]
    got = places(spark.createDataFrame(rows, "g string, v long").repartition(5), ["g"], ["v"], "t").collect()
    want = {}
    for g, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        want.setdefault(g, []).append(v)
    by = {}
    for r in sorted(got, key=lambda r: r._at):
        assert r._n == len(want[r.g])
        by.setdefault(r.g, []).append(r)
    assert {g: [r.v for r in rs] for g, rs in by.items()} == want
    assert all([r._at for r in rs] == list(range(len(rs))) and len({r._group for r in rs}) == 1 for rs in by.values())
    numbers = [by[g][0]._group for g in sorted(by, key=lambda x: (x is not None, x or ""))]
    assert numbers == sorted(set(numbers))
