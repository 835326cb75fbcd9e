import random

import pytest

from corpusframe.llm import lines
from llm.conftest import documents


def slow(rows, m):
    """[(id, text)] -> [(id, removed, kept)] by comparing all windows."""
    split = []
    for i, t in rows:
        own = (t or "").split("\n")
        full = [k for k, x in enumerate(own) if x.strip(" \t\n\r\x0b\x0c")]
        split.append((i, own, full))
    first = {}
    for i, own, full in split:
        for p in range(len(full) - m + 1):
            w = tuple(own[k] for k in full[p : p + m])
            first[w] = min(first.get(w, (i, p)), (i, p))
    out = []
    for (i, own, full), (_, t) in zip(split, rows):
        gone = set()
        for p in range(len(full) - m + 1):
            if first[tuple(own[k] for k in full[p : p + m])] < (i, p):
                gone.update(full[p : p + m])
        out.append((i, len(gone), t if not gone else "\n".join(x for k, x in enumerate(own) if k not in gone)))
    return out


def sample():
    rng = random.Random(4)
    pool = ["alpha", "beta ", "", " ", "gamma", "delta x", "é", "omega", "one more", "\t"]
    texts = ["\n".join(rng.choices(pool, k=rng.randint(0, 14))) for _ in range(60)]
    return texts + [None, "", "\n\n", "same\n" * 500, texts[3], "x" * 100_000 + "\ny", "alpha\nbeta \ngamma\ndelta x"]


@pytest.mark.parametrize("m", [1, 2, 3, 4])
def test_equals_brute_force(spark, m):
    texts = sample()
    ids = list(range(len(texts)))
    random.Random(m).shuffle(ids)
    rows = list(zip(ids, texts))
    docs = documents(spark, texts, ids).selectExpr("*", "1 as rank", "2 as _lines", "3 as gone", "4 as a")
    found = lines.with_lines_removed(docs, min_lines=m)
    assert sorted((r.doc_id, r._n_removed, str(r._kept)) for r in found.collect()) == sorted((i, n, str(k)) for i, n, k in slow(rows, m))
    if m == 2:
        kept = lines.without_repeated_lines(docs)
        assert kept.columns == docs.columns and kept.count() == len(texts)


def slow_runs(docs, m):
    """Longest repeated prefix of every suffix by comparing all pairs; those that no longer one a line before has as its tail."""
    places = [(d, p) for d, own in enumerate(docs) for p in range(len(own))]

    def common(a, b):
        n, x, y = 0, docs[a[0]], docs[b[0]]
        while a[1] + n < len(x) and b[1] + n < len(y) and x[a[1] + n] == y[b[1] + n]:
            n += 1
        return n

    length = {a: max((common(a, b) for b in places if b != a), default=0) for a in places}
    return {(d, p, n) for (d, p), n in length.items() if n >= m and length.get((d, p - 1), 0) <= n}


@pytest.mark.parametrize("seed,letters,most,m", [(9, "abcdef", 12, 1), (1, "ab", 25, 3), (2, "abc", 40, 2)])
def test_maximal_runs_equal_all_pairs(spark, seed, letters, most, m):
    rng = random.Random(seed)
    docs = [[rng.choice(letters) for _ in range(rng.randint(1, most))] for _ in range(12)]
    docs[5] = docs[2] + ["z"]
    docs += [list("0123456789"), list("0123456789"), list("01234x"), ["q"] * 37, []]
    got = [tuple(r) for r in lines.repeated_runs(documents(spark, ["\n".join(d) for d in docs]), min_lines=m).collect()]
    assert len(got) == len(set(got)) and set(got) == slow_runs(docs, m)


def test_only_true_repeats_are_runs_and_single_lines_go(spark):
    docs = documents(spark, ["A\nB", "B\nC", "A\nB\nC"])
    assert sorted(map(tuple, lines.repeated_runs(docs).collect())) == [(0, 0, 2), (1, 0, 2), (2, 0, 2), (2, 1, 2)]
    assert sorted((r.doc_id, r.text) for r in lines.without_repeated_lines(docs).collect()) == [(0, "A\nB"), (1, "C"), (2, "")]


def test_null_ids_repeated_rows_and_empty_tables(spark):
    rows = [(None, "a\nb"), (1, "a\nb"), (1, "a\nb"), (2, "c\na\nb")]
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    got = sorted(((r.doc_id or 9, r.text) for r in lines.without_repeated_lines(docs).collect()))
    assert got == [(1, "a\nb"), (1, "a\nb"), (2, "c"), (9, "")]
    assert sorted(((r.doc_id or 9, r.start, r.length) for r in lines.repeated_runs(docs).collect())) == [(1, 0, 2), (2, 1, 2), (9, 0, 2)]
    assert lines.repeated_runs(docs.limit(0)).count() == 0
    assert lines.without_repeated_lines(docs.limit(0)).count() == 0
