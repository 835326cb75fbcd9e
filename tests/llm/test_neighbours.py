import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusframe.llm import neighbours
from corpusframe.llm.neighbours import Tables, hadamard


def slow(rows, k=20):
    good = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v):
            good.setdefault(i, []).append(np.array(np.array(v, np.float32), float))
    out = {}
    for q in good:
        if q % 20 == 0:
            best = [(-max(float(a @ b) for a in good[q] for b in vs if len(a) == len(b)), i) for i, vs in good.items() if i != q and any(len(a) == len(b) for a in good[q] for b in vs)]
            out[q] = sorted(best)[:k]
    return out


def check_exact(found, rows):
    want = slow(rows)
    got = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {q for q, x in want.items() if x}
    for q, near in got.items():
        assert [(r, i) for r, i, _ in near] == [(n + 1, i) for n, (_, i) in enumerate(want[q])]
        assert [s for *_, s in near] == pytest.approx([-s for s, _ in want[q]], rel=1e-12)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as cls", "2 as vec", "3 as q")


def test_hadamard_keeps_lengths_and_equals_the_matrix():
    h = np.array([[1.0]])
    for _ in range(4):
        h = np.block([[h, h], [h, -h]])
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert hadamard(x) == pytest.approx(x @ h / 4)


def test_small_tables_copies_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 10)).astype(np.float32).tolist()
    rows = [(i, base[i % 40]) for i in range(130)] + [(i, base[0]) for i in range(200, 320)]
    rows += [(400, None), (420, [0.0] * 10), (440, [float("nan")] * 10), (460, [None] + [1.0] * 9), (480, [float("inf")] * 10), (None, base[1]), (500, [1.0, 2.0]), (501, [3.0, 1.0]), (520, [])]
    check_exact(neighbours.nearest_neighbours(frame(spark, rows), F.col("vec_id") % 20 == 0), rows)
    assert neighbours.nearest_neighbours(frame(spark, rows[:0]), F.col("vec_id") % 20 == 0).count() == 0
    few = [(0, [1.0, 0.0]), (1, [0.5, 1.0]), (0, [1.0, 0.0])]
    check_exact(neighbours.nearest_neighbours(frame(spark, few), F.col("vec_id") % 20 == 0), few)


@pytest.mark.parametrize("codes", [1, 2])
def test_large_buckets_are_dealt_out(spark, monkeypatch, codes):
    """Every bucket is probed, so the result is exact whatever the split."""
    monkeypatch.setattr(neighbours, "PART", 7)
    monkeypatch.setattr(neighbours, "SLICE", 50)
    rng = np.random.default_rng(2)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(90, 4)).astype(np.float32).tolist())]
    plan = Tables(4, codes, 2, 8**codes)
    check_exact(neighbours.nearest_neighbours(frame(spark, rows), F.col("vec_id") % 20 == 0, plan=plan), rows)


@pytest.mark.parametrize("count,dimensions,plan", [(12_000, 64, None), (12_000, 64, Tables(64, 2, 12, 384)), (10_000, 384, None)])
def test_recall(spark, tmp_path, count, dimensions, plan):
    """Unit vectors in loose clusters, more of them than a table that is searched whole."""
    rng = np.random.default_rng(count + dimensions)
    made = rng.normal(size=(count // 20, dimensions))[rng.integers(0, count // 20, count)] + 0.9 * rng.normal(size=(count, dimensions))
    made = (made / np.linalg.norm(made, axis=1, keepdims=True)).astype(np.float32)
    rows = pd.DataFrame({"vec_id": np.arange(count), "embedding": list(made)})
    rows.to_parquet(tmp_path / "v.parquet")
    vectors = spark.read.parquet(str(tmp_path / "v.parquet")).repartition(8)
    x, ids = np.array(rows.embedding.tolist(), float), rows.vec_id.to_numpy()
    asked = np.flatnonzero(ids % 20 == 0)
    scores = x[asked] @ x.T
    scores[np.arange(len(asked)), asked] = -np.inf
    want = {int(ids[q]): set(ids[np.argsort(-s, kind="stable")[:20]].tolist()) for q, s in zip(asked, scores)}
    got = {}
    for r in neighbours.nearest_neighbours(vectors, F.col("vec_id") % 20 == 0, plan=plan).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert all(len(got[q]) == 20 for q in want)
    assert np.mean([len(got[q] & w) / 20 for q, w in want.items()]) >= 0.9


@pytest.mark.parametrize("count,dimensions", [(51_282, 64), (2_000_000, 64), (17_000_000, 64), (117_000_000, 64), (2_000_000, 128), (17_000_000, 100), (2_500_000, 768)])
def test_plans_meet_the_last_neighbour(count, dimensions):
    """Pairs as similar as a query and its 20th of so many evenly spread vectors share a bucket that is probed."""
    plan = Tables.of(count, dimensions)
    grid = np.linspace(0, 1, 20_001)[:-1]
    weight = (1 - grid**2) ** ((dimensions - 3) / 2)
    similarity = grid[np.flatnonzero(weight[::-1].cumsum()[::-1] / (2 * weight.sum()) >= 20 / count)[-1]]
    rng = np.random.default_rng(8)
    q, p = rng.normal(size=(2, 150, dimensions))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    p -= (p * q).sum(1, keepdims=True) * q
    p = similarity * q + np.sqrt(1 - similarity**2) * p / np.linalg.norm(p, axis=1, keepdims=True)
    met = np.zeros(150, bool)
    for t in range(plan.tables):
        met |= (plan.probed(q, t) == plan.buckets(p, t)[:, None]).any(1)
    assert met.mean() >= 0.9


def shuffled(plan):
    """Bytes that the exchanges of a finished plan wrote."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled(plan.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled(plan.plan())
    size = plan.metrics().apply("dataSize").value() if kind == "ShuffleExchangeExec" else 0
    children = plan.children()
    return size + sum(shuffled(children.apply(i)) for i in range(children.size()))


def test_vectors_are_not_shuffled_for_each_table_and_probe(spark):
    rng = np.random.default_rng(5)
    vectors = frame(spark, [(i, v) for i, v in enumerate(rng.normal(size=(2_000, 64)).astype(np.float32).tolist())])
    found = neighbours.nearest_neighbours(vectors, F.col("vec_id") % 20 == 0, plan=Tables(64, 2, 12, 384))
    assert len(found.collect()) == 2_000
    assert 0 < shuffled(found._jdf.queryExecution().executedPlan()) < 5 * 2_000 * 64 * 4


@pytest.mark.parametrize("dimensions,plan", [(5, Tables(8, 2, 3, 9)), (8, Tables(8, 1, 2, 2)), (3, Tables(4, 3, 2, 30))])
def test_the_nearest_of_the_vectors_met(spark, monkeypatch, dimensions, plan):
    """Over several slices, groups and merges: the vectors in probed buckets, no others, ordered by score."""
    for name, value in {"SLICE": 150, "LEAST": 100, "PART": 5, "SCORES": 64, "PENDING": 500, "GATHERED": 200, "ROWS": 7, "PROBES": 1, "QUERIES": 11}.items():
        monkeypatch.setattr(neighbours, name, value)
    rng = np.random.default_rng(dimensions)
    x = rng.normal(size=(700, dimensions)).astype(np.float32)
    met = np.zeros((35, 700), bool)
    for t in range(plan.tables):
        met |= (plan.probed(x[::20].astype(float), t)[:, :, None] == plan.buckets(x.astype(float), t)).any(1)
    scores = x[::20].astype(float) @ x.astype(float).T
    scores[~met] = -np.inf
    scores[np.arange(35), np.arange(35) * 20] = -np.inf
    got = {}
    for r in neighbours.nearest_neighbours(frame(spark, [(i, v) for i, v in enumerate(x.tolist())]), F.col("vec_id") % 20 == 0, plan=plan).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q * 20: near for q, s in enumerate(scores) if (near := [int(i) for i in np.argsort(-s)[:20] if s[i] > -np.inf])}
