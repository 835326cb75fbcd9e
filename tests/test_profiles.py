import math
import random
from pathlib import Path

from corpusframe.operators.profiles import DISTINCT_ERROR, RANK_ERROR, Profiles
from corpusframe.operators.splits import write_sized_splits
from corpusframe.sources.commits import CommitLog

ROWS = "split string, word string, n double, `odd name` int, n_rows int"


def load(spark, seed, size, first=0):
    rng = random.Random(seed)
    return [(rng.choice(["a", "a", "a", "b", None]), f"w{first + rng.randrange(size)}", rng.choice([rng.random() * 100, None]), k % 5, k) for k in range(size)]


def test_united_profiles_stay_within_their_stated_error(spark, tmp_path):
    store, every = Profiles(CommitLog(spark, str(tmp_path / "p"))), []
    assert store.merged() is None
    for number, size in enumerate([3000, 4000, 1]):
        rows = load(spark, number, size, first=2000 * number)
        every += rows
        assert store.take(spark.createDataFrame(rows, ROWS), ["word", "odd name"], ["n"]) == number + 1
    store.take(spark.createDataFrame([], ROWS), ["word"], ["n"])
    before = None
    for turn in range(2):
        found = {(r.split, r.column): r for r in store.merged([0.1, 0.5, 0.9]).collect()}
        assert len(found) == 9
        for split in ("a", "b", None):
            mine = [r for r in every if r[0] == split]
            word, n = found[split, "word"], found[split, "n"]
            exact = len({r[1] for r in mine})
            assert word.n_rows == len(mine) and word.n_nulls == 0 and word.quantiles is None and word.low is None
            assert abs(word.n_distinct - exact) <= DISTINCT_ERROR * exact
            numbers = sorted(r[2] for r in mine if r[2] is not None)
            assert n.n_nulls == len(mine) - len(numbers) and (n.low, n.high) == (numbers[0], numbers[-1])
            for p, value in zip([0.1, 0.5, 0.9], n.quantiles):
                assert abs(sum(x <= value for x in numbers) / len(numbers) - p) <= 3 * RANK_ERROR
            assert found[split, "odd name"].n_distinct == 5
        exact = {k: (r.n_rows, r.n_nulls, r.low, r.high, r.n_distinct) for k, r in found.items()}
        assert before in (None, exact)
        before = exact
        store.compact()
    assert store.merged(until=1).agg({"n_rows": "max"}).first()[0] == max(sum(r[0] == s for r in every[:3000]) for s in ("a", "b"))


def test_nulls_and_nan_are_no_numbers(spark, tmp_path):
    store = Profiles(CommitLog(spark, str(tmp_path / "p")))
    rows = [("a", None, None, None, 1), ("b", None, math.nan, 2, 1), ("b", "x", 3.0, 2, 1), ("b", "x", 3.0, 2, 1)]
    store.take(spark.createDataFrame(rows, ROWS), ["word"], ["n"])
    found = {(r.split, r.column): (r.n_rows, r.n_nulls, r.n_distinct, r.low, r.high, r.quantiles) for r in store.merged().collect()}
    assert found["a", "n"] == (1, 1, 0, None, None, None) and found["a", "word"] == (1, 1, 0, None, None, None)
    assert found["b", "n"] == (3, 0, 2, 3.0, 3.0, [3.0])


def test_a_large_split_has_many_files_and_a_tiny_one_has_one(spark, tmp_path):
    total = 200_000
    df = spark.range(total, numPartitions=8).selectExpr("id", "sha2(string(id), 256) as text", f"if(id < {total // 100}, 'tiny', if(id = {total - 1}, null, 'large')) as split")
    key, before = "spark.sql.adaptive.advisoryPartitionSizeInBytes", spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    write_sized_splits(df, str(tmp_path / "o"), 2 << 20, ["id"])
    files = {s: list(Path(tmp_path / "o" / f"split={s}").glob("*.parquet")) for s in ("tiny", "large")}
    assert len(files["tiny"]) == 1 and len(files["large"]) >= 4
    sizes = [f.stat().st_size for f in files["large"]]
    assert max(sizes) < 4 << 20
    assert spark.conf.get(key, None) == before
    ids = [[r.id for r in spark.read.parquet(str(f)).collect()] for f in files["large"]]
    assert all(part == sorted(part) for part in ids)
    assert sorted(i for part in ids for i in part) == list(range(total // 100, total - 1))
