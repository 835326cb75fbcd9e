import pytest

from corpusframe.operators.categories import Categories
from corpusframe.sources.commits import CommitLog


def values(spark, *found):
    return spark.createDataFrame([(v, k) for k, v in enumerate(found)], "kind string, _in0 int")


def known(store, until=None):
    return {r.value: r.code for r in store.codes(until).collect()}


def test_codes_stay_and_new_values_come_behind(spark, tmp_path):
    store = Categories(CommitLog(spark, str(tmp_path / "c")))
    assert store.codes() is None
    assert store.learn(values(spark, None), "kind") is None
    assert store.learn(values(spark, "b", "a", "b", None, "", "é"), "kind") == 1
    first = known(store)
    assert first == {"": 0, "a": 1, "b": 2, "é": 3}
    assert store.learn(values(spark, "a", "b", None), "kind") is None
    assert store.learn(values(spark, "A", "c", "a "), "kind") == 2
    assert known(store) == first | {"A": 4, "a ": 5, "c": 6} and known(store, until=1) == first


def test_rows_come_back(spark, tmp_path):
    store = Categories(CommitLog(spark, str(tmp_path / "c")))
    df = values(spark, "x", None, "y", "x", "", "unknown")
    store.learn(df.filter("kind <> 'unknown'"), "kind")
    coded = store.encode(df, "kind", "code")
    assert coded.columns == ["kind", "_in0", "code"] and coded.count() == 6
    back = store.decode(coded, "code", "again").collect()
    assert all(r.again == (None if r.kind == "unknown" else r.kind) for r in back)
    assert sorted(r._in0 for r in back) == list(range(6))
    assert store.encode(df.limit(0), "kind", "code").count() == 0
    with pytest.raises(ValueError):
        store.encode(coded, "kind", "code")


def test_many_values_are_numbered_without_gaps(spark, tmp_path):
    store = Categories(CommitLog(spark, str(tmp_path / "c")))
    df = spark.range(40_000).selectExpr("concat('v', id % 20000) as kind")
    store.learn(df.filter("hash(kind) % 3 = 0"), "kind")
    store.learn(df, "kind")
    found = store.codes().agg({"code": "max", "value": "count"}).first()
    assert tuple(found) == (19_999, 20_000) or tuple(found) == (20_000, 19_999)
    assert store.codes().select("code").distinct().count() == 20_000
