import random

import pytest

from conftest import rows
from corpusframe.operators.ledger import compact_ledger, load_changed, loaded_output
from corpusframe.operators.snapshots import Snapshots
from corpusframe.sources.commits import CommitLog

MANIFEST = "path string, length long, modified timestamp, extra int"


def listed(spark, files):
    return spark.createDataFrame([(p, n, None, 1) for p, n in files.items()], MANIFEST)


def state(df):
    return {r.path: r.length for r in df.collect()}


def net(a, b):
    out = {p: "added" for p in b if p not in a} | {p: "gone" for p in a if p not in b}
    return out | {p: "changed" for p in a if p in b and a[p] != b[p]}


def test_random_histories(spark, tmp_path):
    rng, store = random.Random(1), Snapshots(CommitLog(spark, str(tmp_path / "s")))
    history = [{}]
    for version in range(1, 6):
        files = {f"f{k}": rng.choice([1, 2, None]) for k in range(12) if rng.random() < 0.6} if version != 4 else {}
        assert store.take(listed(spark, files)) == version
        history.append(files)
        if version == 3:
            store.compact()
        assert state(store.state()) == files
    for a in range(1, 6):
        assert state(store.state(a)) == history[a]
        for b in range(a + 1, 6):
            assert {r.path: r.change for r in store.changes(a, b).collect()} == net(history[a], history[b])
    gone = {r.path: r.length for r in store.changes(3, 4).collect()}
    assert gone == history[3]
    assert store.changes(5) is None


def test_unchanged_files_are_not_written_again(spark, tmp_path):
    store = Snapshots(CommitLog(spark, str(tmp_path / "s")))
    assert store.state() is None and store.deltas() is None
    store.take(listed(spark, {"a": 1, "b": 2}))
    store.take(listed(spark, {"a": 1, "b": 3}))
    assert [(r.version, r.path, r.change, r.length) for r in store.deltas().filter("version = 2").collect()] == [(2, "b", "changed", 3)]
    odd = spark.createDataFrame([(None, 1, None, 1), ("a", 5, None, 1), ("a", 4, None, 2)], MANIFEST)
    store.take(odd)
    assert state(store.state()) == {"a": 5}


def files(spark, sums):
    return spark.createDataFrame([(p, c) for p, c in sums.items()], "path string, checksum string")


def test_a_load_that_dies_leaves_nothing(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "l"))
    assert loaded_output(log) is None
    load = lambda n: lambda wanted: wanted.selectExpr("path", f"{n} as load")
    load_changed(log, files(spark, {"a": "1", "b": "1"}), load(1))
    broken = lambda wanted: wanted.selectExpr("path", "if(path = 'c', cast(raise_error('dies') as int), 2) as load")
    with pytest.raises(Exception, match="dies"):
        load_changed(log, files(spark, {"a": "2", "c": "1"}), broken)

    def dies_late(**tables):
        for name, df in tables.items():
            log._write(df, name)
        raise KeyboardInterrupt

    killed = CommitLog(spark, str(tmp_path / "l"))
    killed.commit = dies_late
    with pytest.raises(KeyboardInterrupt):
        load_changed(killed, files(spark, {"a": "2", "c": "1"}), load(2))
    assert log.latest == 1 and rows(loaded_output(log)) == [{"path": "a", "load": 1}, {"path": "b", "load": 1}]
    assert load_changed(log, files(spark, {"a": "2", "c": "1"}), load(3)) == 2
    assert rows(loaded_output(log)) == [{"path": "a", "load": 3}, {"path": "b", "load": 1}, {"path": "c", "load": 3}]
    compact_ledger(log)
    assert load_changed(log, files(spark, {"a": "2", "b": "1", "c": "1"}), load(4)) is None
    assert load_changed(log, files(spark, {"a": "1", "b": ""}), load(5)) == 3
    assert [r["load"] for r in rows(loaded_output(log))] == [5, 5, 3]
