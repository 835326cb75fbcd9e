"""File contents stay out of broadcasts; streams of many small files run in few tasks."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def broadcast_joins(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    return [line for line in final.splitlines() if "BroadcastHashJoin" in line]


@pytest.mark.parametrize(("query", "keys"), [("file_content", "_salt"), ("member_index", "archive"), ("landed_state", "name")])
def test_contents_are_not_broadcast(spark, query, keys):
    df = entry.queries()[query](spark, SF)
    assert not [line for line in broadcast_joins(df) if keys in line and "LeftOuter" in line]


def test_small_landed_files_share_tasks(spark, tmp_path):
    from corpusframe.checks import derived as D
    from corpusframe.streaming.ingest import loaded_so_far, stream_sidecars

    (tmp_path / "in").mkdir()
    for n in range(120):
        (tmp_path / "in" / f"{n}.json").write_text('{"n": %d}' % n)
    spec = D.spec(format="json", file_pattern="*.json", columns={"n": D.column("n", "int")})
    tracker = spark.sparkContext.statusTracker()
    query = stream_sidecars(spark, str(tmp_path / "in"), spec, D.corpus(None), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    tasks = []
    for job in tracker.getJobIdsForGroup(str(query.runId)):
        info = tracker.getJobInfo(job)
        tasks += [s.numTasks for i in info.stageIds if (s := tracker.getStageInfo(i))]
    assert tasks and max(tasks) < 30
    assert sorted(r.n for r in loaded_so_far(spark, str(tmp_path / "out")).collect()) == list(range(120))


def test_alike_path_columns_are_resolved_once(spark):
    from corpusframe.checks import derived as D
    from corpusframe.operators.mapping import map_columns

    def joins(n, **more):
        columns = {f"p{i}": D.column("c", "file_path", file_extension="wav") for i in range(n)}
        media = D.manifest(spark.range(3), D.placed("", "a", F.col("id").cast("string"), ".wav"))
        values = spark.createDataFrame([("a1",), ("a9",), (None,)], "c string")
        mapped = map_columns(D.frame(values), D.spec(columns=columns | more), D.corpus(media))
        return mapped, mapped._jdf.queryExecution().optimizedPlan().toString().count("Join ")

    one, four = joins(1), joins(4)
    assert four[1] == one[1]
    assert sorted(map(str, four[0].collect())) == sorted(str(r) for r in one[0].selectExpr("p0", "p0 p1", "p0 p2", "p0 p3").collect())
    other = {"q": D.column("c", "file_path", file_extension="mp3")}
    assert joins(1, **other)[1] > one[1]


def test_sensitive_words_at_any_place_and_case(spark):
    from corpusframe.operators.json_records import redact_json

    texts = ['{"TuRL":"a"}', '{"uttoKen":1}', '{"x\\"tutoken":[1]}', '{"tut":"url","uurl" : {"a":"b"}}', '{"turn":"t\\\\","to ken":2}']
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(redact_json(F.col("t")).alias("r"))
    gone = '"***REDACTED***"'
    assert [r.r for r in df.collect()] == [
        '{"TuRL":%s}' % gone, '{"uttoKen":%s}' % gone, '{"x\\"tutoken":%s}' % gone, '{"tut":"url","uurl" : %s}' % gone, '{"turn":"t\\\\","to ken":2}',
    ]


def test_a_retry_mends_a_file_and_leaves_nothing_beside_it(tmp_path):
    from corpusframe.sources import storage

    path = tmp_path / "a" / "b.txt"
    for content in (b"a longer text", b"short", b""):
        storage.write_again(str(path), content)
        assert path.read_bytes() == content
    assert [p.name for p in path.parent.iterdir()] == ["b.txt"]


@pytest.fixture()
def sidecars(spark, tmp_path):
    """Runs the stream over tmp_path/in; the numbers loaded so far."""
    from corpusframe.checks import derived as D
    from corpusframe.streaming.ingest import loaded_so_far, stream_sidecars

    (tmp_path / "in").mkdir()
    spec = D.spec(format="json", file_pattern="*.json", columns={"n": D.column("n", "int")})

    def run(wait=True, **more):
        query = stream_sidecars(spark, str(tmp_path / "in"), spec, D.corpus(None), str(tmp_path / "out"), str(tmp_path / "state"), **more)
        return query if not wait else query.awaitTermination() or sorted(r.n for r in loaded_so_far(spark, str(tmp_path / "out")).collect())

    return run


def test_the_driver_holds_no_names_of_landed_files(spark, tmp_path, sidecars):
    for n in range(70):
        (tmp_path / "in" / f"{n}.json").write_text('{"n": %d}' % n)
    assert sidecars(files_per_batch=30) == list(range(70))
    logged = [line for f in (tmp_path / "state").rglob("sources/0/*") if f.name.isdigit() for line in f.read_text().splitlines() if "path" in line]
    assert len(logged) == 3 and not [line for line in logged if ".json" in line]
    counts = [r["count"] for r in spark.read.option("basePath", str(tmp_path / "out")).parquet(str(tmp_path / "out")).groupBy("batch_id").count().collect()]
    assert sorted(counts) == [10, 30, 30]


def test_landed_files_that_are_taken_and_passed_over(tmp_path, sidecars):
    import os

    def put(name, n):
        (tmp_path / "in" / name).parent.mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("" if n is None else '{"n": %d}' % n)

    for n, name in enumerate(["a b.json", "c+d%20.json", "ü[1].json", "sub/_k=1.json", "sub/e.json", "_no.json", ".no.json", "_no/x.json", "no.txt", "sub/x.json._COPYING_"]):
        put(name, n)
    put("empty.json", None)
    (tmp_path / "else").mkdir()
    (tmp_path / "else" / "l.json").write_text('{"n": 20}')
    os.symlink(tmp_path / "else", tmp_path / "in" / "link")
    assert sidecars() == [0, 1, 2, 3, 4, 20]
    put("a b.json", 30)  # a path is taken once
    put("later.json", 31)
    assert sidecars(files_per_batch=1) == [0, 1, 2, 3, 4, 20, 31]


def test_a_checkpoint_of_a_stream_of_files_goes_on(spark, tmp_path, sidecars):
    """Until round 4 the stream read the files themselves, so its log names them."""
    for n in range(3):
        (tmp_path / "in" / f"{n}+%20.json").write_text('{"n": %d}' % n)
    schema = "path string, modificationTime timestamp, length long, content binary"
    old = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).load(str(tmp_path / "in"))
    keep = lambda batch, batch_id: batch.selectExpr("bigint(string(substr(content, 7, 1))) n").write.mode("overwrite").parquet(str(tmp_path / "out" / f"batch_id={batch_id}"))
    old.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    (tmp_path / "in" / "7.json").write_text('{"n": 7}')
    assert sidecars() == [0, 1, 2, 7]


def test_a_stream_that_goes_on_sees_later_files(spark, tmp_path, sidecars, monkeypatch):
    from corpusframe.streaming import ingest

    monkeypatch.setattr(ingest, "PAUSE", 1)
    (tmp_path / "in" / "0.json").write_text('{"n": 0}')
    query = sidecars(wait=False, trigger={"processingTime": "1 second"})
    try:
        for n in (0, 1):
            (tmp_path / "in" / f"{n}.json").write_text('{"n": %d}' % n)
            for _ in range(60):
                if (tmp_path / "out" / f"batch_id={n}" / "_SUCCESS").exists() or query.awaitTermination(1):
                    break
    finally:
        query.stop()
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1]
