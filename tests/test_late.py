from datetime import datetime, timedelta

from corpusframe.streaming.late import await_media, write_told

START = datetime(2024, 5, 1, 12)
ROWS, FILES = "n int, path string, at timestamp, note string", "path string, at timestamp"


def minutes(n):
    return START + timedelta(minutes=n)


def test_each_row_is_told_once_over_restarts(spark, tmp_path):
    landings = [
        # there at once, comes later, never comes, no path, no time, twice the same row
        ([(1, "a", minutes(0), None), (2, "b", minutes(1), "x"), (3, "c", minutes(2), "y"), (4, None, minutes(3), None), (5, "a", None, None), (6, "b", minutes(1), "x"), (6, "b", minutes(1), "x")], [("a", minutes(0)), (None, minutes(0))]),
        ([(7, "b", minutes(20), None)], [("b", minutes(30)), ("b", minutes(31))]),
        ([(8, "d", minutes(200), None)], []),
        # c was given up, counts for later rows; d is in time
        ([(9, "c", minutes(215), None)], [("c", minutes(210)), ("d", minutes(230))]),
    ]
    told = []
    for rows, files in landings:
        spark.createDataFrame(rows, ROWS).write.mode("append").parquet(str(tmp_path / "rows"))
        spark.createDataFrame(files, FILES).write.mode("append").parquet(str(tmp_path / "files"))
        both = [spark.readStream.schema(s).parquet(str(tmp_path / n)) for s, n in ((ROWS, "rows"), (FILES, "files"))]
        write_told(await_media(*both, "path", "at", timedelta(hours=1)), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        told.append(sorted((r.n, r._found) for r in spark.read.parquet(str(tmp_path / "out")).collect()))
    first = [(1, True), (4, False), (5, False)]
    assert told[0] == first
    assert told[1] == sorted(first + [(2, True), (6, True), (6, True), (7, True)])
    assert told[2] == sorted(told[1] + [(3, False)])
    assert told[3] == sorted(told[2] + [(8, True), (9, True)])
    notes = {r.n: r.note for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert notes[2] == "x" and notes[3] == "y" and notes[1] is None


def test_waiting_rows_need_no_python_state(spark, tmp_path):
    """Rows wait as stored tables that batches join, also those that come after their time is up."""
    for n, (rows, files) in enumerate([([(1, "a", minutes(0), None), (2, "b", minutes(100), None)], []), ([(3, "c", minutes(5), None), (4, "b", minutes(5), None)], [("b", minutes(101))])]):
        spark.createDataFrame(rows, ROWS).write.mode("append").parquet(str(tmp_path / "rows"))
        spark.createDataFrame(files, FILES).write.mode("append").parquet(str(tmp_path / "files"))
        both = [spark.readStream.schema(s).parquet(str(tmp_path / d)) for s, d in ((ROWS, "rows"), (FILES, "files"))]
        query = write_told(await_media(*both, "path", "at", timedelta(hours=1)), str(tmp_path / "out"), str(tmp_path / "state"))
        query.awaitTermination()
        assert not query.lastProgress.stateOperators
    told = sorted((r.n, r._found) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert told == [(1, False), (2, True), (3, False), (4, True)]
