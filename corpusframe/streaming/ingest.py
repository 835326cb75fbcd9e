"""Incremental loads: newly landed index files or JSON sidecars, each taken once.

A file stream with a checkpoint remembers what it has read. Every micro-batch is mapped and
resolved like a batch load and overwrites its own ``batch_id`` folder, so a batch that is
retried after a failure replaces its earlier output instead of adding to it.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusframe.functions import paths as P
from corpusframe.functions.text import decode
from corpusframe.operators.mapping import Corpus, map_columns
from corpusframe.operators.sidecars import explode_records
from corpusframe.plans.layouts import json_frame
from corpusframe.sources.delimited import (
    IndexFrame,
    check_headers,
    plan_read,
    positional_schema,
    reader_options,
    tidy,
)
from corpusframe.sources.dealing import OPEN_COST, by_count
from corpusframe.sources.files import glob_regex, io_tasks, list_files, read_listed
from corpusframe.sources.scratch import fresh_folder
from corpusframe.spec import LoadSpec

BATCH = "batch_id"
FILES_PER_BATCH = 10_000  # bounds the files of one micro-batch
_CONTENTS = "path string, modificationTime timestamp, length long, content binary"
LISTED = "path string, length long, modified timestamp"
PAUSE = 10  # seconds between two listings of a stream that goes on
# names that Spark's readers pass over, at any depth
_PASSED_OVER = r"(^|/)(\.|_(?!(common_)?metadata[^/]*/)(?![^/]*=)|[^/]*\._COPYING_(/|$))"
# by default four small files or one listed path make a task, and each task sends its own result to the driver
_OPEN_COST, _LISTERS = "spark.sql.files.openCostInBytes", "spark.sql.sources.parallelPartitionDiscovery.parallelism"


Hold = Callable[[DataFrame], DataFrame]


def _plain(uri: str) -> Column:
    """The path of an encoded URI."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "/")


def _session(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` whose file streams deal many small files to few tasks."""
    own = spark.newSession()
    for name, value in dict(spark.conf.getAll).items():
        if spark.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set(_OPEN_COST, str(OPEN_COST))
    own.conf.set(_LISTERS, str(io_tasks(spark)))
    return own


def _run(
    spark: SparkSession,
    stream: DataFrame,
    to_frame: Callable[[DataFrame, Hold], IndexFrame],
    spec: LoadSpec,
    corpus: Corpus,
    target: str,
    checkpoint: str,
    trigger: dict | None,
    first: int = 0,
) -> StreamingQuery:
    folder = fresh_folder(spark, "landed")

    def hold(rows: DataFrame) -> DataFrame:
        # Landed files are read once; what they hold is passed over several times. A written table, which the next
        # batch replaces, and not a cached one: Spark shares no shuffle between two passes over a cached table.
        rows.write.mode("overwrite").parquet(folder)
        return rows.sparkSession.read.schema(rows.schema).parquet(folder)

    def take(batch: DataFrame, batch_id: int) -> None:
        mapped = map_columns(to_frame(batch, hold), spec, corpus)
        mapped.write.mode("overwrite").parquet(f"{target}/{BATCH}={first + batch_id}")

    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def stream_index(
    spark: SparkSession,
    landing: str,
    spec: LoadSpec,
    corpus: Corpus,
    target: str,
    checkpoint: str,
    trigger: dict | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Map index files as they land below ``landing``; one with another header stops the stream."""
    separator, names = plan_read(spec, landing)
    options = reader_options(spec, separator)
    reader = _session(spark).readStream.schema(positional_schema(len(names))).options(**options)
    multi_line = not spec.extra.get("single_line")
    reader = reader.option("multiLine", multi_line).option("maxFilesPerTrigger", files_per_batch)
    stream = reader.option("recursiveFileLookup", True).csv(landing).select("*", F.col("_metadata.file_path").alias("_landed"))
    # the metadata column gives an encoded URI; it is decoded once a file, not once a row
    landed = _plain("_landed").alias("path")

    def to_frame(batch: DataFrame, hold: Hold) -> IndexFrame:
        held = hold(batch)
        check_headers(held.select("_landed").distinct().select(landed), spec, separator, names)
        return IndexFrame(tidy(held, len(names), corpus.on_error), names)

    return _run(spark, stream, to_frame, spec, corpus, target, checkpoint, trigger)


def stream_sidecars(
    spark: SparkSession,
    landing: str,
    spec: LoadSpec,
    corpus: Corpus,
    target: str,
    checkpoint: str,
    trigger: dict | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Map JSON sidecars as they land; a source absent from a record is null.

    Spark's file stream would keep the names of all files in the driver. Tasks list the landed files, and those not
    yet noted are written below the checkpoint as lists of ``files_per_batch``; the stream is one of lists. With a
    trigger that goes on, ``landing`` is listed again every ten seconds.
    """
    spark.readStream.format("binaryFile").schema(_CONTENTS).load(landing)  # an error where there is no such folder
    lists, listing = f"{checkpoint}/arrivals", fresh_folder(spark, "listing")
    first, earlier = _stream_of_files(spark, checkpoint)

    def note() -> None:
        _note_arrivals(spark, landing, spec.file_pattern or "*.json", earlier, lists, listing, files_per_batch)

    spark.range(0).write.mode("overwrite").parquet(f"{lists}/_begun")  # a stream's folder has to be there
    note()
    stream = _session(spark).readStream.schema(LISTED).option("maxFilesPerTrigger", 1).parquet(lists)

    def to_frame(batch: DataFrame, hold: Hold) -> IndexFrame:
        text = decode(F.col("content"), spec.encoding)
        parsed = F.parse_json(text) if corpus.on_error == "fail" else F.try_parse_json(text)
        landed = read_listed(batch).select("path", parsed.alias("doc"))
        records = explode_records(landed, spec.record_path, corpus.on_error)
        frame = json_frame(records, spec, check=False)
        return IndexFrame(hold(frame.rows), frame.names)

    query = _run(spark, stream, to_frame, spec, corpus, target, f"{checkpoint}/stream", trigger, first)
    if trigger and not {"availableNow", "once"} & set(trigger):
        threading.Thread(target=_keep_noting, args=(query, note), daemon=True).start()
    return query


def _stream_of_files(spark: SparkSession, checkpoint: str) -> tuple[int, DataFrame | None]:
    """Of a checkpoint from before round 4, whose stream read the files themselves: how many batches it ended, and their paths."""
    number = F.col("_metadata.file_name").try_cast("int")
    try:
        last = spark.read.text(f"{checkpoint}/commits").agg(F.max(number)).first()[0]
    except AnalysisException:
        last = None
    if last is None:
        return 0, None
    offset = F.get_json_object("value", "$.logOffset").cast("int")
    until = spark.read.text(f"{checkpoint}/offsets").filter(number == last).agg(F.max(offset)).first()[0]
    entries = spark.read.text(f"{checkpoint}/sources/0").filter(F.get_json_object("value", "$.batchId").cast("int") <= until)
    return last + 1, entries.select(F.get_json_object("value", "$.path").alias("uri")).select(_plain("uri").alias("path"))


def _note_arrivals(spark: SparkSession, landing: str, pattern: str, earlier: DataFrame | None, lists: str, listing: str, most: int) -> None:
    """Write lists of the files that landed and that no list has, oldest first, each of ``most`` files."""
    root = P.clean_root(landing)
    below = P.relative_to(F.col("path"), F.lit(root))
    wanted = below.rlike(glob_regex(pattern)) & ~below.rlike(_PASSED_OVER) & (F.col("length") > 0)
    landed = list_files(spark, root, follow_links=True, target=listing).filter(wanted)
    taken = spark.read.schema(LISTED).parquet(lists).select("path")
    taken = taken if earlier is None else taken.union(earlier)
    fresh = by_count(landed.join(taken, "path", "left_anti"), most, "modified", "path")
    if fresh is not None:
        fresh.write.mode("append").parquet(lists)


def _keep_noting(query: StreamingQuery, note: Callable[[], None]) -> None:
    try:
        while not query.awaitTermination(PAUSE):
            note()
    except StreamingQueryException:
        return  # told to whoever awaits the query
    except Exception:
        query.stop()
        raise


def loaded_so_far(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.option("basePath", target).parquet(target).drop(BATCH)
