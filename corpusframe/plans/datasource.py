"""The files of a corpus as a Spark data source: ``spark.read.format("corpus").load(prepared)``.

``prepare`` lists the files of a ``glob`` spec once and stores the list by split and extension, cut
so that the files of one part have about an input split in bytes. The source plans one task a part: the options
``splits`` and ``extensions`` (lists as JSON) leave out whole parts before any task starts, and a file is opened only
if its ``content`` is asked for. The planner looks at the names of the parts alone, never at the list.

Filters are left to Spark: by trial, Spark 4.1.2 keeps the filters that a Python source took for one query of a
frame for its next queries too, so a source that takes them gives wrong rows when a frame is used twice.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corpusframe.functions import paths as P
from corpusframe.plans.layouts import check_spec, glob_rows, split_glob
from corpusframe.sources import storage
from corpusframe.sources.dealing import by_bytes
from corpusframe.sources.files import INLINE, scan_manifest
from corpusframe.spec import LoadSpec, SpecError

FORMAT = "corpus"
TEXTS = ("audio_path", "language", "speaker_id", "split", "name", "ext")
LISTED = T.StructType([T.StructField(c, T.StringType()) for c in TEXTS]).add("length", T.LongType()).add("modified", T.TimestampType())
CONTENT = "content"
OPTIONS = {"splits": "split", "extensions": "ext"}  # lists of texts as JSON
BATCH_ROWS = 4096
BATCH_BYTES = 32 << 20
#: What a part's folder is called for, and the column that it stands for.
FOLDERS = (("_split", "split"), ("_ext", "ext"))
#: Folder of null and empty partition values, marker of a complete write.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
COMPLETE = "_SUCCESS"


def prepare(spark: SparkSession, spec: LoadSpec | dict, root: str, target: str, manifest: DataFrame | None = None) -> None:
    """Store the files that ``load`` gives for a ``glob`` spec in folder ``target``, for the data source.

    ``split`` is null where the spec names no splits. As with ``load``, no match at all, or a split without one, is an error.
    """
    spec = spec if isinstance(spec, LoadSpec) else LoadSpec.from_dict(spec)
    check_spec(spec)
    if spec.root_strategy != "glob":
        raise SpecError("the data source reads corpora with root_strategy 'glob'")
    manifest = scan_manifest(spark, P.clean_root(root)) if manifest is None else manifest
    more = ["name", "ext", "length", "modified", *[c for c in INLINE if c in manifest.columns]]
    if spec.splits:
        rows = split_glob(manifest, spec.file_pattern, list(spec.splits), *more)
    else:
        rows = glob_rows(manifest, spec.file_pattern, F.lit(None).cast("string").alias("split"), *more)
        if rows.isEmpty():
            raise FileNotFoundError(f"no files match '{spec.file_pattern}'")
    # sorted, so that the equal ranges of bytes that tasks write hold few splits and extensions each
    dealt = by_bytes(rows.orderBy("split", "ext", "audio_path"), "length")
    folders = [F.col(column).alias(folder) for folder, column in FOLDERS]
    dealt.select("*", *folders).write.partitionBy(*[folder for folder, _ in FOLDERS]).parquet(target)


@dataclass
class Part(InputPartition):
    path: str


class CorpusReader(DataSourceReader):
    def __init__(self, target: str, schema: T.StructType, wanted: dict[str, list[str] | None]):
        self.target, self.schema, self.wanted = target, schema, wanted

    def _wanted(self, column: str, value: str | None) -> bool:
        """Whether a folder may hold files that are wanted; one without value holds nulls and empty texts."""
        return self.wanted[column] is None or (value or "") in self.wanted[column]

    def partitions(self) -> list[Part]:
        if not storage.is_file(f"{self.target}/{COMPLETE}"):
            raise FileNotFoundError(f"'{self.target}' holds no complete list of files; see corpusframe.plans.datasource.prepare")
        folders = [self.target]
        for prefix, column in FOLDERS:
            found = []
            for folder in folders:
                for path, is_dir, *_ in storage.entries(folder):
                    name, _, value = path.rsplit("/", 1)[-1].partition("=")
                    if is_dir and name == prefix and self._wanted(column, None if value == NO_VALUE else unquote(value)):
                        found.append(path)
            folders = found
        parts = (path for folder in folders for path, is_dir, *_ in storage.entries(folder) if not is_dir)
        return [Part(p) for p in sorted(parts) if p.endswith(".parquet")]

    def read(self, partition: Part | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no part is left
            return
        names = [f.name for f in self.schema]
        tests = {c: v for c, v in self.wanted.items() if v is not None}
        with storage.open_binary(partition.path) as handle:
            stored = pq.ParquetFile(handle)
            kept = {*names, "audio_path", *tests} | (set(INLINE) if CONTENT in names else set())
            listed = stored.read(columns=[c for c in stored.schema_arrow.names if c in kept])
        for column, values in tests.items():
            listed = listed.filter(pc.is_in(listed[column], pa.array(values, listed[column].type)))
        if CONTENT not in names:
            for batch in listed.to_batches(max_chunksize=BATCH_ROWS):
                yield self._shaped(batch, None)
            return
        for batch in listed.to_batches(max_chunksize=BATCH_ROWS):
            low, held, contents = 0, 0, []
            inline = batch.column("archived").to_pylist() if "archived" in batch.schema.names else [None] * len(batch)
            for row, (path, content) in enumerate(zip(batch.column("audio_path").to_pylist(), inline)):
                if content is None:
                    with storage.open_binary(path) as handle:
                        content = handle.read()
                contents.append(content)
                held += len(content)
                if held >= BATCH_BYTES or row == len(batch) - 1:
                    yield self._shaped(batch.slice(low, row + 1 - low), contents)
                    low, held, contents = row + 1, 0, []

    def _shaped(self, batch: pa.RecordBatch, contents: list | None) -> pa.RecordBatch:
        own = {"length": pa.int64(), "modified": pa.timestamp("us", "UTC"), CONTENT: pa.binary()}
        schema = pa.schema([(f.name, own.get(f.name, pa.string())) for f in self.schema])
        columns = [pa.array(contents, f.type) if f.name == CONTENT else batch.column(f.name).cast(f.type) for f in schema]
        return pa.RecordBatch.from_arrays(columns, schema=schema)


class CorpusFiles(DataSource):
    """One row a file: the listed columns, and its bytes where the schema given to the reader names ``content``.

    Columns are chosen with ``.schema("audio_path string, content binary")``, by the names and types of the full schema.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return LISTED

    def reader(self, schema: T.StructType) -> CorpusReader:
        target = self.options.get("path")
        if not target:
            raise SpecError("the data source needs the folder that 'prepare' wrote: .load(folder)")
        known = {**{f.name: f.dataType for f in LISTED}, CONTENT: T.BinaryType()}
        unlike = [f.name for f in schema if known.get(f.name) != f.dataType]
        if unlike:
            raise SpecError(f"not columns of the data source, or of another type: {unlike}")
        wanted = {column: json.loads(self.options[option]) if option in self.options else None for option, column in OPTIONS.items()}
        return CorpusReader(P.clean_root(target), schema, wanted)


def register_source(spark: SparkSession) -> None:
    """Make ``spark.read.format("corpus")`` known to a session."""
    spark.dataSource.register(CorpusFiles)


def read_files(spark: SparkSession, target: str, columns: list[str] | None = None, splits: list[str] | None = None, extensions: list[str] | None = None) -> DataFrame:
    """Files of a prepared list: the named columns (``content`` among them, if wanted), splits and extensions; None takes all."""
    register_source(spark)
    known = {f.name: f for f in [*LISTED, T.StructField(CONTENT, T.BinaryType())]}
    reader = spark.read.format(FORMAT).schema(T.StructType([known[c] for c in columns or LISTED.names]))
    for option, values in zip(OPTIONS, (splits, extensions)):
        if values is not None:
            reader = reader.option(option, json.dumps(values))
    return reader.load(target)
