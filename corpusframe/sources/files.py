"""File listings, file contents and file digests as DataFrames."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusframe.functions import paths as P
from corpusframe.sources import storage
from corpusframe.sources.dealing import by_bytes
from corpusframe.sources.scratch import fresh_folder

LISTING = "path string, is_dir boolean, length long, modified double"
# bytes of archive members, which no file system can open
INLINE = ("archived",)
_BATCH_ROWS = 4096
_BATCH_BYTES = 32 << 20
_CHUNK = 4 << 20


def io_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _pages(rows: Iterable[tuple]) -> Iterator[pd.DataFrame]:
    held: list = []
    for row in rows:
        held.append(row)
        if len(held) >= _BATCH_ROWS:
            yield pd.DataFrame(held, columns=["path", "is_dir", "length", "modified"])
            held = []
    if held:
        yield pd.DataFrame(held, columns=["path", "is_dir", "length", "modified"])


def _list_names(follow_links: bool):
    def act(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _pages(entry for batch in batches for path in batch["path"] for entry in storage.entries(path, follow_links))

    return act


def _look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = batch.itertuples(index=False, name=None)
        yield from _pages(found for row in rows if (found := storage.looked_up(row)) is not None)


def list_files(spark: SparkSession, roots: str | Iterable[str], follow_links: bool = False, target: str | None = None) -> DataFrame:
    """Recursive listing of files, hidden ones included, one Spark job per directory level.

    Directories of a level are listed by tasks in parallel and every level is written to the
    shared scratch folder, so the driver holds no listing. A directory is read page by page for its
    names only; sizes and times of the names, the slow part, are looked up by all tasks, also
    where a level is one huge directory. Missing roots give no rows. ``follow_links`` enters directories
    that are links; ``target`` is a folder for the levels that the next listing replaces.
    """
    starts = [P.clean_root(r) for r in ([roots] if isinstance(roots, str) else roots)]
    target = target or fresh_folder(spark, "listing")
    frontier = spark.createDataFrame([(s,) for s in sorted(set(starts))], "path string")
    levels: list[str] = []
    while True:
        levels.append(f"{target}/level_{len(levels):04d}")
        names = frontier.mapInPandas(_list_names(follow_links), LISTING).repartition(io_tasks(spark), "path")
        names.mapInPandas(_look_up, LISTING).write.mode("overwrite").parquet(levels[-1])
        level = spark.read.schema(LISTING).parquet(levels[-1])
        directories = level.filter("is_dir").select("path")
        if directories.isEmpty():
            break
        frontier = directories.repartition(io_tasks(spark), "path")
    return (
        spark.read.schema(LISTING)
        .parquet(*levels)
        .filter(~F.col("is_dir"))
        .select("path", "length", F.col("modified").cast("timestamp").alias("modified"))
    )


def manifest_of(files: DataFrame, root: str) -> DataFrame:
    """Path columns for any listing that has a ``path`` column (absolute paths)."""
    base = P.clean_root(root)
    path = F.col("path")
    known = {
        "length": F.lit(None).cast("long"),
        "modified": F.lit(None).cast("timestamp"),
    }
    carried = [F.col(c) if c in files.columns else known[c].alias(c) for c in known]
    return files.filter(P.is_under(path, base)).select(
        path,
        P.relative_to(path, base).alias("rel_path"),
        P.parent_dir(path).alias("parent_dir"),
        P.basename(path).alias("name"),
        P.stem(path).alias("stem"),
        P.suffix(path).alias("ext"),
        P.part_from_end(path, 2).alias("parent"),
        P.part_from_end(path, 3).alias("grandparent"),
        P.depth(path).alias("depth"),
        *carried,
        *[F.col(c) for c in files.columns if c in INLINE],
    )


def scan_manifest(spark: SparkSession, root: str) -> DataFrame:
    return manifest_of(list_files(spark, root), root)


def visible() -> Column:
    """Drops the '._' companion files that some systems leave beside real ones."""
    return ~F.col("name").startswith("._")


def has_extension(extension: str | None) -> Column:
    cleaned = P.clean_extension(extension)
    return F.lit(True) if cleaned is None else F.lower("ext") == cleaned.lower()


def _read_contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        start, held = 0, 0
        contents: list[bytes] = []
        archived = batch["archived"] if "archived" in batch else [None] * len(batch)
        carried = batch.drop(columns="archived", errors="ignore")
        for position, (path, inline) in enumerate(zip(batch["path"], archived)):
            if inline is None:
                with storage.open_binary(path) as handle:
                    inline = handle.read()
            contents.append(inline)
            held += len(inline)
            if held >= _BATCH_BYTES or position == len(batch) - 1:
                yield carried.iloc[start : position + 1].assign(content=contents)
                start, held, contents = position + 1, 0, []


def read_contents(files: DataFrame, *keep: str) -> DataFrame:
    """(path, *keep, content) of exactly the listed files; archive members bring their bytes along."""
    wanted = files.select("path", *keep, *[c for c in INLINE if c in files.columns], _length(files))
    schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema if f.name not in ("archived", "_length")
    )
    return by_bytes(wanted, "_length").drop("_length").mapInPandas(_read_contents, schema + ", content binary")


def read_listed(files: DataFrame) -> DataFrame:
    """(path, content) of the listed files (path, length, modified) that are still there and hold something.

    One shuffle: rows are dealt to tasks in turn, so where the list begins with its largest files no task reads
    more than the mean and one file. Lengths are looked up again, but those of remote files.
    """
    tasks, remote = io_tasks(files.sparkSession), F.col("path").rlike(storage.URI)
    noted = [F.lit(False).alias("is_dir"), F.when(remote, F.col("length")).alias("length"), F.when(remote, F.col("modified").cast("double")).alias("modified")]
    dealt = files.select("path", *noted, F.pmod(F.monotonically_increasing_id(), F.lit(tasks)).cast("int").alias("_task"))
    there = dealt.repartitionById(tasks, "_task").drop("_task").mapInPandas(_look_up, LISTING).filter("length > 0")
    return there.select("path").mapInPandas(_read_contents, "path string, content binary")


def _length(files: DataFrame) -> Column:
    return (F.col("length") if "length" in files.columns else F.lit(None).cast("long")).alias("_length")


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sizes, sums = [], []
        for path in batch["path"]:
            hasher, size = hashlib.sha256(), 0
            with storage.open_binary(path) as handle:
                while chunk := handle.read(_CHUNK):
                    hasher.update(chunk)
                    size += len(chunk)
            sizes.append(size)
            sums.append(hasher.hexdigest())
        yield pd.DataFrame({"path": batch["path"], "bytes_read": sizes, "sha256": sums})


def file_digests(files: DataFrame) -> DataFrame:
    """(path, bytes_read, sha256); files of any size are streamed in chunks."""
    spread = by_bytes(files.select("path", _length(files)), "_length")
    return spread.select("path").mapInPandas(_digest, "path string, bytes_read long, sha256 string")


def _write_contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            storage.write_again(path, bytes(content))
        yield pd.DataFrame({"path": batch["path"]})


def write_files(files: DataFrame) -> int:
    """Write one file per (path, content) row from the tasks; returns the number written."""
    spread = files.select("path", "content").repartition(io_tasks(files.sparkSession), "path")
    return spread.mapInPandas(_write_contents, "path string").count()


def glob_regex(pattern: str) -> str:
    """Regex for a recursive glob: matches a relative path at any depth.

    '*' and '?' stay inside a path part, '**' as a whole part spans parts, [..] is a set.
    """
    parts = [p for p in pattern.split("/") if p not in ("", ".")]
    pieces: list[str] = []
    for position, part in enumerate(parts):
        last = position == len(parts) - 1
        if part == "**":
            pieces.append(".*" if last else "(?:[^/]+/)*")
        else:
            pieces.append(_glob_part(part) + ("" if last else "/"))
    return "^(?:[^/]+/)*" + "".join(pieces) + "$"


def _glob_part(part: str) -> str:
    out, i = [], 0
    while i < len(part):
        char = part[i]
        i += 1
        if char == "*":
            out.append("[^/]*")
        elif char == "?":
            out.append("[^/]")
        elif char == "[" and (end := part.find("]", i + 1)) != -1:
            body = part[i:end].replace("\\", "\\\\").replace("[", "\\[").replace("&", "\\&")
            out.append("[^" + body[1:] + "]" if body[0] in "!^" else "[" + body + "]")
            i = end + 1
        else:
            out.append("\\" + char if not char.isalnum() and char.isascii() else char)
    return "".join(out)


def matches_glob(pattern: str) -> Column:
    return F.col("rel_path").rlike(glob_regex(pattern))


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; a column a frame lacks becomes null, first-seen order is kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
