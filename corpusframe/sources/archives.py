"""Archive members as rows, without unpacking to disk.

A compressed tar can only be read front to back, so it is one task. Members of zip and plain
tar files are listed once, into an index of where their bytes lie; many tasks then read just those ranges.
The index can be stored and used again.
"""

from __future__ import annotations

import struct
import tarfile
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from corpusframe.functions import paths as P
from corpusframe.sources import storage
from corpusframe.sources.dealing import by_bytes
from corpusframe.sources.files import io_tasks, glob_regex, manifest_of, union_all
from corpusframe.sources.scratch import written
from corpusframe.spec import LoadSpec

MEMBERS = "archive string, member string, length long, content binary"
#: Where a member lies: ``place`` is the offset of its bytes in a tar, of its local header in a zip;
#: ``method`` is how a zip packed it (-1: not packed, as in a tar), ``packed`` the bytes to read, ``crc`` their checksum.
LOCATED = "archive string, member string, length long, place long, packed long, method int, crc long"
SEEKABLE = r"(?i)\.(zip|tar)$"
_BATCH_ROWS, _BATCH_BYTES = 1024, 32 << 20
_UNSAFE = "<outside>"


def safe_member(name: str, zipped: bool) -> str:
    """Relative member name; a tar member that leaves the target is marked unsafe."""
    parts = [p for p in name.split("/") if p not in ("", ".")]
    if zipped:
        return "/".join(p for p in parts if p != "..")
    level = 0
    for part in parts:
        level += -1 if part == ".." else 1
        if level < 0:
            return _UNSAFE
    return "/".join(parts) if ".." not in parts else _UNSAFE


def _frames(rows: Iterator[tuple], columns: list[str], strict: bool) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for row in rows:
        if row[1] == _UNSAFE:
            if strict:
                raise ValueError(f"archive '{row[0]}' has a member outside its target folder")
            continue
        held.append(row)
        size += len(row[3]) if isinstance(row[3], bytes) else 0
        if len(held) >= _BATCH_ROWS or size >= _BATCH_BYTES:
            yield pd.DataFrame(held, columns=columns)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=columns)


def _stream(archive: str, keep) -> Iterator[tuple]:
    """(archive, member, length, content) front to back."""
    with storage.open_binary(archive) as raw:
        try:
            tar = tarfile.open(fileobj=raw, mode="r|*")
        except tarfile.ReadError as error:
            raise ValueError(f"unsupported archive '{archive}': only tar and zip") from error
        with tar:
            for info in tar:
                if info.isfile():
                    name = safe_member(info.name, zipped=False)
                    content = tar.extractfile(info).read() if keep(name) else None
                    yield archive, name, info.size, content


def _locate(archive: str) -> Iterator[tuple]:
    """Rows of ``LOCATED`` for a seekable archive, from its directory or headers alone."""
    with storage.open_binary(archive) as raw:
        if zipfile.is_zipfile(raw):
            raw.seek(0)
            with zipfile.ZipFile(raw) as packed:
                for info in packed.infolist():
                    if not info.is_dir():
                        method = _ODD if info.flag_bits & _ENCRYPTED else info.compress_type
                        yield archive, safe_member(info.filename, zipped=True), info.file_size, info.header_offset, info.compress_size, method, info.CRC
            return
        raw.seek(0)
        with tarfile.open(fileobj=raw, mode="r:") as tar:
            for info in tar:
                if info.isfile():
                    yield archive, safe_member(info.name, zipped=False), info.size, info.offset_data, info.size, _PLAIN, 0


_PLAIN, _ODD, _ENCRYPTED = -1, -2, 1
_LOCAL_HEADER, _HEADER_BYTES = "<4s5H3L2H", 30  # fixed layout of a zip's local file header


def _ranged(raw, row) -> bytes:
    """A member's bytes from its own range: a zip's member has a short header before them."""
    raw.seek(row.place)
    if row.method == _PLAIN:
        return raw.read(row.length)
    fields = struct.unpack(_LOCAL_HEADER, raw.read(_HEADER_BYTES))
    if fields[0] != b"PK\3\4":
        raise ValueError(f"archive '{row.archive}' has no member where '{row.member}' was listed; list it again")
    raw.seek(row.place + _HEADER_BYTES + fields[9] + fields[10])
    content = raw.read(row.packed)
    if row.method == zipfile.ZIP_DEFLATED:
        content = zlib.decompress(content, -zlib.MAX_WBITS)
    if len(content) != row.length or zlib.crc32(content) != row.crc:
        raise ValueError(f"member '{row.member}' of archive '{row.archive}' is damaged")
    return content


def _whole(raw, row) -> bytes:
    """A member packed in a rare way, through the archive's own directory."""
    with zipfile.ZipFile(raw) as packed:
        return packed.read(next(i for i in packed.infolist() if i.header_offset == row.place))


def _fetch(batch: pd.DataFrame) -> Iterator[tuple]:
    for archive, rows in batch.groupby("archive", sort=False):
        with storage.open_binary(archive) as raw:
            for row in rows.sort_values("place").itertuples():
                near = row.method in (_PLAIN, zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED)
                yield archive, row.member, row.length, (_ranged if near else _whole)(raw, row)


def member_index(archives: DataFrame, on_error: str = "fail") -> DataFrame:
    """``LOCATED`` rows of the members of zip and plain tar files in ``archives.path``, one task an archive.

    Write it beside the archives to fetch members again without listing them; it is valid while they are.
    """
    columns = [part.split()[0] for part in LOCATED.split(", ")]

    def located(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive in batch["path"]:
                yield from _frames(_locate(archive), columns, on_error == "fail")

    return by_bytes(archives.select("path", F.lit(None).cast("long").alias("length"))).select("path").mapInPandas(located, LOCATED)


def fetch_members(index: DataFrame) -> DataFrame:
    """(archive, member, length, content) of the index rows given, in tasks of equal bytes; nothing else is read."""

    def fetched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from _frames(_fetch(batch), ["archive", "member", "length", "content"], False)

    return by_bytes(index, "packed").mapInPandas(fetched, MEMBERS)


def archive_members(
    archives: DataFrame, content_of: str | None = None, on_error: str = "fail"
) -> DataFrame:
    """(archive, member, length, content) of every archive in ``archives.path``.

    ``content_of`` is a regex over member names; other members come with null content, so
    media is listed but never carried.
    """
    import re

    strict = on_error == "fail"
    wanted = re.compile(content_of) if content_of is not None else None

    def keep(name: str) -> bool:
        return wanted is not None and bool(wanted.search(name))

    def streamed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive in batch["path"]:
                yield from _frames(_stream(archive, keep), ["archive", "member", "length", "content"], strict)

    tasks = io_tasks(archives.sparkSession)
    paths = archives.select("path")
    seekable = F.col("path").rlike(SEEKABLE)
    one_task_each = paths.filter(~seekable).repartition(tasks, "path").mapInPandas(streamed, MEMBERS)
    places = member_index(archives.filter(seekable), on_error)
    if content_of is None:
        return one_task_each.unionByName(
            places.select("archive", "member", "length", F.lit(None).cast("binary").alias("content"))
        )
    places = written(places, "members")
    chosen = F.col("member").rlike(content_of)
    rest = places.filter(~chosen).select(
        "archive", "member", "length", F.lit(None).cast("binary").alias("content")
    )
    return union_all([one_task_each, fetch_members(places.filter(chosen)), rest])


def find_archives(manifest: DataFrame, names: list[str], root: str) -> list[str]:
    """Path of each named archive: the literal path, else the shallowest file of that name."""
    base = {name: name.rsplit("/", 1)[-1] for name in names}
    literal = {name: P.resolve_under(root, name) for name in names}
    rank = F.struct(~F.col("path").isin(*literal.values()), "depth", "path")
    found = (
        manifest.filter(F.col("name").isin(*base.values()))
        .groupBy("name")
        .agg(F.min_by("path", rank).alias("path"), F.collect_set(F.when(F.col("path").isin(*literal.values()), F.col("path"))).alias("exact"))
        .collect()  # one row per archive name in the spec
    )
    by_name = {r["name"]: r for r in found}
    paths = []
    for name in names:
        row = by_name.get(base[name])
        if row is None:
            raise FileNotFoundError(f"inner archive '{name}' not found under '{root}'")
        paths.append(literal[name] if literal[name] in row["exact"] else row["path"])
    return list(dict.fromkeys(paths))


def sidecar_pattern(spec: LoadSpec) -> str:
    """Members whose bytes a load may need: indexes, sidecars and text of content columns."""
    globs = [spec.file_pattern, spec.splits_file_pattern, spec.index_file]
    if spec.root_strategy == "multi_split" and not spec.splits_file_pattern:
        globs.append("**/*.tsv")
    patterns = [glob_regex(g.rsplit("/", 1)[-1]) for g in globs if g]
    for column in spec.columns.values():
        if column.dtype == "file_content":
            extension = P.clean_extension(column.file_extension)
            patterns.append(r"(?i)\Q" + extension + r"\E$" if extension else ".")
    return "|".join(f"(?:{p})" for p in patterns) or "(?!)"


def with_inner_archives(manifest: DataFrame, spec: LoadSpec, root: str) -> DataFrame:
    """The manifest plus the members of the archives the spec names.

    Members appear beside their archive, as if unpacked there; sidecar members carry their
    bytes in ``archived``. The members are written to the shared scratch folder once, so
    an archive is read once per load.
    """
    spark = manifest.sparkSession
    paths = find_archives(manifest, list(spec.extract_files), root)
    archives = spark.createDataFrame([(p,) for p in paths], "path string")
    members = written(archive_members(archives, _python_regex(sidecar_pattern(spec))), "members")
    # members of the same name: the archive listed last wins, as when unpacking in that order
    order = F.element_at(F.create_map(*[F.lit(x) for i, p in enumerate(paths) for x in (p, i)]), F.col("archive"))
    placed = members.withColumn("order", order).select(
        "order",
        P.join(P.parent_dir(F.col("archive")), F.col("member")).alias("path"),
        "length",
        F.col("content").alias("archived"),
    )
    plain = manifest.select("path", "length", "modified")
    unpacked = placed.groupBy("path").agg(
        F.max_by(F.struct("length", "archived"), "order").alias("last")
    ).select("path", "last.*")
    kept = plain.join(unpacked.select("path"), "path", "left_anti")
    return manifest_of(kept.unionByName(unpacked, allowMissingColumns=True), root)


def _python_regex(pattern: str) -> str:
    """Quote markers to plain escapes, so one pattern serves the JVM and Python."""
    import re

    return re.sub(r"\\Q(.*?)\\E", lambda m: re.escape(m.group(1)), pattern)
