"""Finding index, split and section files in a manifest."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from corpusframe.functions import paths as P
from corpusframe.sources.files import glob_regex

_GLOB_CHARS = re.compile(r"[*?\[]")


def shallowest(manifest: DataFrame, keys: list[str], value: str = "path") -> DataFrame:
    """Per key the path with the fewest parts; ties go to the smaller path."""
    return manifest.groupBy(*keys).agg(F.min_by(value, F.struct("depth", value)).alias(value))


def in_order(manifest: DataFrame) -> DataFrame:
    """Files as a report lists them: the fewest parts first, then by path."""
    return manifest.orderBy("depth", "path")


def index_paths(index_file: str) -> Column:
    """Relative paths a manifest row may be an index under, given the index name or glob.

    A file is its own index; a data file also stands for the folder it is a shard of.
    """
    if _GLOB_CHARS.search(index_file):
        pattern = glob_regex(index_file)
    else:
        parts = [p for p in index_file.split("/") if p not in ("", ".")]
        pattern = "^(?:[^/]+/)*" + "/".join("\\Q" + p + "\\E" for p in parts) + "$"
    rel = F.col("rel_path")
    folder = F.when(rel.contains("/"), P.parent_dir(rel))
    shard = ~F.col("name").rlike("^[_.]")
    return F.array_compact(
        F.array(
            F.when(rel.rlike(pattern), rel),
            F.when(shard & folder.rlike(pattern), folder),
        )
    )


def index_candidates(manifest: DataFrame, index_file: str) -> DataFrame:
    """(path, depth) of every index of that name; shards of one index count once."""
    root = F.expr("left(path, length(path) - length(rel_path))")
    return (
        manifest.select(root.alias("root"), F.explode(index_paths(index_file)).alias("index"))
        .select(F.concat("root", "index").alias("path"))
        .distinct()
        .withColumn("depth", P.depth(F.col("path")))
    )


def locate_index(manifest: DataFrame, index_file: str) -> str:
    """The shallowest index of that name."""
    row = index_candidates(manifest, index_file).agg(
        F.min_by("path", F.struct("depth", "path")).alias("path")
    ).first()
    if row is None or row["path"] is None:
        raise FileNotFoundError(f"index file '{index_file}' not found")
    return row["path"]


def dataset_root(index_path: str, index_file: str) -> str:
    """Folder that ``index_file`` is relative to."""
    if index_file.startswith("/"):
        return index_file.rsplit("/", 1)[0]
    parts = [p for p in index_file.split("/") if p not in ("", ".")]
    return "/".join(index_path.split("/")[: -len(parts)])


def root_of(path: Column, index_file: str) -> Column:
    """``dataset_root`` for a column of index paths."""
    parts = len([p for p in index_file.split("/") if p not in ("", ".")])
    return F.regexp_replace(path, f"(/[^/]+){{{parts}}}$", "")


def split_indexes(manifest: DataFrame, pattern: str, splits: list[str]) -> DataFrame:
    """(stem, path): per listed split the shallowest file (or shard folder) with that stem."""
    files = index_candidates(manifest, pattern).withColumn("stem", P.stem(F.col("path")))
    return shallowest(files.filter(F.col("stem").isin(*splits)), ["stem"])


def missing_folders(manifest: DataFrame, names: list[str]) -> DataFrame:
    """Listed first-level folders that hold no file."""
    listed = manifest.sparkSession.createDataFrame([(n,) for n in names], "folder string")
    present = manifest.filter("depth > 0").select(
        F.substring_index("rel_path", "/", 1).alias("folder")
    ).distinct()
    return listed.join(present, "folder", "left_anti")
