"""Tables that grow by numbered commits: readers see whole commits or nothing.

A commit writes its tables to folders of their own first and then one small file, named by its number,
that lists them. That file is the commit: folders of a load that died are never listed, so they are never
read. Reading unions the listed folders. Compaction folds the commits of a table up to a number into one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusframe.functions.paths import clean_root
from corpusframe.sources import storage

VERSION = "_version"


class CommitLog:
    """One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, clean_root(root)

    def commits(self) -> list[dict]:
        """Every commit in order: its number, and the folder and schema of each of its tables; one small file each."""
        folder = f"{self.root}/_commits"
        if not storage.is_dir(folder):
            return []
        names = sorted(p for p, is_dir, *_ in storage.entries(folder) if not is_dir and p.endswith(".json"))
        found = []
        for name in names:
            with storage.open_binary(name) as handle:
                found.append(json.loads(handle.read()))
        return found

    @property
    def latest(self) -> int:
        """Number of the last commit, 0 before the first."""
        return max((c["version"] for c in self.commits()), default=0)

    def _write(self, df: DataFrame, name: str) -> dict:
        folder = f"{self.root}/{name}/{uuid.uuid4().hex}"
        df.write.parquet(folder)
        return {"folder": folder, "schema": df.schema.json()}

    def _record(self, version: int, tables: dict, base: bool) -> None:
        kind = "base" if base else "load"
        content = json.dumps({"version": version, "base": base, "tables": tables})
        storage.write_binary(f"{self.root}/_commits/{version:012d}-{kind}.json", content.encode())

    def commit(self, **tables: DataFrame) -> int:
        """Write the tables and make them visible together; the number of the commit."""
        version = self.latest + 1
        self._record(version, {name: self._write(df, name) for name, df in tables.items()}, base=False)
        return version

    def read(self, name: str, since: int = 0, until: int | None = None) -> DataFrame | None:
        """Rows of a table with the number of their commit in ``_version``; None where no commit has it.

        Commits after ``since`` up to ``until``. A compacted table starts from its last base that is not beyond
        ``until``, unless ``since`` asks for single commits, which stay readable.
        """
        from pyspark.sql.types import StructType

        known = [c for c in self.commits() if name in c["tables"] and (until is None or c["version"] <= until)]
        base = max((c["version"] for c in known if c["base"]), default=0) if not since else 0
        chosen = [c for c in known if (c["base"] and c["version"] == base) or (not c["base"] and c["version"] > max(since, base))]
        frames = []
        for c in chosen:
            schema = StructType.fromJson(json.loads(c["tables"][name]["schema"]))
            part = self.spark.read.schema(schema).parquet(c["tables"][name]["folder"])
            frames.append(part if VERSION in part.columns else part.withColumn(VERSION, F.lit(c["version"]).cast("long")))
        out = None
        for part in frames:
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out

    def compact(self, name: str, fold: Callable[[DataFrame], DataFrame]) -> None:
        """Fold a table's rows up to the last commit into one folder that later reads start from."""
        rows = self.read(name)
        if rows is not None:
            self._record(self.latest, {name: self._write(fold(rows), name)}, base=True)
