"""Versioned file manifests: every snapshot is stored as what changed since the one before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusframe.sources.commits import VERSION, CommitLog

DELTAS = "deltas"
ADDED, CHANGED, GONE = "added", "changed", "gone"


def _same(a: str, b: str, values: list[str]) -> Column:
    alike = F.lit(True)
    for v in values:
        alike = alike & F.col(f"{a}.{v}").eqNullSafe(F.col(f"{b}.{v}"))
    return alike


class Snapshots:
    """Manifests by version. ``key`` names a file, ``values`` tell whether it changed.

    A null key is no file and left out; of repeated keys the row with the greatest values counts. An empty
    manifest makes every file gone. Versions count from 1.
    """

    def __init__(self, log: CommitLog, key: str = "path", values: tuple[str, ...] = ("length", "modified")):
        self.log, self.key, self.values = log, key, list(values)

    def _struct(self, name: str) -> Column:
        return F.struct(*self.values).alias(name)

    def take(self, manifest: DataFrame) -> int:
        """Store a manifest as the next version; only its difference from the last one is written."""
        now = manifest.filter(F.col(self.key).isNotNull()).select(self.key, self._struct("now")).groupBy(self.key).agg(F.max("now").alias("now"))
        last = self.state()
        if last is None:
            delta = now.select(self.key, F.lit(ADDED).alias("change"), "now", F.lit(None).cast(now.schema["now"].dataType).alias("was"))
        else:
            both = now.withColumn("_here", F.lit(True)).join(last.select(self.key, self._struct("was"), F.lit(True).alias("_there")), self.key, "full")
            change = F.when(F.col("_there").isNull(), ADDED).when(F.col("_here").isNull(), GONE).when(~_same("now", "was", self.values), CHANGED)
            delta = both.withColumn("change", change).filter("change is not null").select(self.key, "change", "now", "was")
        return self.log.commit(**{DELTAS: delta})

    def _last(self, rows: DataFrame) -> DataFrame:
        newest = F.max_by(F.struct("change", "now", F.col(VERSION).alias("v")), VERSION).alias("l")
        return rows.groupBy(self.key).agg(newest).filter(F.col("l.change") != GONE)

    def state(self, version: int | None = None) -> DataFrame | None:
        """The manifest at a version, the last one by default; None before the first."""
        rows = self.log.read(DELTAS, until=version)
        if rows is None:
            return None
        return self._last(rows).select(self.key, *[F.col(f"l.now.{v}").alias(v) for v in self.values])

    def deltas(self) -> DataFrame | None:
        """(version, key, change, values) of every commit since the last compaction."""
        rows = self.log.read(DELTAS)
        return rows if rows is None else rows.select(F.col(VERSION).alias("version"), self.key, "change", *[F.coalesce(f"now.{v}", f"was.{v}").alias(v) for v in self.values])

    def changes(self, since: int, until: int | None = None) -> DataFrame | None:
        """(key, change, values) between two versions, read from the commits between them alone.

        A file that came and went between them, or went and came back as it was, is no change; of a file
        that is gone the values are the last ones it had at ``since``.
        """
        rows = self.log.read(DELTAS, since=since, until=until)
        if rows is None:
            return None
        ends = rows.groupBy(self.key).agg(
            F.min_by(F.struct("change", "was"), VERSION).alias("first"),
            F.max_by(F.struct("change", "now"), VERSION).alias("last"),
        )
        there, here = F.col("first.change") != ADDED, F.col("last.change") != GONE
        change = F.when(~there & here, ADDED).when(there & ~here, GONE).when(there & here & ~_same("first.was", "last.now", self.values), CHANGED)
        found = ends.withColumn("change", change).filter("change is not null")
        return found.select(self.key, "change", *[F.when(F.col("change") == GONE, F.col(f"first.was.{v}")).otherwise(F.col(f"last.now.{v}")).alias(v) for v in self.values])

    def compact(self) -> None:
        """Fold the versions so far into one manifest; ``changes`` between them can still be read."""

        def fold(rows: DataFrame) -> DataFrame:
            none = F.lit(None).cast(rows.schema["was"].dataType).alias("was")
            return self._last(rows).select(self.key, F.lit(ADDED).alias("change"), F.col("l.now").alias("now"), none, F.col("l.v").alias(VERSION))

        self.log.compact(DELTAS, fold)
