"""Category dictionaries: each value has a whole number that no later load changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corpusframe.operators.skew import lookup
from corpusframe.sources.commits import VERSION, CommitLog
from corpusframe.sources.scratch import written


def numbered(values: DataFrame, start: int) -> DataFrame:
    """(value, code): codes from ``start`` on without gaps, in the order of the values.

    The values are sorted by ranges and written; a count for each range, one row a task, gives its first number.
    """
    ordered = written(values.orderBy("value").withColumn("_at", F.monotonically_increasing_id()), "values")
    part = F.shiftright("_at", 33).alias("_part")
    counts = ordered.groupBy(part).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_low"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_low") + start).alias("_shift"))
    return ordered.withColumn("_part", part).join(first, "_part").select("value", (F.col("_at") + F.col("_shift")).alias("code"))


class Categories:
    """The codes of one category column over all its loads. Tables only grow; a load adds the values it brings."""

    def __init__(self, log: CommitLog, name: str = "codes"):
        self.log, self.name = log, name

    def codes(self, until: int | None = None) -> DataFrame | None:
        """(value, code) of all loads, or those up to a commit; None before the first."""
        known = self.log.read(self.name, until=until)
        return None if known is None else known.drop(VERSION)

    def learn(self, df: DataFrame, column: str) -> int | None:
        """Give codes to values not met before; the number of the commit, None where there are none.

        Null is no value; the empty text is one. Values are told apart as text, byte by byte.
        """
        values = df.select(F.col(f"`{column}`").cast("string").alias("value")).filter("value is not null").distinct()
        known = self.codes()
        fresh = values if known is None else values.join(known, "value", "left_anti")
        start = 0 if known is None else known.agg(F.max("code")).first()[0] + 1
        fresh = written(fresh, "fresh")
        return None if fresh.isEmpty() else self.log.commit(**{self.name: numbered(fresh, start)})

    def _looked_up(self, df: DataFrame, column: str, key: str, value: str, out: str) -> DataFrame:
        if out in df.columns:
            raise ValueError(f"column {out!r} is there already")
        names = [f"_in{i}" for i in range(len(df.columns))]
        on = names[df.columns.index(column)]
        table = self.codes().select(F.col(key).alias(on), F.col(value).alias("_out"))
        wanted = df.toDF(*names)
        typed = wanted.withColumn("_key", F.col(on).cast(table.schema[on].dataType))
        found = lookup(typed, table.withColumnRenamed(on, "_key"), ["_key"])
        return found.select(*[F.col(n).alias(c) for n, c in zip(names, df.columns)], F.col("_out").alias(out))

    def encode(self, df: DataFrame, column: str, out: str) -> DataFrame:
        """``df`` with the code of ``column`` in ``out``; null where the value is null or was never learnt.

        Values that own very many rows are dealt over several tasks. Call ``learn`` once before.
        """
        return self._looked_up(df, column, "value", "code", out)

    def decode(self, df: DataFrame, column: str, out: str) -> DataFrame:
        """``df`` with the value of the code in ``column`` in ``out``; null for null and unknown codes."""
        return self._looked_up(df, column, "code", "value", out)
