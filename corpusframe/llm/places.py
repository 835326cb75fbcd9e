"""Places of rows within sorted groups, counted without bringing a group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corpusframe.sources.scratch import written


def places(df: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """``df`` with ``_at``, the place of a row in its group from 0, ``_n``, the rows of the group, and ``_group``, a number that grows with the group.

    Groups and rows ascend, nulls first. The table is sorted by ranges and written, so a group may
    span many tasks; a few counts for each task are added up and joined back.
    """
    ordered = written(df.orderBy(*group, *order).withColumn("_place", F.monotonically_increasing_id()), label)
    part = F.shiftright("_place", 33)
    counts = ordered.groupBy(part.alias("_part"), *group).agg(F.min("_place").alias("_low"), F.count(F.lit(1)).alias("_c"))
    own = Window.partitionBy(*group)  # one row for each task that has rows of the group
    earlier = own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("_part").alias("_p"),
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)],
        (F.coalesce(F.sum("_c").over(earlier), F.lit(0)) - F.col("_low")).alias("_shift"),
        F.sum("_c").over(own).alias("_n"),
        F.min("_low").over(own).alias("_group"),
    )
    same = [part == F.col("_p"), *[F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)]]
    return ordered.join(counts, same).select(*df.columns, (F.col("_place") + F.col("_shift")).alias("_at"), "_n", "_group")
