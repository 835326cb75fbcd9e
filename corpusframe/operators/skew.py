"""Joins to a one-row-per-key side that hold when a few keys own most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

HOT_ROWS = 1_000_000  # a key with more rows than this is spread over several tasks
# The list of such keys is broadcast, so it has a bound. The largest keys are listed: one that is not
# has less than one in MAX_HOT_KEYS of all rows, which is no more than an even share of a large job.
MAX_HOT_KEYS = 1_000
_SALT, _COPIES = "_salt", "_copies"


def key_counts(df: DataFrame, on: list[str]) -> DataFrame:
    """Distinct keys with their row count, combined before the shuffle; null keys left out."""
    present = df.filter(F.col(on[0]).isNotNull()) if on else df
    return present.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))


def lookup(
    df: DataFrame,
    table: DataFrame,
    on: list[str],
    counts: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    wide: bool = False,
) -> DataFrame:
    """Left join ``df`` to ``table``, which has at most one row per key ``on``.

    Keys with many rows get a salt, and their single table row is repeated once per salt
    value, so no task receives all rows of a hot key: copies follow from the count, one for
    each ``hot_rows`` rows, without a limit.
    A table that carries the row count of its keys as ``_n`` needs no join to the list.
    Rows with a null key match nothing and are spread too.
    A ``wide`` table holds file contents, whose size Spark guesses far too low: it is never broadcast.
    """
    counts = key_counts(df, on) if counts is None else counts
    copies = F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias(_COPIES)
    hot = counts.filter(F.col("_n") > hot_rows).orderBy(F.desc("_n"), *on).limit(MAX_HOT_KEYS)
    listed = hot.select(*on, copies)
    if "_n" in table.columns:
        repeated = table.select(*[c for c in table.columns if c != "_n"], copies)
    else:
        repeated = table.join(F.broadcast(listed), on, "left")
    each = F.when(F.col(_COPIES) > 1, F.sequence(F.lit(0), F.col(_COPIES) - 1)).otherwise(F.array(F.lit(0)))
    repeated = repeated.withColumn(_SALT, F.explode_outer(each)).drop(_COPIES)
    # row content and partition number: the same on a retried task, and different for the
    # identical rows of a hot key that sit in different partitions
    spread = F.xxhash64(*df.columns) + F.spark_partition_id()
    salted = df.join(F.broadcast(listed), on, "left").withColumn(
        _SALT,
        F.when(F.col(on[0]).isNull(), F.pmod(spread, F.lit(1 << 30)))
        .otherwise(F.coalesce(F.pmod(spread, F.col(_COPIES)), F.lit(0)))
        .cast("int"),
    ).drop(_COPIES)
    repeated = repeated.hint("merge") if wide else repeated
    return salted.join(repeated, [*on, _SALT], "left").drop(_SALT)
