"""Profiles of loads that merge: counts, bounds and sketches are stored for each load and united without rereading it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusframe.operators.splits import SPLIT
from corpusframe.sources.commits import VERSION, CommitLog

HLL_BITS, KLL_SIZE = 12, 800
# stated errors: three standard errors of the distinct count (1.04 / sqrt(2^bits)), and of a rank (2.296 / k^0.9021)
DISTINCT_ERROR = 3 * 1.04 / 2 ** (HLL_BITS / 2)
RANK_ERROR = 2.296 / KLL_SIZE**0.9021


def sketched(df: DataFrame, columns: list[str], numbers: list[str], by: str = SPLIT) -> DataFrame:
    """One row per split and column: n_rows, n_nulls, sketch of distinct values, and low, high and sketch of ``numbers``.

    One pass, combined before the shuffle; a row of the result has a few kilobytes however many rows it stands for.
    Values are compared as text. Null and NaN are no values of ``numbers``. A null split is a split of its own, an empty frame has no rows.
    """
    names = list(dict.fromkeys([*columns, *numbers]))
    measures = [F.count(F.lit(1)).alias("_rows")]
    for i, name in enumerate(names):
        value = F.col(f"`{name}`")
        measures += [F.count_if(value.isNull()).alias(f"_nulls{i}"), F.hll_sketch_agg(value.cast("string"), HLL_BITS).alias(f"_hll{i}")]
        if name in numbers:
            number = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
            measures += [F.min(number).alias(f"_low{i}"), F.max(number).alias(f"_high{i}"), F.kll_sketch_agg_double(number, KLL_SIZE).alias(f"_kll{i}")]

    def row(i, name):
        typed = {"low": "double", "high": "double", "kll": "binary"}
        extra = [(F.col(f"_{c}{i}") if name in numbers else F.lit(None)).cast(t).alias(c) for c, t in typed.items()]
        return F.struct(F.lit(name).alias("column"), F.col(f"_nulls{i}").alias("n_nulls"), F.col(f"_hll{i}").alias("hll"), *extra)

    wide = df.groupBy(F.col(f"`{by}`").alias(SPLIT)).agg(*measures)
    rows = F.explode(F.array(*[row(i, n) for i, n in enumerate(names)])).alias("c")
    return wide.select(SPLIT, F.col("_rows").alias("n_rows"), rows).select(SPLIT, "n_rows", "c.*")


def united(rows: DataFrame) -> DataFrame:
    """Rows of many loads as one row per split and column, of the same form."""
    return rows.groupBy(SPLIT, "column").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_nulls").alias("n_nulls"),
        F.hll_union_agg("hll").alias("hll"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("kll").alias("kll"),
    )


class Profiles:
    """Profiles of the loads of one corpus, a commit each."""

    def __init__(self, log: CommitLog):
        self.log = log

    def take(self, df: DataFrame, columns: list[str], numbers: list[str] = (), by: str = SPLIT) -> int:
        """Profile one load; the number of its commit."""
        return self.log.commit(profile=sketched(df, columns, list(numbers), by))

    def sketches(self, since: int = 0, until: int | None = None) -> DataFrame | None:
        """United sketches of the loads after ``since`` up to ``until``; None before the first."""
        rows = self.log.read("profile", since, until)
        return None if rows is None else united(rows)

    def merged(self, points: list[float] = (0.5,), since: int = 0, until: int | None = None) -> DataFrame | None:
        """Per split and column: n_rows, n_nulls, n_distinct (estimate), low, high, and the values at the ranks ``points``.

        Columns without numbers, and those whose numbers are all null, have null values there.
        """
        rows = self.sketches(since, until)
        if rows is None:
            return None
        some = F.coalesce(F.kll_sketch_get_n_double("kll"), F.lit(0)) > 0
        values = F.array(*[F.kll_sketch_get_quantile_double("kll", F.lit(float(p))) for p in points])
        return rows.select(
            SPLIT, "column", "n_rows", "n_nulls", F.hll_sketch_estimate("hll").alias("n_distinct"), "low", "high", F.when(some, values).alias("quantiles")
        )

    def compact(self) -> None:
        """Fold all loads so far into one row per split and column; single loads stay readable with ``since``."""
        self.log.compact("profile", lambda rows: united(rows.drop(VERSION)))
