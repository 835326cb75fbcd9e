"""Split views, split output and load profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SPLIT = "split"


def split_counts(df: DataFrame) -> DataFrame:
    """Rows per split; rows without a split are left out."""
    return df.filter(F.col(SPLIT).isNotNull()).groupBy(SPLIT).agg(F.count(F.lit(1)).alias("n_rows"))


def split_views(df: DataFrame, splits: list[str] | None) -> dict[str, DataFrame] | DataFrame:
    """One lazy frame per split present, without the split column; else the frame itself."""
    if not splits or SPLIT not in df.columns:
        return df
    present = [r[SPLIT] for r in split_counts(df).select(SPLIT).orderBy(SPLIT).collect()]
    return {name: df.filter(F.col(SPLIT) == name).drop(SPLIT) for name in present}


def write_splits(df: DataFrame, target: str, splits: list[str] | None) -> None:
    """One parquet folder per split, or a single dataset when the spec names no splits."""
    if not splits or SPLIT not in df.columns:
        df.write.parquet(target)
        return
    df.filter(F.col(SPLIT).isNotNull()).write.partitionBy(SPLIT).parquet(target)


def write_sized_splits(df: DataFrame, target: str, target_bytes: int, order: list[str] = ()) -> None:
    """One parquet folder per split, in files of about ``target_bytes`` of shuffled rows, ordered by ``order`` inside.

    Rows are rebalanced by split: adaptive execution cuts a large split into several tasks and puts
    small ones together, so a split with nearly all rows gives many files and a tiny one gives one.
    What one task before the shuffle wrote for a split is not cut further, so a file may exceed the target by that much.
    Rows without a split are left out. The size is a session setting, put back after the write.
    """
    conf = df.sparkSession.conf
    sizes = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes)}
    before = {k: conf.get(k, None) for k in sizes}
    dealt = df.filter(F.col(SPLIT).isNotNull()).hint("rebalance", F.col(SPLIT)).sortWithinPartitions(SPLIT, *order)
    try:
        for k, v in sizes.items():
            conf.set(k, v)
        dealt.write.partitionBy(SPLIT).parquet(target)
    finally:
        for k, v in before.items():
            conf.set(k, v) if v is not None else conf.unset(k)


def category_domain(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a category column."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


# how a lookup can end, see operators.resolve
STATUSES = ("ok", "unverified", "missing", "ambiguous", "null")


def load_profile(df: DataFrame, columns: list[str], by: str = SPLIT, status: str | None = None) -> DataFrame:
    """Per split: rows, for each column its nulls and approximate distinct count, and the rows of
    each lookup status if ``status`` names its column."""
    measures = [F.count(F.lit(1)).alias("n_rows")]
    for name in columns:
        measures.append(F.count_if(F.col(name).isNull()).alias(f"{name}_nulls"))
        measures.append(F.approx_count_distinct(name).alias(f"{name}_distinct"))
    if status is not None:
        measures += [F.count_if(F.col(status) == s).alias(f"n_{s}") for s in STATUSES]
    return df.groupBy(by).agg(*measures)
