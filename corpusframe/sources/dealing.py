"""Files dealt to tasks by their bytes, so that no task reads much more than another."""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpusframe.sources.scratch import written

OPEN_COST = 16 << 10  # bytes that opening a file counts for, so that many empty files are spread too


def split_bytes(spark: SparkSession) -> int:
    text = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = re.match(r"(\d+)\s*([kmgt]?)", text.lower())
    return int(found.group(1)) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[found.group(2)]


def by_bytes(files: DataFrame, length: str = "length") -> DataFrame:
    """``files`` in as many partitions as there are shuffle partitions, or input splits in their bytes if more.

    The list is written once; running sums of the lengths are cut into equal ranges, one a task. A file
    as long as a range or longer has a task of its own. So a task reads less than twice the mean, or one file.
    Only the number of files and two sums reach the driver. A null length counts as 0; an empty list gives no rows.
    """
    spark = files.sparkSession
    weight = F.coalesce(F.col(f"`{length}`").cast("long"), F.lit(0)) + OPEN_COST
    noted = written(files.withColumn("_weight", weight).withColumn("_nth", F.monotonically_increasing_id()), "dealt")
    total = noted.agg(F.sum("_weight")).first()[0]
    if not total:
        return noted.drop("_weight", "_nth")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / split_bytes(spark)))
    large = F.col("_weight") >= F.lit(math.ceil(total / tasks))
    n_large = noted.filter(large).count()
    noted = noted.withColumn("_part", F.shiftright("_nth", 33))
    small, one = F.when(~large, F.col("_weight")).otherwise(0), F.when(large, 1).otherwise(0)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task that wrote the list
    sums = noted.groupBy("_part").agg(F.sum(small).alias("_s"), F.sum(one).alias("_l"))
    sums = sums.select("_part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("_s", "_l")])
    before = Window.partitionBy("_part").orderBy("_nth").rowsBetween(Window.unboundedPreceding, -1)
    bytes_before = F.col("_s") + F.coalesce(F.sum(small).over(before), F.lit(0))
    large_before = F.col("_l") + F.coalesce(F.sum(one).over(before), F.lit(0))
    task = F.when(large, tasks + large_before).otherwise(F.least(F.floor(bytes_before * tasks / F.lit(total)), F.lit(tasks - 1)))
    numbered = noted.join(sums, "_part").withColumn("_task", task.cast("int"))
    return numbered.repartitionById(tasks + n_large, "_task").select(*files.columns)


def by_count(files: DataFrame, most: int, *order: str, length: str = "length") -> DataFrame | None:
    """``files`` in the order of some columns, ``most`` rows a partition; None where there are none.

    A partition begins with its largest files. The list is written once; only the number of rows of each task that wrote it is summed up.
    """
    noted = written(files.sort(*order).withColumn("_nth", F.monotonically_increasing_id()), "counted")
    noted = noted.withColumn("_part", F.shiftright("_nth", 33))
    sums = noted.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    total = sums.agg(F.sum("_n")).first()[0]
    if not total:
        return None
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_nth").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = noted.join(before, "_part").withColumn("_list", F.floor(place / F.lit(most)).cast("int"))
    dealt = numbered.repartitionById(math.ceil(total / most), "_list")
    return dealt.sortWithinPartitions(F.desc(length), "_nth").select(*files.columns)
