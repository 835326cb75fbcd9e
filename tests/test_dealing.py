import os

import pytest
from pyspark.sql import functions as F

from corpusframe import list_files
from corpusframe.sources.dealing import OPEN_COST, by_bytes
from corpusframe.sources.files import file_digests, read_contents


def loads(df):
    """Bytes, weights and files of each task that has any."""
    per = df.groupBy(F.spark_partition_id().alias("task")).agg(F.sum(F.coalesce("length", F.lit(0))).alias("bytes"), F.count(F.lit(1)).alias("n"), F.max("length").alias("most"))
    return per.collect()


@pytest.mark.parametrize("large", [[], [1 << 30], [1 << 30] * 3 + [300 << 20]])
def test_no_task_reads_over_twice_the_mean_or_one_file(spark, large):
    small = spark.range(10_000).select(F.concat(F.lit("s"), "id").alias("path"), (F.xxhash64("id") % 50_000 + 50_000).alias("length"))
    files = small.union(spark.createDataFrame([(f"l{k}", n) for k, n in enumerate(large)], "path string, length long"))
    dealt = by_bytes(files.repartition(5))
    tasks = loads(dealt)
    total = sum(t.bytes for t in tasks) + OPEN_COST * sum(t.n for t in tasks)
    mean = total / max(8, -(-total // (128 << 20)))
    for t in tasks:
        assert t.n == 1 or t.bytes + OPEN_COST * t.n <= 2 * mean
    assert sum(t.n for t in tasks) == 10_000 + len(large)
    assert sorted(r.path for r in dealt.select("path").collect()) == sorted(r.path for r in files.select("path").collect())


def test_empty_files_are_spread_and_empty_lists_and_nulls_are_fine(spark):
    files = spark.range(800).select(F.col("id").cast("string").alias("path"), F.lit(0).cast("long").alias("length"))
    tasks = loads(by_bytes(files))
    assert len(tasks) == 8 and max(t.n for t in tasks) <= 101
    assert by_bytes(files.limit(0)).count() == 0
    assert by_bytes(files.withColumn("length", F.lit(None).cast("long"))).count() == 800


def test_reads_and_digests_go_by_bytes(spark, tmp_path):
    for k in range(60):
        (tmp_path / f"f{k:02d}").write_bytes(b"x" * (1000 if k % 20 else 400_000))
    files = list_files(spark, str(tmp_path))
    for df in (read_contents(files, "length"), file_digests(files).withColumnRenamed("bytes_read", "length")):
        tasks = loads(df)
        assert sum(t.n for t in tasks) == 60 and max(t.bytes for t in tasks) <= 400_000
        assert sum(t.most == 400_000 for t in tasks) == 3
    assert {r.path: len(r.content) for r in read_contents(files.select("path")).collect()} == {r.path: r.length for r in files.collect()}


def test_one_huge_folder_is_looked_up_by_many_tasks(spark, tmp_path, monkeypatch):
    for k in range(30_000):
        (tmp_path / f"f{k}").touch()
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a").write_text("abc")
    os.symlink("nowhere", tmp_path / "dangling")
    found = list_files(spark, str(tmp_path))
    assert found.count() == 30_001 and found.filter("length = 3").count() == 1
    shares = found.groupBy(F.col("_metadata.file_path")).count().collect() if "_metadata" in found.columns else found.groupBy(F.input_file_name().alias("f")).count().collect()
    assert len(shares) >= 8 and max(s["count"] for s in shares) < 8_000
