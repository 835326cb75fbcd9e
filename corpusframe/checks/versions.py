"""Queries over versioned manifests, loads that commit once, profiles that merge, category codes, sized output and media that land late."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusframe.checks import derived as D
from corpusframe.checks.registry import check
from corpusframe.operators.categories import Categories
from corpusframe.operators.ledger import compact_ledger, load_changed, loaded_output
from corpusframe.operators.profiles import DISTINCT_ERROR, RANK_ERROR, Profiles
from corpusframe.operators.snapshots import Snapshots
from corpusframe.operators.splits import write_sized_splits
from corpusframe.sources.commits import CommitLog
from corpusframe.streaming.late import FOUND, await_media, write_told


def three_snapshots(spark: SparkSession, sf: str) -> Snapshots:
    """All languages but one; then every document, some of them longer; then without the short ones."""
    docs = D.table(spark, sf, "documents")
    first = docs.select(D.placed(F.col("lang"), "/", D.text_of("doc_id")).alias("path"), F.octet_length("text").cast("long").alias("length"), "lang", "source", "n_chars")
    grown = first.withColumn("length", F.when(F.col("source").startswith("src1"), F.col("length") + 1).otherwise(F.col("length")))
    store = Snapshots(CommitLog(spark, D.fresh(spark, "snapshots")), values=("length",))
    for manifest in (first.filter("lang <> 'fr'"), grown, grown.filter("n_chars >= 1000")):
        store.take(manifest)
    return store


SNAPSHOTS_SQL = """d AS (SELECT '/corpus/' || lang || '/' || doc_id AS path, strlen(text) AS n, lang = 'fr' AS late, starts_with(source, 'src1') AS grows,
    n_chars < 1000 AS short FROM documents),
  deltas AS (SELECT 1 AS version, path, 'added' AS change, n AS length FROM d WHERE NOT late
    UNION ALL SELECT 2, path, CASE WHEN late THEN 'added' ELSE 'changed' END, n + CASE WHEN grows THEN 1 ELSE 0 END FROM d WHERE late OR grows
    UNION ALL SELECT 3, path, 'gone', n + CASE WHEN grows THEN 1 ELSE 0 END FROM d WHERE short)"""


@check("manifest_deltas", f"WITH {SNAPSHOTS_SQL} SELECT version, path, change, CAST(length AS BIGINT) AS length FROM deltas")
def manifest_deltas(spark: SparkSession, sf: str) -> DataFrame:
    return three_snapshots(spark, sf).deltas()


@check(
    "manifest_changes",
    f"WITH {SNAPSHOTS_SQL} SELECT path, CASE WHEN late THEN 'added' WHEN short THEN 'gone' ELSE 'changed' END AS change, "
    "CAST(n + CASE WHEN NOT short AND grows THEN 1 ELSE 0 END AS BIGINT) AS length FROM d WHERE (late AND NOT short) OR (short AND NOT late) OR (NOT late AND grows)",
)
def manifest_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Net changes of the second and third snapshot."""
    return three_snapshots(spark, sf).changes(since=1)


@check(
    "manifest_at_version",
    f"WITH {SNAPSHOTS_SQL} SELECT 2 AS version, path, CAST(n + CASE WHEN grows THEN 1 ELSE 0 END AS BIGINT) AS length FROM d "
    "UNION ALL SELECT 3, path, CAST(n + CASE WHEN grows THEN 1 ELSE 0 END AS BIGINT) FROM d WHERE NOT short",
)
def manifest_at_version(spark: SparkSession, sf: str) -> DataFrame:
    """The second snapshot, and the last one after compaction."""
    store = three_snapshots(spark, sf)
    second = store.state(2).select(F.lit(2).alias("version"), "path", "length")
    store.compact()
    return second.union(store.state().select(F.lit(3).alias("version"), "path", "length"))


@check(
    "committed_loads",
    "SELECT o_orderkey AS key, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 3 WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS load, count(l_orderkey) AS n_lines "
    "FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL",
)
def committed_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Finished orders are loaded first, then all; then those whose checksum changed, after the ledger was compacted."""
    orders, lines = D.table(spark, sf, "orders"), D.table(spark, sf, "lineitem")
    log = CommitLog(spark, D.fresh(spark, "loads"))

    def load(number):
        def run(wanted):
            counted = lines.groupBy(D.text_of("l_orderkey").alias("path")).agg(F.count(F.lit(1)).alias("n_lines"))
            return wanted.join(counted, "path", "left").select("path", F.lit(number).alias("load"), F.coalesce("n_lines", F.lit(0)).alias("n_lines"))

        return run

    current = orders.select(D.text_of("o_orderkey").alias("path"), F.lit("a").alias("checksum"), "o_orderstatus", "o_orderpriority")
    load_changed(log, current.filter("o_orderstatus = 'F'"), load(1))
    load_changed(log, current, load(2))
    compact_ledger(log)
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    load_changed(log, current.withColumn("checksum", F.when(urgent, "b").otherwise("a")), load(3))
    return loaded_output(log).select(F.col("path").cast("long").alias("key"), "load", "n_lines")


@check(
    "merged_profiles",
    """WITH l AS (SELECT l_returnflag AS split, 'part' AS "column", CAST(l_partkey AS DOUBLE) AS v, FALSE AS number FROM lineitem
      UNION ALL SELECT l_returnflag, 'price', CASE WHEN l_linenumber <> 7 THEN CAST(l_extendedprice AS DOUBLE) END, TRUE FROM lineitem)
    SELECT split, "column", count(*) AS n_rows, count(*) FILTER (v IS NULL) AS n_nulls, min(v) FILTER (number) AS low, max(v) FILTER (number) AS high,
      TRUE AS distinct_within, TRUE AS median_within FROM l GROUP BY ALL""",
)
def merged_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads of ``lineitem`` profiled one by one and united after compaction; the estimates are held against exact counts."""
    price = F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice").cast("double"))
    lines = D.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("split"), F.col("l_partkey").alias("part"), price.alias("price"), "l_linenumber")
    store = Profiles(CommitLog(spark, D.fresh(spark, "profiles")))
    for load in ("l_linenumber = 1", "l_linenumber between 2 and 3", "l_linenumber > 3"):
        store.take(lines.filter(load), ["part"], ["price"])
        store.compact()
    found = store.merged()
    medians = found.filter(F.col("column") == "price").select("split", F.col("quantiles")[0].alias("median"))
    exact = lines.join(F.broadcast(medians), "split").groupBy("split").agg(  # one row for each split
        F.count_distinct("part").alias("part"), F.count_distinct("price").alias("price"), (F.count_if(F.col("price") <= F.col("median")) / F.count("price")).alias("rank")
    )
    both = found.join(exact, "split")
    distinct = F.when(F.col("column") == "part", F.col("part")).otherwise(F.col("price"))
    near = F.abs(F.col("n_distinct") - distinct) <= DISTINCT_ERROR * distinct
    rank = F.col("quantiles").isNull() | (F.abs(F.col("rank") - 0.5) <= 3 * RANK_ERROR)
    return both.select("split", "column", "n_rows", "n_nulls", "low", "high", near.alias("distinct_within"), rank.alias("median_within"))


@check(
    "category_codes",
    """WITH v AS (SELECT CAST(o_custkey AS VARCHAR) AS value, min(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END) AS load FROM orders GROUP BY o_custkey),
      c AS (SELECT value, row_number() OVER (ORDER BY load, value) - 1 AS code, load FROM v)
    SELECT o_orderkey AS key, code, value AS again, load = 1 AS first_load FROM orders JOIN c ON CAST(o_custkey AS VARCHAR) = value""",
)
def category_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of finished orders get codes first, then all; every order is coded and read back."""
    orders = D.table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), D.text_of("o_custkey").alias("customer"), "o_orderstatus")
    store = Categories(CommitLog(spark, D.fresh(spark, "categories")))
    store.learn(orders.filter("o_orderstatus = 'F'"), "customer")
    known = store.codes(until=1).agg(F.max("code")).first()[0]
    store.learn(orders, "customer")
    back = store.decode(store.encode(orders, "customer", "code"), "code", "again")
    return back.select("key", "code", "again", (F.col("code") <= known).alias("first_load"))


@check(
    "split_write_sized",
    "SELECT doc_id, text, CASE WHEN doc_id % 50 = 0 THEN 'test' ELSE 'train' END AS split FROM documents",
)
def split_write_sized(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as a large and a small split, in files of about 64 MB."""
    split = F.when(F.col("doc_id") % 50 == 0, "test").otherwise("train").alias("split")
    target = D.fresh(spark, "sized")
    write_sized_splits(D.table(spark, sf, "documents").select("doc_id", "text", split), target, 64 << 20, ["doc_id"])
    return spark.read.parquet(target)


@check(
    "stream_late_media",
    "SELECT l_orderkey AS key, l_linenumber AS line, o_orderstatus <> 'P' AS found FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def stream_late_media(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of all orders land first, with the files of finished orders; open ones land in a second run; others never."""
    orders, lines = D.table(spark, sf, "orders"), D.table(spark, sf, "lineitem")
    folder, start = D.fresh(spark, "late"), datetime(2024, 1, 1)
    media = orders.select(F.concat(D.text_of("o_orderkey"), F.lit(".wav")).alias("path"), "o_orderstatus")
    index = lines.select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("line"), F.concat(D.text_of("l_orderkey"), F.lit(".wav")).alias("path"), F.lit(start).alias("at"))
    later = spark.createDataFrame([("later.wav", start + timedelta(days=1))], "path string, at timestamp")
    runs = [
        media.filter("o_orderstatus = 'F'").select("path", F.lit(start).alias("at")),
        media.filter("o_orderstatus = 'O'").select("path", F.lit(start + timedelta(minutes=30)).alias("at")),
        later,
    ]
    for number, files in enumerate(runs):
        if not number:
            index.write.parquet(f"{folder}/rows")
        files.write.mode("append").parquet(f"{folder}/files")
        rows = spark.readStream.schema(index.schema).parquet(f"{folder}/rows")
        landed = spark.readStream.schema(later.schema).parquet(f"{folder}/files")
        write_told(await_media(rows, landed, "path", "at", timedelta(hours=1)), f"{folder}/out", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("key", "line", F.col(FOUND).alias("found"))
