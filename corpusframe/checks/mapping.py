"""Queries over column mapping, expressions, paths and file resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusframe.checks import derived as D
from corpusframe.checks.registry import check
from corpusframe.functions import casts as C, paths as P, sizes as S, text as X
from corpusframe.operators.mapping import map_columns
from corpusframe.operators.quality import predefined_license, validate_submissions
from corpusframe.operators.resolve import PathRule, direct_candidates, resolve_values
from corpusframe.operators.splits import category_domain, load_profile, split_counts, write_splits
from corpusframe.plans.layouts import tagged
from corpusframe.sources.delimited import IndexFrame, tidy
from corpusframe.sources.files import file_digests, has_extension, visible


@check(
    "column_mapping",
    "SELECT l_orderkey AS \"order\", l_linenumber AS line, l_extendedprice AS price, l_discount AS discount, "
    "l_returnflag AS flag, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM lineitem",
)
def column_mapping(spark: SparkSession, sf: str) -> DataFrame:
    items = D.table(spark, sf, "lineitem").withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))
    columns = {
        "order": D.column("l_orderkey", "int"),
        "line": D.column("l_linenumber", "int"),
        "price": D.column("l_extendedprice", "float"),
        "discount": D.column("l_discount", "float"),
        "flag": D.column("l_returnflag", "category"),
        "shipped": D.column("l_shipdate"),
    }
    return map_columns(D.frame(items), D.spec(columns=columns), D.corpus(None))


@check(
    "source_column_resolution",
    "SELECT c_custkey AS exact, c_name AS trimmed, c_mktsegment AS normalised FROM customer",
)
def source_column_resolution(spark: SparkSession, sf: str) -> DataFrame:
    customer = D.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    frame = D.frame(customer, ["Key", "Name", "Market   Segment"])
    columns = {
        "exact": D.column("Key", "int"),
        "trimmed": D.column(" Name "),
        "normalised": D.column("market segment"),
    }
    return map_columns(frame, D.spec(columns=columns), D.corpus(None))


@check("optional_column", "SELECT o_orderkey AS key, o_orderstatus AS status FROM orders")
def optional_column(spark: SparkSession, sf: str) -> DataFrame:
    columns = {
        "key": D.column("o_orderkey", "int"),
        "note": D.column("o_note", optional=True),
        "status": D.column("o_orderstatus", optional=True),
    }
    return map_columns(D.frame(D.table(spark, sf, "orders")), D.spec(columns=columns), D.corpus(None))


@check(
    "cast_string",
    "SELECT o_orderkey AS key, CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN NULL "
    "WHEN '3-MEDIUM' THEN '007' ELSE ' ' || o_orderpriority END AS cell FROM orders",
)
def cast_string(spark: SparkSession, sf: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    raw = F.when(priority == "1-URGENT", "NA").when(priority == "2-HIGH", "<NA>").when(
        priority == "3-MEDIUM", "007").otherwise(F.concat(F.lit(" "), priority))
    orders = D.table(spark, sf, "orders")
    return orders.select(F.col("o_orderkey").alias("key"), C.cast(X.missing_to_null(raw), "string").alias("cell"))


@check(
    "cast_int",
    "SELECT o_orderkey AS key, CAST(CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN 1000 "
    "ELSE o_orderkey END AS VARCHAR) AS number FROM orders",
)
def cast_int(spark: SparkSession, sf: str) -> DataFrame:
    key, priority = D.text_of("o_orderkey"), F.col("o_orderpriority")
    raw = (
        F.when(priority == "1-URGENT", "bad")
        .when(priority == "2-HIGH", "1e3")
        .when(priority == "3-MEDIUM", F.concat(key, F.lit(".0")))
        .when(priority == "5-LOW", F.concat(F.lit(" "), key, F.lit(" ")))
        .otherwise(key)
    )
    orders = D.table(spark, sf, "orders")
    return orders.select(F.col("o_orderkey").alias("key"), C.to_int(raw).cast("string").alias("number"))


@check(
    "cast_exact",
    """SELECT o_orderkey AS key, CAST(CASE o_orderkey % 8 WHEN 2 THEN o_orderkey * 1000 WHEN 4 THEN 9223372036854775807 WHEN 7 THEN o_orderkey END AS VARCHAR) AS number,
      CASE WHEN o_orderkey % 8 IN (0, 1, 3, 5) THEN 'key:not_whole' ELSE '' END AS problems FROM orders""",
)
def cast_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Whole numbers keep every digit; what an int can't hold is a problem, text is null."""
    key, rest = D.text_of("o_orderkey"), F.pmod("o_orderkey", F.lit(8))
    tails = {0: ".00000000001", 1: "e30", 2: "e3", 3: "e-11", 7: ".000"}
    raw = F.coalesce(*[F.when(rest == k, F.concat(key, F.lit(t))) for k, t in tails.items()], F.when(rest == 4, "9223372036854775807.0").when(rest == 5, "99999999999999999999").when(rest == 6, "0x1p3"))
    orders = D.table(spark, sf, "orders").select(key.alias("o_orderkey"), raw.alias("raw"))
    columns = {"key": D.column("o_orderkey", "int"), "number": D.column("raw", "int")}
    mapped = map_columns(D.frame(orders), D.spec(columns=columns), D.corpus(None, "quarantine"))
    return mapped.select("key", F.col("number").cast("string").alias("number"), F.replace(F.array_join("_problems", ","), F.lit("number"), F.lit("key")).alias("problems"))


@check(
    "cast_float",
    "SELECT o_orderkey AS key, o_totalprice AS price, CASE o_orderpriority WHEN '1-URGENT' THEN 'none' "
    "WHEN '2-HIGH' THEN 'inf' WHEN '3-MEDIUM' THEN 'none' ELSE 'number' END AS kind FROM orders",
)
def cast_float(spark: SparkSession, sf: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    odd = F.when(priority == "1-URGENT", "1,000").when(priority == "2-HIGH", "-inf").when(
        priority == "3-MEDIUM", "0x10").otherwise(D.text_of("o_totalprice"))
    number = C.to_float(odd)
    kind = F.when(number.isNull(), "none").when(F.abs(number) == float("inf"), "inf").otherwise("number")
    orders = D.table(spark, sf, "orders")
    price = C.to_float(D.text_of("o_totalprice"))
    return orders.select(F.col("o_orderkey").alias("key"), price.alias("price"), kind.alias("kind"))


@check("cast_category", "SELECT DISTINCT o_orderpriority AS priority FROM orders")
def cast_category(spark: SparkSession, sf: str) -> DataFrame:
    columns = {"priority": D.column("o_orderpriority", "category")}
    mapped = map_columns(D.frame(D.table(spark, sf, "orders")), D.spec(columns=columns), D.corpus(None))
    return category_domain(mapped, "priority")


@check(
    "literal_columns",
    "SELECT r_name AS name, 'train' AS split, 'all' AS section, c_custkey AS key FROM customer "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
def literal_columns(spark: SparkSession, sf: str) -> DataFrame:
    regions = (
        D.table(spark, sf, "customer")
        .join(D.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(D.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    # a column of the same name gives way to the constant
    rows = regions.select(F.col("r_name").alias("name"), F.lit("source").alias("split"), F.col("c_custkey").alias("key"))
    split = tagged(D.frame(rows), "split", "train", as_cell=True)
    both = tagged(IndexFrame(split.rows.drop("_tag"), split.names), "section", "all", as_cell=True)
    return both.named().withColumn("key", F.col("key").cast("long"))


@check(
    "hidden_file_filter",
    "SELECT '/corpus/' || lang || '/' || doc_id || '.wav' AS path FROM documents WHERE source <> 'src1'",
)
def hidden_file_filter(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.table(spark, sf, "documents")
    mark = F.when(F.col("source") == "src1", "._").otherwise("")
    files = D.manifest(docs, D.placed(F.col("lang"), "/", mark, D.text_of("doc_id"), ".wav"))
    return files.filter(visible()).select("path")


@check(
    "extension_filter",
    "SELECT '/corpus/' || doc_id || CASE lang WHEN 'en' THEN '.WAV' ELSE '.wav' END AS path FROM documents "
    "WHERE lang IN ('en', 'de')",
)
def extension_filter(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.table(spark, sf, "documents")
    ext = F.when(F.col("lang") == "en", ".WAV").when(F.col("lang") == "de", ".wav").otherwise(".txt")
    files = D.manifest(docs, D.placed(D.text_of("doc_id"), ext))
    return files.filter(has_extension("Wav")).select("path")


@check(
    "path_template",
    "SELECT c_custkey AS key, '/corpus/' || c_mktsegment || '/' || c_name || '_' || "
    "CASE WHEN c_nationkey = 3 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END || '.wav' AS path FROM customer",
)
def path_template(spark: SparkSession, sf: str) -> DataFrame:
    customer = D.table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.lit(" "), "c_name").alias("Full Name"),
        "c_mktsegment",
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey")).alias("nation"),
    )
    template = "${c_mktsegment}/${value}_${ Nation }.wav"
    columns = {
        "key": D.column("c_custkey", "int"),
        "path": D.column("full name", "file_path", path_template=template),
    }
    media = D.manifest(
        D.table(spark, sf, "customer"),
        D.placed(F.col("c_mktsegment"), "/", F.col("c_name"), "_", D.text_of("c_nationkey"), ".wav"),
    )
    return map_columns(D.frame(customer), D.spec(columns=columns), D.corpus(media))


@check(
    "dynamic_roots",
    "SELECT l_orderkey AS key, l_linenumber AS line, CASE WHEN o_orderstatus = 'F' "
    "THEN '/corpus/' || l_returnflag || '/deep/' || l_orderkey || '.wav' "
    "ELSE '/corpus/' || l_returnflag || '/' || l_orderkey END AS path "
    "FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey",
)
def dynamic_roots(spark: SparkSession, sf: str) -> DataFrame:
    items = D.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    flags = F.explode(F.array(*[F.lit(f) for f in ("A", "N", "R")])).alias("flag")
    media = D.table(spark, sf, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", flags)
    media = D.manifest(media, D.placed(F.col("flag"), "/deep/", D.text_of("o_orderkey"), ".wav"))
    columns = {
        "key": D.column("l_orderkey", "int"),
        "line": D.column("l_linenumber", "int"),
        "path": D.column("l_orderkey", "file_path", file_extension="wav"),
    }
    spec = D.spec(columns=columns, base_audio_path=["${l_returnflag}", "${l_returnflag}/deep/"])
    return map_columns(D.frame(items), spec, D.corpus(media))


RULE = PathRule(dataset_root="/corpus/data", extract_root="/corpus", roots=("/corpus/clips",), extension=".wav")


@check(
    "direct_candidates",
    """WITH v AS (SELECT c_custkey AS key, c_name AS n, c_nationkey AS k FROM customer),
    b AS (SELECT unnest([0, 1, 2]) AS pos, unnest(['/corpus/clips/', '/corpus/data/', '/corpus/']) AS base)
    SELECT key, pos AS ord, base || n AS path FROM v, b WHERE k > 5
    UNION ALL SELECT key, pos + 3, base || n || '.wav' FROM v, b WHERE k > 5
    UNION ALL SELECT key, pos, base || 'a/' || n || '.ogg' FROM v, b WHERE k <= 5 AND k <> 3
    UNION ALL SELECT key, 0, '/abs/' || n FROM v WHERE k = 3
    UNION ALL SELECT key, 3, '/abs/' || n || '.wav' FROM v WHERE k = 3""",
)
def direct_candidates_query(spark: SparkSession, sf: str) -> DataFrame:
    nation = F.col("c_nationkey")
    value = F.when(nation == 3, F.concat(F.lit("/abs//"), "c_name")).when(
        nation <= 5, F.concat(F.lit("./a//"), "c_name", F.lit(".ogg"))).otherwise(F.col("c_name"))
    customer = D.table(spark, sf, "customer").select(value.alias("_value"), F.col("c_custkey").alias("key"))
    listed = direct_candidates(RULE.with_roots(customer), RULE)
    return listed.select("key", F.col("_ord").cast("int").alias("ord"), "path")


@check(
    "extension_normalise",
    "SELECT p_partkey AS key, p_name || '.wav' AS dotted, p_name || '.wav' AS bare, p_name AS none FROM part",
)
def extension_normalise(spark: SparkSession, sf: str) -> DataFrame:
    name = F.col("p_name")

    def added(extension: str | None):
        return F.concat(name, F.lit(P.clean_extension(extension) or ""))

    part = D.table(spark, sf, "part")
    return part.select(
        F.col("p_partkey").alias("key"), added(".wav").alias("dotted"), added("wav").alias("bare"),
        added("").alias("none"),
    )


@check(
    "resolve_direct",
    """WITH o AS (SELECT o_orderkey, o_orderstatus = 'F' AS clip,
        o_orderpriority IN ('1-URGENT', '2-HIGH') AS wav FROM orders)
    SELECT l_orderkey AS key, l_linenumber AS line,
      CASE WHEN clip THEN '/corpus/clips/' || l_orderkey || '.wav'
           WHEN wav THEN '/corpus/wavs/' || l_orderkey || '.wav'
           ELSE '/corpus/clips/' || l_orderkey END AS path
    FROM lineitem LEFT JOIN o ON l_orderkey = o_orderkey""",
)
def resolve_direct_query(spark: SparkSession, sf: str) -> DataFrame:
    items = D.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    columns = {
        "key": D.column("l_orderkey", "int"),
        "line": D.column("l_linenumber", "int"),
        "path": D.column("l_orderkey", "file_path", file_extension=".wav"),
    }
    spec = D.spec(columns=columns, base_audio_path=["clips/", "wavs/"])
    return map_columns(D.frame(items), spec, D.corpus(D.media_manifest(spark, sf)))


@check(
    "resolve_exact",
    f"""WITH {D.PAGES_SQL},
    v AS (SELECT page_id, regexp_extract(name, '^[0-9]+') AS value FROM (
      SELECT page_id, string_split(rel, '/')[-1] AS name FROM pg)),
    h AS (SELECT DISTINCT value, path FROM v JOIN mf ON name = value OR stem = value OR lower(rel) = value),
    r AS (SELECT value, min(path) AS path, count(*) AS n FROM h GROUP BY value)
    SELECT page_id, value, CASE WHEN n = 1 THEN path END AS path,
      CASE WHEN n IS NULL THEN 'missing' WHEN n = 1 THEN 'ok' ELSE 'ambiguous' END AS status
    FROM v LEFT JOIN r USING (value)""",
)
def resolve_exact_query(spark: SparkSession, sf: str) -> DataFrame:
    return _searched_pages(spark, sf, "exact").select("page_id", F.col("_value").alias("value"), "path", "status")


def _searched_pages(spark: SparkSession, sf: str, strategy: str) -> DataFrame:
    pages = D.table(spark, sf, "pages")
    if strategy == "exact":
        value = F.regexp_extract(P.basename(D.page_rel()), "^[0-9]+", 0)
    else:
        value = F.upper(F.regexp_extract(D.page_rel(), "([^./]+[.][a-z]+/[a-z]+/[0-9])[^/]*$", 1))
    rule = PathRule(D.ROOT, D.ROOT, (D.ROOT,), strategy)
    rows = pages.select("page_id", value.alias("_value"))
    return resolve_values(rows, D.page_manifest(spark, sf), rule)


CONTAINS_SQL = f"""{D.PAGES_SQL},
    v AS (SELECT page_id, upper(regexp_extract(rel, '([^./]+[.][a-z]+/[a-z]+/[0-9])[^/]*$', 1)) AS value FROM pg),
    h AS (SELECT DISTINCT value, path, depth FROM (SELECT DISTINCT value FROM v WHERE value <> '') d
          JOIN mf ON contains(lower(rel), lower(value))),
    r AS (SELECT value, min(path) AS path, count(*) AS n,
          list(path ORDER BY depth, path)[1:5] AS found FROM h GROUP BY value)"""


@check(
    "resolve_contains",
    f"""WITH {CONTAINS_SQL} SELECT page_id, value,
      CASE WHEN value = '' THEN '' WHEN n = 1 THEN path END AS path,
      CASE WHEN value = '' THEN 'ok' WHEN n IS NULL THEN 'missing' WHEN n = 1 THEN 'ok' ELSE 'ambiguous' END AS status
    FROM v LEFT JOIN r USING (value)""",
)
def resolve_contains_query(spark: SparkSession, sf: str) -> DataFrame:
    return _searched_pages(spark, sf, "contains").select("page_id", F.col("_value").alias("value"), "path", "status")


@check(
    "match_cardinality",
    f"""WITH {CONTAINS_SQL} SELECT page_id,
      CASE WHEN value <> '' AND n > 1 THEN array_to_string(found, '|') END AS first_matches FROM v LEFT JOIN r USING (value)""",
)
def match_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    found = _searched_pages(spark, sf, "contains")
    return found.select("page_id", F.array_join("matches", "|").alias("first_matches"))


@check(
    "file_content",
    "SELECT l.doc_id, quality, text FROM labels l JOIN documents d ON l.doc_id = d.doc_id",
)
def file_content(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.table(spark, sf, "documents")
    padded = F.concat(F.lit("\t "), "text", F.lit(" \n"))
    path = D.placed("texts/", D.text_of("doc_id"), ".txt").alias("path")
    root, files = D.stored(spark, sf, "content", docs.select(path, F.encode(padded, "UTF-8").alias("content")))
    columns = {
        "doc_id": D.column("doc_id", "int"),
        "quality": D.column("quality", "int"),
        "text": D.column("doc_id", "file_content", file_extension="txt"),
    }
    spec = D.spec(columns=columns, base_audio_path="texts")
    out = map_columns(D.frame(D.table(spark, sf, "labels")), spec, D.corpus(files, root=root))
    return out.withColumn("quality", F.col("quality").cast("int"))


@check(
    "split_groups",
    "SELECT lang AS split, count(*) AS n_rows FROM documents WHERE source <> 'src0' GROUP BY lang",
)
def split_groups(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.table(spark, sf, "documents")
    return split_counts(docs.select(F.when(F.col("source") != "src0", F.col("lang")).alias("split")))


@check(
    "load_profile",
    """WITH o AS (SELECT o_orderpriority AS split, CASE WHEN o_orderkey % 7 = 0 THEN 'null' WHEN o_orderstatus = 'F'
      OR o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'ok' ELSE 'missing' END AS status FROM orders)
    SELECT split, count(*) AS n_rows, 0 AS status_nulls, count(DISTINCT status) AS status_distinct,
      count(*) FILTER (status = 'ok') AS n_ok, 0 AS n_unverified, count(*) FILTER (status = 'missing') AS n_missing,
      0 AS n_ambiguous, count(*) FILTER (status = 'null') AS n_null FROM o GROUP BY split""",
)
def load_profile_query(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and lookup results of each split, after an exact search in two roots."""
    value = F.when(F.col("o_orderkey") % 7 != 0, F.concat(D.text_of("o_orderkey"), F.lit(".wav")))
    orders = D.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("split"), value.alias("_value"))
    rule = PathRule(D.ROOT, D.ROOT, (f"{D.ROOT}/clips", f"{D.ROOT}/wavs"), "exact", "wav")
    found = resolve_values(orders, D.media_manifest(spark, sf), rule)
    return load_profile(found, ["status"], status="status")


@check("split_write", "SELECT doc_id, source, lang AS split FROM documents WHERE source <> 'src0'")
def split_write(spark: SparkSession, sf: str) -> DataFrame:
    split = F.when(F.col("source") != "src0", F.col("lang"))
    docs = D.table(spark, sf, "documents").select("doc_id", "source", split.alias("split"))
    target = D.fresh(spark, "split_write")
    write_splits(docs, target, ["en", "de", "fr", "es"])
    return spark.read.parquet(target)


# --- scalar expressions -----------------------------------------------------------------


@check(
    "unicode_strip",
    "SELECT doc_id, text AS stripped FROM documents",
)
def unicode_strip(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.table(spark, sf, "documents")
    padded = F.concat(F.lit(" \t \n"), "text", F.lit(" \r\n"))
    return docs.select("doc_id", X.strip(padded).alias("stripped"))


@check(
    "parent_roots",
    """WITH o AS (SELECT o_orderkey AS key, o_orderkey || '.wav' AS name, o_orderpriority IN ('1-URGENT', '2-HIGH') AS there FROM orders)
    SELECT 'direct' AS strategy, key, '/corpus/none/../wavs/../wavs/' || name AS path, CASE WHEN there THEN 'ok' ELSE 'unverified' END AS status FROM o
    UNION ALL SELECT 'exact', key, CASE WHEN there THEN '/corpus/none/../wavs/' || name END, CASE WHEN there THEN 'ok' ELSE 'missing' END FROM o""",
)
def parent_roots(spark: SparkSession, sf: str) -> DataFrame:
    """Roots and values with '..' find their files and keep their spelling."""
    orders, files = D.table(spark, sf, "orders"), D.media_manifest(spark, sf)
    found = []
    for strategy, above in (("direct", "../wavs/"), ("exact", "elsewhere/")):
        rule = PathRule(D.ROOT, D.ROOT, (f"{D.ROOT}/none/../wavs",), strategy, "wav")
        value = F.concat(F.lit(above), D.text_of("o_orderkey"), F.lit(".wav"))
        rows = resolve_values(orders.select(F.col("o_orderkey").alias("key"), value.alias("_value")), files, rule)
        found.append(rows.select(F.lit(strategy).alias("strategy"), "key", "path", "status"))
    return found[0].union(found[1])


@check(
    "four_path_columns",
    """WITH m AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '/corpus/clips/' || o_orderkey || '.wav'
      WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '/corpus/wavs/' || o_orderkey || '.wav'
      ELSE '/corpus/clips/' || o_orderkey END AS p FROM orders)
    SELECT l_orderkey AS key, l_linenumber AS line, m.p AS a, m.p AS b, m.p AS c, m.p AS d FROM lineitem JOIN m ON l_orderkey = o_orderkey""",
)
def four_path_columns(spark: SparkSession, sf: str) -> DataFrame:
    items = D.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    path = {"file_extension": ".wav"}
    columns = {"key": D.column("l_orderkey", "int"), "line": D.column("l_linenumber", "int")}
    columns |= {name: D.column("l_orderkey", "file_path", **path) for name in "abcd"}
    spec = D.spec(columns=columns, base_audio_path=["clips/", "wavs/"])
    return map_columns(D.frame(items), spec, D.corpus(D.media_manifest(spark, sf)))


@check("casefold", "SELECT doc_id, replace(lower(text), 'ß', 'ss') AS folded FROM documents")
def casefold(spark: SparkSession, sf: str) -> DataFrame:
    return D.table(spark, sf, "documents").select("doc_id", X.fold(F.col("text")).alias("folded"))


@check("collapse_whitespace", r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS squeezed FROM documents")
def collapse_whitespace(spark: SparkSession, sf: str) -> DataFrame:
    return D.table(spark, sf, "documents").select("doc_id", X.squeeze(F.col("text")).alias("squeezed"))


@check("bom_removal", "SELECT doc_id, text FROM documents")
def bom_removal(spark: SparkSession, sf: str) -> DataFrame:
    marked = F.encode(F.concat(F.lit("\ufeff"), "text"), "UTF-8")
    return D.table(spark, sf, "documents").select("doc_id", X.decode(marked, "utf-8-sig").alias("text"))


@check(
    "path_parts",
    f"WITH {D.PAGES_SQL} SELECT path, name, stem, ext AS suffix, string_split(path, '/')[-2] AS parent, "
    "string_split(path, '/')[-3] AS grandparent FROM mf",
)
def path_parts(spark: SparkSession, sf: str) -> DataFrame:
    path = F.col("path")
    return D.page_manifest(spark, sf).select(
        "path", P.basename(path).alias("name"), P.stem(path).alias("stem"), P.suffix(path).alias("suffix"),
        P.part_from_end(path, 2).alias("parent"), P.part_from_end(path, 3).alias("grandparent"),
    )


@check(
    "with_suffix",
    f"WITH {D.PAGES_SQL} SELECT path, path[:len(path) - len(ext)] || '.webm' AS swapped FROM mf",
)
def with_suffix(spark: SparkSession, sf: str) -> DataFrame:
    return D.page_manifest(spark, sf).select("path", P.with_suffix(F.col("path"), ".webm").alias("swapped"))


@check("relative_to", f"WITH {D.PAGES_SQL} SELECT path, lower(rel) AS relative FROM mf")
def relative_to(spark: SparkSession, sf: str) -> DataFrame:
    return D.page_manifest(spark, sf).select("path", F.lower(P.relative_to(F.col("path"), D.ROOT)).alias("relative"))


@check("component_strip", f"WITH {D.PAGES_SQL} SELECT rel AS stripped FROM pg")
def component_strip(spark: SparkSession, sf: str) -> DataFrame:
    padded = F.concat(F.lit(" "), F.regexp_replace(D.page_rel(), "/", " / "), F.lit("\t"))
    return D.table(spark, sf, "pages").select(P.strip_parts(padded).alias("stripped"))


@check(
    "strip_archive_suffix",
    "SELECT p_partkey AS key, 'a.b/x' || p_partkey AS stripped FROM part",
)
def strip_archive_suffix(spark: SparkSession, sf: str) -> DataFrame:
    endings = F.array(*[F.lit(e) for e in (".tar.gz", ".tgz", ".zip", ".tar", "")])
    ending = F.element_at(endings, (F.col("p_size") % 5 + 1).cast("int"))
    name = F.concat(F.lit("a.b/x"), D.text_of("p_partkey"), ending)
    return D.table(spark, sf, "part").select(F.col("p_partkey").alias("key"), P.strip_archive_suffix(name).alias("stripped"))


@check(
    "human_bytes",
    """WITH b AS (SELECT o_orderkey AS key, CAST(floor(o_totalprice * o_orderkey) AS BIGINT) AS n FROM orders),
    f AS (SELECT key, CAST(n AS DOUBLE) AS v, least(5, CASE WHEN n < 1024 THEN 0 WHEN n < 1048576 THEN 1
      WHEN n < 1073741824 THEN 2 WHEN n < 1099511627776 THEN 3 ELSE 4 END) AS p FROM b)
    SELECT key, printf('%.1f', v / (1024.0 ** p)) || ' ' || ['B', 'KB', 'MB', 'GB', 'TB'][CAST(p AS INT) + 1] AS size FROM f""",
)
def human_bytes(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.floor(F.col("o_totalprice") * F.col("o_orderkey")).cast("long")
    return D.table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), S.human_bytes(amount).alias("size"))


@check(
    "remaining_percentage",
    "SELECT l_orderkey AS key, l_linenumber AS line, l_partkey AS part, CASE WHEN l_discount = 0 THEN 0.0 "
    "ELSE round((50 - l_quantity) / 50 * 100, 2) END AS remaining FROM lineitem",
)
def remaining_percentage(spark: SparkSession, sf: str) -> DataFrame:
    total = F.when(F.col("l_discount") == 0, 0).otherwise(50)
    return D.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"),
        S.remaining_percentage(F.col("l_quantity"), total).alias("remaining"),
    )


@check(
    "trim_reject_empty",
    "SELECT c_custkey AS key, CASE WHEN c_nationkey <> 1 THEN c_name END AS name, c_nationkey = 1 AS rejected FROM customer",
)
def trim_reject_empty(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.when(F.col("c_nationkey") == 1, " \t ").otherwise(F.concat(F.lit(" "), "c_name", F.lit("\n")))
    rows = D.table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), raw.alias("name"))
    rejected = F.array_contains("violations", "name:empty")
    found = validate_submissions(rows, ("key",))
    return found.select("key", F.when(~rejected, F.col("name")).alias("name"), rejected.alias("rejected"))


@check(
    "enum_membership",
    "SELECT c_custkey AS key, c_nationkey % 3 <> 2 AS task_ok, c_nationkey % 3 = 0 AS license_ok, "
    "c_nationkey % 3 = 1 AS visibility_ok FROM customer",
)
def enum_membership(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("c_nationkey") % 3
    task = F.when(kind == 0, "ASR").when(kind == 1, "N/A").otherwise("asr")
    license_ = F.when(kind == 0, "CC-BY-4.0").when(kind == 1, "cc-by-4.0").otherwise("Custom")
    visibility = F.when(kind == 1, "restricted").otherwise("internal")
    rows = D.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), task.alias("task"), license_.alias("licenseAbbreviation"), visibility.alias("visibility")
    )
    found = validate_submissions(rows, ("key",))
    listed = lambda name: ~F.array_contains("violations", f"{name}:not_listed")
    return found.select("key", listed("task").alias("task_ok"), predefined_license(found).alias("license_ok"), listed("visibility").alias("visibility_ok"))


@check("file_sha256", "SELECT doc_id, CAST(strlen(text) AS BIGINT) AS bytes_read, sha256(text) AS sha256 FROM documents")
def file_sha256(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.table(spark, sf, "documents")
    path = D.placed(D.text_of("doc_id"), ".txt").alias("path")
    _, files = D.stored(spark, sf, "digests", docs.select(path, F.encode("text", "UTF-8").alias("content")))
    doc_id = P.stem(F.col("path")).cast("long").alias("doc_id")
    return file_digests(files).select(doc_id, "bytes_read", "sha256")


@check(
    "null_coalesce",
    "SELECT doc_id, coalesce(CAST(quality AS VARCHAR), '') AS cell, quality IS NULL AS absent "
    "FROM documents LEFT JOIN labels USING (doc_id)",
)
def null_coalesce(spark: SparkSession, sf: str) -> DataFrame:
    """Missing cells of an index, empty or a missing token, are null after the scan."""
    docs = D.table(spark, sf, "documents").join(D.table(spark, sf, "labels"), "doc_id", "left")
    cell = F.coalesce(D.text_of("quality"), F.when(F.col("doc_id") % 2 == 0, "NA").otherwise(""))
    raw = docs.select(F.col("doc_id").cast("string").alias("_c0"), cell.alias("_c1"), F.lit(None).cast("string").alias("_extra"))
    columns = {"doc_id": D.column("doc_id", "int"), "quality": D.column("quality")}
    frame = IndexFrame(tidy(raw, 2, "null"), ["doc_id", "quality"])
    mapped = map_columns(frame, D.spec(columns=columns), D.corpus(None))
    return mapped.select("doc_id", F.coalesce("quality", F.lit("")).alias("cell"), F.col("quality").isNull().alias("absent"))
