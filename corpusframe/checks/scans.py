"""Queries over sources: delimited indexes, listings, sidecars, archives, layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusframe.checks import derived as D
from corpusframe.checks.registry import check
from corpusframe.functions.text import decode
from corpusframe.operators import locate, sidecars
from corpusframe.operators.mapping import map_columns
from corpusframe.operators.resolve import PathRule, direct_candidates
from corpusframe.plans import datasource
from corpusframe.plans.layouts import glob_rows, json_frame, load, split_glob
from corpusframe.sources import storage
from corpusframe.sources.archives import archive_members, fetch_members, member_index
from corpusframe.sources.files import (
    io_tasks,
    list_files,
    manifest_of,
    matches_glob,
    scan_manifest,
    write_files,
)


@check("index_scan", "SELECT doc_id, lang, text FROM documents")
def index_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.table(spark, sf, "documents").select("doc_id", "lang", "text")
    root = D.shards(docs, D.fresh(spark, "index"), "train.tsv", sep="\t")
    columns = {"doc_id": D.column("doc_id", "int"), "lang": D.column("lang"), "text": D.column("text")}
    return load(spark, D.spec(index_file="train.tsv", columns=columns), root)


@check("separator_resolution", "SELECT p_partkey AS key, p_name AS name, p_type AS kind FROM part")
def separator_resolution(spark: SparkSession, sf: str) -> DataFrame:
    part = D.table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    root = D.shards(part, D.fresh(spark, "index"), "part.psv", sep="|")
    columns = {"key": D.column("p_partkey", "int"), "name": D.column("p_name"), "kind": D.column("p_type")}
    return load(spark, D.spec(index_file="part.psv", columns=columns), root)


@check("separator_sniff_retry", "SELECT s_suppkey AS key, s_name AS name FROM supplier")
def separator_sniff_retry(spark: SparkSession, sf: str) -> DataFrame:
    supplier = D.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    root = D.shards(supplier, D.fresh(spark, "index"), "supplier.csv", sep=";")
    columns = {"key": D.column("s_suppkey", "int"), "name": D.column("s_name")}
    return load(spark, D.spec(index_file="supplier.csv", format="csv", columns=columns), root)


@check("header_normalise", "SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment FROM customer")
def header_normalise(spark: SparkSession, sf: str) -> DataFrame:
    customer = D.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("\ufeffCust Key"),
        F.col("c_name").alias("  Name "),
        F.col("c_mktsegment").alias("Mkt   Segment"),
    )
    root = D.shards(customer, D.fresh(spark, "index"), "customer.csv")
    columns = {"key": D.column("Cust Key", "int"), "name": D.column("Name"), "segment": D.column("mkt segment")}
    return load(spark, D.spec(index_file="customer.csv", columns=columns), root)


@check("encoding", "SELECT conv_id, turn, text FROM conversations")
def encoding(spark: SparkSession, sf: str) -> DataFrame:
    turns = D.table(spark, sf, "conversations").select("conv_id", "turn", "text")
    root = D.shards(turns, D.fresh(spark, "index"), "turns.csv", encoding="ISO-8859-1")
    columns = {"conv_id": D.column("conv_id", "int"), "turn": D.column("turn", "int"), "text": D.column("text")}
    return load(spark, D.spec(index_file="turns.csv", encoding="latin-1", columns=columns), root)


@check("headerless_positional", "SELECT p_partkey AS key, p_brand AS brand, p_size AS size FROM part")
def headerless_positional(spark: SparkSession, sf: str) -> DataFrame:
    part = D.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    root = D.shards(part, D.fresh(spark, "index"), "part.txt", sep="|", header=False)
    columns = {"key": D.column(0, "int"), "brand": D.column(2), "size": D.column(3, "int")}
    spec = D.spec(index_file="part.txt", format="pipe", has_header=False, columns=columns)
    return load(spark, spec, root).withColumn("size", F.col("size").cast("int"))


@check(
    "raw_passthrough",
    "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier",
)
def raw_passthrough(spark: SparkSession, sf: str) -> DataFrame:
    supplier = D.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    root = D.shards(supplier, D.fresh(spark, "index"), "meta.csv")
    return load(spark, D.spec(task="TTS", index_file="meta.csv"), root)


@check(
    "index_locate",
    f"WITH {D.PAGES_SQL} SELECT arg_min(path, struct_pack(d := depth, p := path)) AS path, "
    "min(depth) AS depth, count(*) AS n_candidates FROM mf WHERE ext = '.html'",
)
def index_locate(spark: SparkSession, sf: str) -> DataFrame:
    found = locate.index_candidates(D.page_manifest(spark, sf), "*.html")
    return found.agg(
        F.min_by("path", F.struct("depth", "path")).alias("path"),
        F.min("depth").cast("long").alias("depth"),
        F.count(F.lit(1)).alias("n_candidates"),
    )


@check(
    "dataset_root",
    f"WITH {D.PAGES_SQL} SELECT path, regexp_replace(path, '/en/[^/]+$', '') AS root FROM mf "
    "WHERE rel LIKE '%/en/%.html'",
)
def dataset_root(spark: SparkSession, sf: str) -> DataFrame:
    found = locate.index_candidates(D.page_manifest(spark, sf), "en/*.html")
    return found.select("path", locate.root_of(F.col("path"), "en/*.html").alias("root"))


@check(
    "manifest",
    "SELECT lang || '/' || doc_id || '.txt' AS rel_path, doc_id || '.txt' AS name, "
    "CAST(doc_id AS VARCHAR) AS stem, '.txt' AS ext, lang AS parent, "
    "CAST(strlen(text) AS BIGINT) AS length FROM documents",
)
def manifest(spark: SparkSession, sf: str) -> DataFrame:
    root = D.fresh(spark, "tree")
    path = F.concat(F.lit(root + "/"), "lang", F.lit("/"), D.text_of("doc_id"), F.lit(".txt"))
    docs = D.table(spark, sf, "documents")
    write_files(docs.select(path.alias("path"), F.encode("text", "UTF-8").alias("content")))
    return scan_manifest(spark, root).select("rel_path", "name", "stem", "ext", "parent", "length")


@check(
    "glob_filter",
    f"WITH {D.TREE_SQL} SELECT '/corpus/' || rel AS path FROM t "
    "WHERE split = 'train' AND regexp_matches(source, '^src1.?$') AND lang = 'en'",
)
def glob_filter(spark: SparkSession, sf: str) -> DataFrame:
    tree = D.document_tree(spark, sf)
    one = tree.filter(matches_glob("train/src1/en/*.txt"))
    two = tree.filter(matches_glob("train/src1?/**/en/*.[t]xt"))
    return one.union(two).select("path")


@check(
    "paired_text",
    "SELECT '/corpus/' || lang || '/' || doc_id || '.webm' AS audio_path, text AS transcription, "
    "lang AS split FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
)
def paired_text(spark: SparkSession, sf: str) -> DataFrame:
    root, files = text_and_media(spark, sf)
    pairs = sidecars.pair_text(sidecars.paired_files(files, "**/*.txt", "webm"), "utf-8")
    return pairs.withColumn("audio_path", D.home(F.col("audio_path"), root))


def text_and_media(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """Root and manifest of files: padded text of every document, media for the labelled ones."""
    docs = D.table(spark, sf, "documents")
    labelled = docs.join(D.table(spark, sf, "labels"), "doc_id", "left_semi")
    base = D.placed(F.col("lang"), "/", D.text_of("doc_id"))
    padded = F.concat(F.lit("  "), "text", F.lit("\t\r\n"))
    texts = docs.select(F.concat(base, F.lit(".txt")).alias("path"), F.encode(padded, "UTF-8").alias("content"))
    media = labelled.select(F.concat(base, F.lit(".webm")).alias("path"), F.lit(None).cast("binary").alias("content"))
    return D.stored(spark, sf, "pairs", texts.union(media))


@check(
    "corpus_source",
    "SELECT '/corpus/' || lang || '/' || doc_id || '.txt' AS path, lang AS language, '.txt' AS ext, "
    "CAST(strlen(text) + 6 AS BIGINT) AS length, ' ' || chr(160) || text || chr(9) || chr(13) || chr(10) AS content FROM documents "
    "UNION ALL SELECT '/corpus/' || lang || '/' || doc_id || '.webm', lang, '.webm', 0, NULL "
    "FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
)
def corpus_source(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with their contents, media without, through the data source; each read plans its own parts only."""
    root, files = text_and_media(spark, sf)
    target = D.fresh(spark, "source")
    datasource.prepare(spark, D.spec(root_strategy="glob", file_pattern="**/*"), root, target, files)
    columns = ["audio_path", "language", "ext", "length"]
    texts = datasource.read_files(spark, target, [*columns, "content"], extensions=[".txt"])
    media = datasource.read_files(spark, target, columns, extensions=[".webm"])
    both = texts.withColumn("content", F.decode("content", "UTF-8")).unionByName(media, allowMissingColumns=True)
    return both.withColumn("audio_path", D.home(F.col("audio_path"), root)).withColumnRenamed("audio_path", "path")


@check(
    "pair_exists",
    "SELECT '/corpus/' || lang || '/' || doc_id || '.txt' AS path FROM documents "
    "WHERE doc_id IN (SELECT doc_id FROM labels)",
)
def pair_exists(spark: SparkSession, sf: str) -> DataFrame:
    root, files = text_and_media(spark, sf)
    return sidecars.paired_files(files, "**/*.txt", ".webm").select(D.home(F.col("path"), root).alias("path"))


JSON_COLUMNS = {
    "file": D.column("audio.filename"),
    "conv": D.column("metadata.conv_id", "int"),
    "turn": D.column("metadata.turn", "int"),
    "role": D.column("role"),
    "n": D.column("n", "int"),
    "line": D.column("text"),
}


def sidecar_records(spark: SparkSession, sf: str, record_path: str | None = "segments") -> DataFrame:
    root, files = D.stored(spark, sf, "sidecars", D.sidecar_files(spark, sf))
    documents = sidecars.json_documents(files, "**/*.json", "utf-8")
    return sidecars.explode_records(documents, record_path).withColumn("path", D.home(F.col("path"), root))


@check(
    "paired_json",
    f"WITH {D.SEGMENTS_SQL} SELECT '/corpus/media/' || conv_id || '_' || turn || '.webm' AS audio_path, "
    "conv_id AS conv, turn, role, n, line FROM seg",
)
def paired_json(spark: SparkSession, sf: str) -> DataFrame:
    columns = {
        "audio_path": D.column("audio.filename", "file_path", path_match_strategy="exact"),
        **{k: v for k, v in JSON_COLUMNS.items() if k != "file"},
    }
    turns = D.table(spark, sf, "conversations")
    name = F.concat(D.text_of("conv_id"), F.lit("_"), D.text_of("turn"), F.lit(".webm"))
    media = turns.select(D.placed("media/", name).alias("path"), F.lit(None).cast("binary").alias("content"))
    root, _ = D.stored(spark, sf, "records", D.sidecar_files(spark, sf).union(media))
    spec = D.spec(task="ASR", format="json", root_strategy="paired_glob", file_pattern="json/*.json",
                  record_path="segments", base_audio_path="media", columns=columns)
    return load(spark, spec, root).withColumn("audio_path", D.home(F.col("audio_path"), root))


@check(
    "record_explode",
    f"WITH {D.SEGMENTS_SQL} SELECT '/corpus/json/' || conv_id || '_' || turn || '.json' AS path, "
    "n AS position, line FROM seg",
)
def record_explode(spark: SparkSession, sf: str) -> DataFrame:
    records = sidecar_records(spark, sf)
    line = F.variant_get("record", "$.text", "string")
    return records.select("path", F.col("position").cast("long").alias("position"), line.alias("line"))


@check(
    "json_flatten",
    "SELECT conv_id || '_' || turn || '.webm' AS file, conv_id AS conv, turn, role, "
    "len(string_split(text, chr(10))) AS n_records FROM conversations",
)
def json_flatten(spark: SparkSession, sf: str) -> DataFrame:
    records = sidecar_records(spark, sf, record_path=None)
    flat = {k: sidecars.flattened(v["source_column"], None)[0] for k, v in JSON_COLUMNS.items()}
    listed, _ = sidecars.flattened("segments", None)
    return records.select(
        flat["file"].alias("file"),
        flat["conv"].cast("long").alias("conv"),
        flat["turn"].cast("long").alias("turn"),
        flat["role"].alias("role"),
        F.json_array_length(listed).cast("long").alias("n_records"),
    )


@check(
    "record_meta_broadcast",
    f"WITH {D.SEGMENTS_SQL} SELECT conv_id || '_' || turn || '.webm' AS file, conv_id AS conv, turn, line FROM seg",
)
def record_meta_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    columns = {k: JSON_COLUMNS[k] for k in ("file", "conv", "turn", "line")}
    spec = D.spec(record_path="segments", columns=columns)
    return map_columns(json_frame(sidecar_records(spark, sf), spec), spec, D.corpus(None))


@check(
    "meta_precedence",
    f"WITH {D.SEGMENTS_SQL} SELECT role, count(*) AS n_records FROM seg GROUP BY role",
)
def meta_precedence(spark: SparkSession, sf: str) -> DataFrame:
    # every record has its own "role" too; the document's one wins
    role, _ = sidecars.flattened("role", "segments")
    return sidecar_records(spark, sf).groupBy(role.alias("role")).agg(F.count(F.lit(1)).alias("n_records"))


@check(
    "glob_layout",
    f"WITH {D.TREE_SQL} SELECT '/corpus/' || rel AS audio_path, lang AS language, source AS speaker_id FROM t",
)
def glob_layout(spark: SparkSession, sf: str) -> DataFrame:
    return glob_rows(D.document_tree(spark, sf), "**/*.txt")


@check(
    "glob_layout_splits",
    f"WITH {D.TREE_SQL} SELECT '/corpus/' || rel AS audio_path, lang AS language, source AS speaker_id, split FROM t",
)
def glob_layout_splits(spark: SparkSession, sf: str) -> DataFrame:
    return split_glob(D.document_tree(spark, sf), "*.txt", ["train", "dev"])


@check(
    "missing_splits",
    "WITH names AS (SELECT 'src' || i AS folder FROM range(40) r(i)) "
    "SELECT folder FROM names WHERE folder NOT IN (SELECT source FROM documents)",
)
def missing_splits(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.table(spark, sf, "documents")
    tree = D.manifest(docs, D.placed(F.col("source"), "/", D.text_of("doc_id")))
    return locate.missing_folders(tree, [f"src{i}" for i in range(40)])


STATUSES = ["F", "O", "P"]


def status_indexes(spark: SparkSession, sf: str) -> str:
    """One index folder per order status; the one of status P lacks the priority."""
    orders = D.table(spark, sf, "orders")
    folder = D.fresh(spark, "splits")
    for status in STATUSES:
        columns = ["o_orderkey", "o_custkey"] + (["o_orderpriority"] if status != "P" else [])
        D.shards(orders.filter(F.col("o_orderstatus") == status).select(*columns), folder, f"{status}.tsv", sep="\t")
    return folder


@check(
    "multi_split",
    "SELECT o_orderkey AS key, o_custkey AS cust, "
    "CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority, o_orderstatus AS split FROM orders",
)
def multi_split(spark: SparkSession, sf: str) -> DataFrame:
    columns = {
        "key": D.column("o_orderkey", "int"),
        "cust": D.column("o_custkey", "int"),
        "priority": D.column("o_orderpriority", "category", optional=True),
    }
    spec = D.spec(task="ASR", root_strategy="multi_split", splits=[*STATUSES, "absent"], columns=columns)
    return load(spark, spec, status_indexes(spark, sf)).select("key", "cust", "priority", "split")


@check(
    "union_by_name",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, "
    "CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority, o_orderstatus AS split FROM orders",
)
def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    spec = D.spec(task="ASR", root_strategy="multi_split", splits=STATUSES)
    return load(spark, spec, status_indexes(spark, sf))


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@check(
    "multi_sections",
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment AS section FROM customer",
)
def multi_sections(spark: SparkSession, sf: str) -> DataFrame:
    customer = D.table(spark, sf, "customer")
    folder = D.fresh(spark, "sections")
    for name in SEGMENTS:
        rows = customer.filter(F.col("c_mktsegment") == name).select("c_custkey", "c_name")
        D.shards(rows, f"{folder}/data/{name}", "metadata.tsv", sep="\t")
    spec = D.spec(task="TTS", root_strategy="multi_sections", section_root="data",
                  index_file="metadata.tsv", sections=SEGMENTS)
    return load(spark, spec, folder)


def _pack(batches, kinds=(".tar.gz", ".zip", ".tar")):
    """Corpus preparation: every 500 documents become one archive, kinds taking turns."""
    import io
    import tarfile
    import zipfile

    import pandas as pd

    for batch in batches:
        for start in range(0, len(batch), 500):
            part = batch.iloc[start : start + 500]
            first = part["doc_id"].iloc[0]
            kind = kinds[first % len(kinds)]
            names = [f"{lang}/{doc}.txt" for lang, doc in zip(part["lang"], part["doc_id"])]
            bodies = [text.encode("utf-8") for text in part["text"]]
            out = io.BytesIO()
            if kind == ".zip":
                with zipfile.ZipFile(out, "w") as packed:
                    for name, body in zip(names, bodies):
                        packed.writestr(name, body)
            else:
                with tarfile.open(fileobj=out, mode="w:gz" if kind == ".tar.gz" else "w") as packed:
                    for name, body in zip(names, bodies):
                        info = tarfile.TarInfo(name)
                        info.size = len(body)
                        packed.addfile(info, io.BytesIO(body))
            storage.write_binary(f"{part['folder'].iloc[0]}/pack-{first}{kind}", out.getvalue())
        yield pd.DataFrame({"n": [len(batch)]})


@check(
    "archive_members",
    "SELECT lang || '/' || doc_id || '.txt' AS member, CAST(strlen(text) AS BIGINT) AS length, text FROM documents",
)
def archive_members_query(spark: SparkSession, sf: str) -> DataFrame:
    folder = D.fresh(spark, "packs")
    docs = D.table(spark, sf, "documents").select("doc_id", "lang", "text", F.lit(folder).alias("folder"))
    docs.repartition(io_tasks(spark), "doc_id").mapInPandas(_pack, "n long").write.format("noop").mode("overwrite").save()
    members = archive_members(list_files(spark, folder), r"\.txt$")
    return members.select("member", "length", decode(F.col("content"), "utf-8").alias("text"))


@check(
    "member_index",
    "SELECT lang || '/' || doc_id || '.txt' AS member, CAST(strlen(text) AS BIGINT) AS length, "
    "CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN text END AS text FROM documents",
)
def member_index_query(spark: SparkSession, sf: str) -> DataFrame:
    """All members from a stored index; the bytes of those of labelled documents alone."""
    folder, store = D.fresh(spark, "packs"), D.fresh(spark, "member-index")
    docs = D.table(spark, sf, "documents").select("doc_id", "lang", "text", F.lit(folder).alias("folder"))
    packed = docs.repartition(io_tasks(spark), "doc_id").mapInPandas(lambda batches: _pack(batches, (".zip", ".tar")), "n long")
    packed.write.format("noop").mode("overwrite").save()
    member_index(list_files(spark, folder)).write.parquet(store)
    index = spark.read.parquet(store)
    labelled = D.table(spark, sf, "labels").select(F.concat(F.lit("/"), D.text_of("doc_id"), F.lit(".txt")).alias("end")).distinct()
    wanted = index.join(labelled, F.concat(F.lit("/"), F.substring_index("member", "/", -1)) == F.col("end"), "left_semi")
    read = fetch_members(wanted).select("archive", "member", decode(F.col("content"), "utf-8").alias("text"))
    # contents are more than Spark guesses, so they are never broadcast
    return index.join(read.hint("merge"), ["archive", "member"], "left").select("member", "length", "text")


@check(
    "file_order",
    f"WITH {D.PAGES_SQL} SELECT rel AS rel_path, depth FROM mf ORDER BY depth, rel",
)
def file_order(spark: SparkSession, sf: str) -> DataFrame:
    ordered = locate.in_order(D.page_manifest(spark, sf))
    return ordered.select("rel_path", F.col("depth").cast("long").alias("depth"))


@check(
    "shallowest_per_key",
    f"WITH {D.PAGES_SQL} SELECT stem, arg_min(path, struct_pack(d := depth, p := path)) AS path FROM mf GROUP BY stem",
)
def shallowest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return locate.shallowest(D.page_manifest(spark, sf), ["stem"])


@check(
    "dedupe",
    """SELECT o_orderkey || '.wav' AS value, unnest([0, 1]) AS place,
      unnest(['/corpus/clips/' || o_orderkey || '.wav', '/corpus/' || o_orderkey || '.wav']) AS path FROM orders""",
)
def dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Roots that are given twice, and the corpus root that is also the dataset's, give one candidate each."""
    value = F.concat(D.text_of("o_orderkey"), F.lit(".wav")).alias("_value")
    values = D.table(spark, sf, "orders").select(value)
    rule = PathRule(D.ROOT, D.ROOT, (f"{D.ROOT}/clips", f"{D.ROOT}/clips"), "direct", "wav")
    found = direct_candidates(rule.with_roots(values), rule)
    return found.select(F.col("_value").alias("value"), F.col("_ord").alias("place"), "path")


@check(
    "allow_list_filter",
    f"WITH {D.TREE_SQL} SELECT split, '/corpus/' || rel AS path FROM t WHERE split = 'train' AND lang = 'en'",
)
def allow_list_filter(spark: SparkSession, sf: str) -> DataFrame:
    return split_glob(D.document_tree(spark, sf), "en/*.txt", ["train"]).select("split", F.col("audio_path").alias("path"))
