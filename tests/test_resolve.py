"""Resolvers against a brute-force matcher, skewed joins, and the plans they make."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from corpusframe import manifest_of
from corpusframe.functions import paths as P
from corpusframe.operators import skew
from corpusframe.operators.resolve import (
    PathRule,
    direct_candidates,
    resolve_contains,
    resolve_direct,
    resolve_exact,
    resolve_values,
)
from corpusframe.operators.skew import key_counts, lookup


def stem_and_suffix(name):
    dot = name.rfind(".")
    return (name[:dot], name[dot:]) if 0 < dot < len(name) - 1 else (name, "")


def brute(value, files, roots, strategy, extension):
    """All matches in order: per root, by depth and path."""
    extension = extension and ("." + extension.lstrip("."))
    matches = []
    base = value.rsplit("/", 1)[-1]
    bare = stem_and_suffix(base)[1] == ""
    for root in roots:
        below = [f for f in files if f.startswith(root + "/")]
        for path in sorted(below, key=lambda p: (p.count("/"), p)):
            name = path.rsplit("/", 1)[-1]
            stem, suffix = stem_and_suffix(name)
            if name.startswith("._") or (extension and suffix.lower() != extension.lower()):
                continue
            rels = [path[len(r) + 1 :].lower() for r in roots if path.startswith(r + "/")]
            if strategy == "exact":
                hit = (
                    name == base
                    or (bare and stem == base)
                    or (bare and extension and name == base + extension)
                    or value.lower() in rels
                    or (bare and extension and value.lower() + extension.lower() in rels)
                )
            else:
                hit = any(value.lower() in t for t in (name.lower(), stem.lower(), *rels))
            if hit and path not in matches:
                matches.append(path)
    return matches


def random_corpus(seed):
    rng = random.Random(seed)
    part = lambda: "".join(rng.choices("abAB1.", k=rng.randint(1, 3))).strip(".") or "a"
    files = set()
    for _ in range(150):
        folders = [rng.choice(["x", "y", "x/z", "w"]) for _ in range(rng.randint(0, 2))]
        name = ("._" if rng.random() < 0.05 else "") + part() + rng.choice([".wav", ".WAV", "", ".ogg"])
        files.add("/".join(["/c", *folders, name]))
    files = sorted(f for f in files if not any(g.startswith(f + "/") for g in files))
    values = {part() + rng.choice(["", ".wav"]) for _ in range(60)} | {
        f.split("/", 2)[2].upper() if rng.random() < 0.3 else f.split("/", 2)[2] for f in rng.sample(files, 40)
    }
    return files, sorted(values)


@pytest.mark.parametrize("seed,extension,roots", [(1, None, ("/c",)), (2, "wav", ("/c/x", "/c/y", "/c")), (3, ".wav", ("/c/x/z", "/c/x"))])
@pytest.mark.parametrize("strategy", ["exact", "contains"])
def test_search_equals_brute_force(spark, strategy, seed, extension, roots):
    files, values = random_corpus(seed)
    manifest = manifest_of(spark.createDataFrame([(f,) for f in files], "path string"), "/c")
    rule = PathRule("/none", "/none", roots, strategy, extension)
    counted = rule.with_roots(spark.createDataFrame([(v, 1) for v in values], "_value string, _n long"))
    if strategy == "exact":
        runs = [resolve_exact(counted, manifest, rule), resolve_exact(counted, manifest, rule, hot_rows=1)]
    else:
        runs = [resolve_contains(counted, manifest, rule)]
    for run in runs:
        found = {r["_value"]: r for r in run.collect()}
        for value in values:
            expected = brute(value, files, roots, strategy, extension)
            got = found.get(value)
            if not expected:
                assert got is None, value
            elif len(expected) == 1:
                assert (got["status"], got["path"]) == ("ok", expected[0]), value
            else:
                assert got["status"] == "ambiguous", value
                assert got["matches"] == expected[:5], value


def test_direct_lookup_runs_before_a_search_and_null_stays_null(spark):
    files = spark.createDataFrame([("/c/a.wav",), ("/c/x/a.wav",), ("/c/x/b.wav",)], "path string")
    data = spark.createDataFrame([(1, "a.wav"), (2, "b"), (3, None), (4, ""), (5, "zz")], "id int, _value string")
    rule = PathRule("/c", "/c", ("/c",), "exact", "wav")
    found = {r["id"]: (r["path"], r["status"]) for r in resolve_values(data, manifest_of(files, "/c"), rule).collect()}
    assert found == {
        1: ("/c/a.wav", "ok"), 2: ("/c/x/b.wav", "ok"), 3: (None, "null"), 4: ("", "ok"), 5: (None, "missing"),
    }


def test_candidates_in_order(spark):
    values = spark.createDataFrame([("./a//b",), ("c.ogg",), ("/abs",)], "_value string")
    rule = PathRule("/c/d", "/c", ("/c/d/m",), "direct", "wav")
    listed = direct_candidates(rule.with_roots(values), rule).orderBy("_value", "_ord").collect()
    by_value = {}
    for r in listed:
        by_value.setdefault(r["_value"], []).append(r["path"])
    assert by_value == {
        "./a//b": [f"/c/{p}a/b{e}" for e in ("", ".wav") for p in ("d/m/", "d/", "")],
        "c.ogg": ["/c/d/m/c.ogg", "/c/d/c.ogg", "/c/c.ogg"],
        "/abs": ["/abs", "/abs.wav"],
    }


def test_lookup_spreads_hot_and_null_keys(spark):
    n = 30_000
    df = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE CAST(id AS STRING) END AS k", "id % 7 AS same"
    ).repartition(8)
    table = spark.range(n).selectExpr("CAST(id AS STRING) AS k", "id AS v").union(spark.sql("SELECT 'hot', -1L"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = lookup(df, table, ["k"], hot_rows=500)
        sizes = joined.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
        counted = lookup(df, table.join(key_counts(df, ["k"]), "k", "left").fillna(1, ["_n"]), ["k"], hot_rows=500)
        results = [joined.selectExpr("count(*)", "count(v)", "sum(v)", "count_if(v = -1)").first()]
        results.append(counted.selectExpr("count(*)", "count(v)", "sum(v)", "count_if(v = -1)").first())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < n / 4  # a third of the rows each share one key and no key
    expected = sum(i for i in range(n) if i % 3 == 2) - n // 3
    assert [tuple(r) for r in results] == [(n, 2 * n // 3, expected, n // 3)] * 2


def test_plans_have_no_nested_loops_and_no_python(spark):
    files = spark.range(50).selectExpr("concat('/c/x/', id, '.wav') AS path")
    data = spark.range(50).selectExpr("CAST(id AS STRING) AS _value")
    for strategy in ("direct", "exact", "contains"):
        rule = PathRule("/c", "/c", ("/c",), strategy, "wav")
        found = resolve_values(data, manifest_of(files, "/c"), rule)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
        if strategy != "direct":
            assert "WindowGroupLimit" in plan  # first matches are limited before the shuffle
    assert skew.MAX_HOT_KEYS <= 10_000  # the list is broadcast


def test_scan_reads_only_needed_columns(spark):
    from corpusframe.checks.registry import QUERIES
    import __spark_entry__  # noqa: F401

    df = QUERIES["resolve_direct"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan


ODD_VALUES = [
    "a", "a.wav", "b", "x/b", "../m/a", "../m/../m/a.wav", "../../../up", "a.", "a/.", ".", "..", "x/..", ".wav", "x/.wav", "/c/m/a", "/c/m/a.wav",
    "/c/m/x/../a", "dot.ted", "dot.ted.wav", "gone", "x/gone.wav", "só", "s3://k/a", "s3://k/../a", "m", "deep/1/2/../../a", "deep/1/2/3/../../../a",
]
ODD_FILES = [
    "/c/m/a.wav", "/c/m/b", "/c/m/b.wav", "/c/m/x/b.wav", "/up.wav", "/c/m/.wav", "/c/m/x/.wav.wav", "/c/d/a", "/c/m/dot.ted.wav", "/c/m/dot.ted",
    "/c/a..wav", "/c/m/..wav", "/c/m/só.wav", "s3://k/a.wav", "/c/m/deep/a.wav", "/c.wav", "/c/m.wav", "/c/m/x/...wav",
]


@pytest.mark.parametrize("extension", [None, "wav", ".", "ted.wav"])
@pytest.mark.parametrize("roots", [("/c/m",), ("/c/none/../m", "/c/m/x"), ("s3://k", "/c")])
def test_direct_lookup_equals_probing_each_candidate(spark, extension, roots):
    rule = PathRule("/c/d", "/c", roots, "direct", extension)
    counted = rule.with_roots(spark.createDataFrame([(v, 1) for v in ODD_VALUES], "_value string, _n long"))
    files = spark.createDataFrame([(f,) for f in ODD_FILES * 2], "path string")
    expected = {}
    for r in direct_candidates(counted, rule).orderBy("_ord").collect():
        walked = []
        for part in r["path"].split("/"):
            walked = walked[: max(len(walked) - 1, 1)] if part == ".." and "/.." in r["path"] else [*walked, part]
        if "/".join(walked) in ODD_FILES:
            expected.setdefault(r["_value"], r["_ord"])
    found = {r["_value"]: r["_ord"] for r in resolve_direct(counted, files, rule).collect()}
    assert found == expected and len(expected) >= 3


def shuffled_rows(df):
    """Rows written by the shuffles of the executed plan."""
    def walk(plan):
        name = plan.getClass().getSimpleName()
        if name == "ShuffleExchangeExec":
            yield plan.metrics().apply("shuffleRecordsWritten").value()
        if name == "AdaptiveSparkPlanExec":
            yield from walk(plan.executedPlan())
        elif name.endswith("QueryStageExec"):
            yield from walk(plan.plan())
        children = plan.children()
        for i in range(children.size()):
            yield from walk(children.apply(i))

    return list(walk(df._jdf.queryExecution().executedPlan()))


def test_only_candidates_in_folders_with_files_are_shuffled_and_spellings_share_a_row(spark):
    n = 500
    values = spark.range(n).selectExpr("CAST(id AS STRING) AS _value", "1L AS _n")
    files = spark.range(n).selectExpr("concat('/c/x/', id, '.wav') AS path")
    rule = PathRule("/c/d", "/c", ("/c/none", "/c/x", "/c/y"), "direct", "wav")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits = resolve_direct(rule.with_roots(values), files, rule)
        assert {r["_ord"] for r in hits.collect()} == {6}  # the second of five bases, with the extension
        written = shuffled_rows(hits)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert max(written) <= n and sum(written) <= 3 * n + 100  # values, files, hits and the list of folders


def test_plain_text_is_folded_by_code_that_the_jvm_compiles(spark):
    import re

    found = resolve_values(
        spark.createDataFrame([("A",)], "_value string"),
        manifest_of(spark.createDataFrame([("/c/x/a.wav",)], "path string"), "/c"), PathRule("/c", "/c", ("/c",), "exact", "wav"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        text = found.select("*")._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(s) for s in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000  # beyond that the JVM only interprets a method


def test_collapse_equals_walking(spark):
    cases = ["/a/../b", "/a/b/../../c", "/a/b/c/../../../d", "/../a", "/a/..", "/a/../..", "/a//../b", "/a/..b/c", "/a/.../b", "a/../b", "/a/b/../c/../d/../e",
             "/..", "/a/../../b/../../c/./..", "s3://k/x/../y", "/a/x..", "../x/../y"]
    def walk(path):
        kept = []
        for part in path.split("/"):
            kept = kept[: max(len(kept) - 1, 1)] if part == ".." else [*kept, part]
        return "/".join(kept)
    df = spark.createDataFrame([(c,) for c in cases], "path string")
    assert {r[0]: r[1] for r in df.select("path", P.collapse(F.col("path"))).collect()} == {c: walk(c) for c in cases}
