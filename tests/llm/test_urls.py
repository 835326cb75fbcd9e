import re

import numpy as np
from pyspark.sql import functions as F

from corpusframe.llm import urls

SF = "/root/testdata/sf0.01"
EDGES = [
    None, "", "no scheme", "http://", "http://A.Example.NET/en/x?y#z", "http://example.net", "http://example.net/en", "https://net/", "x://fr.ORG/fr/a",
    "http://example.com/de/?q=/fr/", "http://badexample.com/de/", "http://a.example.com#/de/", "a://b://c/d", "http://ÄB.org/fr/é", "http://x.org/" + "a" * 200_000, "://.net/",
    "http://org/fr/", "http://a\nb.net/c\nd",
]


def slow(url):
    host = path = ""
    if url is not None and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fit = [(len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fit, default=(0, None, None))[1:])


def test_parts_and_rules(spark):
    given = [r.url for r in spark.read.parquet(f"{SF}/pages.parquet").select("url").collect()] + EDGES
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(given)], "page_id long, url string").selectExpr("*", "1 as host", "2 as _vector", "3 as features", "4 as _0")
    found = urls.judge(pages, urls.train(urls.labelled_by_rules(pages)))
    assert set(found.columns) == {"page_id", "url", "host", "path", "rule", "verdict", "_vector", "features", "_0"}
    got = {r.page_id: r for r in found.collect()}
    assert len(got) == len(given)
    for i, u in enumerate(given):
        host, path, rule, verdict = slow(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")


def test_held_out_accuracy(spark):
    """The model alone tells the rules' verdicts on urls it has not seen."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url")
    labelled = urls.labelled_by_rules(pages).distinct()
    model = urls.train(labelled.filter(F.crc32(F.col("url").cast("binary")) % 3 != 0), 500)
    unseen = labelled.filter(F.crc32(F.col("url").cast("binary")) % 3 == 0).withColumnRenamed("verdict", "want")
    rows = urls.judge(unseen, model, rules=()).collect()
    assert len(rows) > 200 and np.mean([r.want == r.verdict for r in rows]) > 0.95


def test_without_labels(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c"), (1, "http://a.b/c"), (None, None)], "page_id long, url string")
    assert urls.train(urls.labelled_by_rules(pages)) is None
    assert [r.verdict for r in urls.judge(pages, None).collect()] == ["allow"] * 3
    assert urls.judge(pages.limit(0), None).count() == 0
