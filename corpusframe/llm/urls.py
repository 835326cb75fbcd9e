"""URL filters: rules on hosts and paths, and logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, functions as F

from corpusframe.functions.text import bind
from corpusframe.llm.registry import register, table
from corpusframe.sources.scratch import written

RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
GRAMS = (2, 3, 4)
BUCKETS = 1 << 13
TRAIN_URLS = 1_000  # labelled urls of each verdict, the first by hash
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for urls without ``://``."""
    value = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(value, "://")
    rest = F.when(at > 0, F.substring(value, at + 3, F.length(value))).otherwise("")
    host, path = (F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", i) for i in (1, 2))
    return F.translate(host, _UPPER, _LOWER), path


def with_rule(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """``pages`` with ``rule`` (host and path of the longest rule that fits, else null) and ``rule_verdict``.

    Expects ``host`` and ``path``. A rule fits its host and all subdomains if the path starts with its own.
    Of equally long rules the last by code point wins. The rules are a parameter, one condition each.
    """
    fits = [
        F.when(
            ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(F.col("path"), F.lit(path)),
            F.struct(F.lit(len(host + path)).alias("size"), F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for host, path, verdict in rules
    ]
    best = F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    return pages.withColumn("_best", best).withColumn("rule", F.col("_best.rule")).withColumn("rule_verdict", F.col("_best.verdict")).drop("_best")


def _grams(text: Column, mark: str) -> Column:
    """Character n-grams of a text between two line feeds, each marked with where it comes from."""
    def of(chars, n):
        last = F.size(chars) - n
        each = lambda i: F.concat(F.lit(mark), *[F.get(chars, i + k) for k in range(n)])
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), each)).otherwise(F.array().cast("array<string>"))

    return bind(F.split(F.concat(F.lit("\n"), text, F.lit("\n")), ""), lambda chars: F.concat(*[of(chars, n) for n in GRAMS]))


def _hashed(pages: DataFrame) -> DataFrame:
    grams = F.concat(_grams(F.col("host"), "h"), _grams(F.col("path"), "p"))
    return HashingTF(numFeatures=BUCKETS, binary=True, inputCol="_grams", outputCol="_vector").transform(pages.withColumn("_grams", grams))


def train(labelled: DataFrame, limit: int = TRAIN_URLS):
    """Fit on at most ``limit`` distinct urls of each verdict (column ``verdict``: allow or block).

    A url labelled both ways counts as block. Without labels of both kinds there is no model (None).
    """
    host, path = host_and_path("url")
    known = labelled.filter("verdict in ('allow', 'block') and url is not null").groupBy("url").agg(F.max("verdict").alias("verdict"))
    parts = [known.filter(F.col("verdict") == v).orderBy(F.xxhash64("url"), "url").limit(limit) for v in ("allow", "block")]
    sample = written(parts[0].union(parts[1]), "labelled-urls")
    if sample.agg(F.count_distinct("verdict")).first()[0] < 2:
        return None
    shaped = sample.withColumn("host", host).withColumn("path", path).withColumn("_label", (F.col("verdict") == "block").cast("double"))
    ordered = _hashed(shaped).select("_vector", "_label").coalesce(1)  # at most 2 x limit rows, in one order for equal sums
    return LogisticRegression(featuresCol="_vector", labelCol="_label", regParam=0.01, maxIter=60).fit(ordered)


def judge(pages: DataFrame, model, url: str = "url", rules: tuple = RULES, default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict: the rule's where one fits, else the model's.

    Columns of these names are replaced. Null and malformed urls have empty parts and no rule. Without a
    model the verdict is ``default``. Urls are read whole, and repeated rows are judged alike.
    """
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = host_and_path(url)
    parts = pages.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(kept)], host.alias("host"), path.alias("path"))
    ruled = with_rule(parts, rules)
    if model is None:
        scored = ruled.withColumn("_said", F.lit(0.0))
    else:
        model = model.copy().setPredictionCol("_said").setProbabilityCol("").setRawPredictionCol("")
        scored = model.transform(_hashed(ruled))
    learned = F.when(F.col("_said") == 1.0, "block").otherwise("allow") if model is not None else F.lit(default)
    return scored.select(
        *[F.col(f"_{i}").alias(c) for i, c in enumerate(kept)], "host", "path", "rule", F.coalesce("rule_verdict", learned).alias("verdict")
    )


def labelled_by_rules(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """(url, verdict) of the urls that a rule decides."""
    host, path = host_and_path("url")
    return with_rule(pages.select("url", host.alias("host"), path.alias("path")), rules).filter("rule is not null").select("url", F.col("rule_verdict").alias("verdict"))


@register("op5_url_logistic")
def op5_url_logistic(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, train(labelled_by_rules(pages))).select("page_id", "host", "path", "rule", "verdict")
