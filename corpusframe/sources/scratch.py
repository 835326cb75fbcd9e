"""Shared scratch space for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from corpusframe.functions.paths import clean_root

SETTING = "spark.checkpoint.dir"


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="corpusframe-")


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster names; only a local session may use one of its own."""
    shared = spark.conf.get(SETTING, None)
    if shared:
        return clean_root(shared)
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    return _local_folder(spark.conf.get("spark.app.id"))


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage by writing a table to the shared scratch folder and reading it back."""
    target = fresh_folder(df.sparkSession, label)
    df.write.parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)
