"""Reading delimited records whose quoted fields may hold line breaks.

Spark's own reader does all parsing, at every file size alike: a file, or each shard of an index, is one
task, as only a reader that starts at its beginning knows which line breaks are quoted. Where the spec
says ``single_line`` no field holds a line break and files are split.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, types as T

from corpusframe.spec import LoadSpec, SpecError


def read_quoted(
    spark: SparkSession, path: str, schema: T.StructType, options: dict, spec: LoadSpec
) -> DataFrame:
    if re.search(r"[*?{}\[\]]", path):
        raise SpecError(f"index path '{path}' holds glob characters, which Spark would expand")
    if path.rsplit("/", 1)[-1].startswith(("_", ".")):
        raise SpecError(f"index '{path}' begins with '_' or '.'; Spark's readers pass over such files, so it must be renamed")
    whole_records = not spec.extra.get("single_line")
    return spark.read.schema(schema).options(**options).option("multiLine", whole_records).csv(path)
