"""Registered queries of this subpackage and the SQL that gives the same rows."""

from corpusframe.checks.registry import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(name, sql=None):
    def keep(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return keep
