"""Compare registered queries with their SQL on DuckDB.

Run as a script with query names (all without names): python tests/oracle.py [name ..]
"""

import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(frame):
    import pandas as pd

    frame = frame[sorted(frame.columns)]
    out = []
    for row in frame.itertuples(index=False):
        cells = []
        for value in row:
            if value is None or (not isinstance(value, (list, dict)) and pd.isna(value)):
                cells.append("∅")
            elif isinstance(value, float):
                cells.append(f"{value:.9g}")
            else:
                cells.append(str(value))
        out.append(tuple(cells))
    return sorted(out)


def compare(spark, con, name, query, sql, sf_dir):
    """None when equal, else a short account of the difference."""
    mine = query(spark, sf_dir).toPandas()
    theirs = con.execute(sql).df()
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} != {sorted(theirs.columns)}"
    a, b = canonical(mine), canonical(theirs)
    if a == b:
        return None if a else "no rows on either side"
    left, right = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
    return f"{len(a)} rows != {len(b)} rows\n  only here: {left}\n  only SQL:  {right}"


def main(names):
    import tempfile

    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = duck(sf_dir)
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, query, oracles[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)


if __name__ == "__main__":
    main(set(sys.argv[1:]))
