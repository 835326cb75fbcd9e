"""Landing bookkeeping: resume states, checksums, load-once ledgers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from corpusframe.functions.text import decode, strip
from corpusframe.sources.commits import VERSION, CommitLog
from corpusframe.sources.files import file_digests, read_contents
from corpusframe.sources.scratch import written

PART, CHECKSUM = ".part", ".checksum"


def landed_state(manifest: DataFrame) -> DataFrame:
    """One row per landed name: whether the final, part and checksum file exist, and its text.

    The side files of a name sit next to it as ``<name>.part`` and ``<name>.checksum``.
    """
    base = F.regexp_replace("path", r"\.(part|checksum)$", "")
    kind = F.regexp_extract("path", r"\.(part|checksum)$", 1)
    seen = manifest.select(base.alias("name"), kind.alias("kind"))
    states = seen.groupBy("name").agg(
        F.max(F.col("kind") == "").alias("final_exists"),
        F.max(F.col("kind") == "part").alias("part_exists"),
        F.max(F.col("kind") == "checksum").alias("checksum_exists"),
    )
    noted = read_contents(manifest.filter(F.col("path").endswith(CHECKSUM))).select(
        F.regexp_replace("path", r"\.checksum$", "").alias("name"),
        strip(decode(F.col("content"), "utf-8")).alias("stored"),
    )
    # texts are more than Spark guesses, so they are never broadcast
    return states.join(noted.hint("merge"), "name", "left")


def resume_state() -> Column:
    """State of a landing from expected checksum, side files and stored checksum."""
    part, noted = F.col("part_exists"), F.col("checksum_exists")
    tracked = part & noted & (F.coalesce("stored", F.lit("")) != "")
    return (
        F.when(F.col("final_exists"), F.lit("complete"))
        .when(tracked & F.col("stored").eqNullSafe(F.col("checksum")), F.lit("resume"))
        .when(tracked, F.lit("stale"))
        .when(part & ~noted, F.lit("untracked"))
        .when(noted & ~part, F.lit("orphan"))
        .otherwise(F.lit("fresh"))
    )


def reconcile_landing(expected: DataFrame, landed: DataFrame) -> DataFrame:
    """Expected (name, checksum, size) against landed states; full outer, one row per name."""
    flags = {c: F.coalesce(F.col(c), F.lit(False)) for c in ("final_exists", "part_exists", "checksum_exists")}
    both = expected.withColumn("_wanted", F.lit(True)).join(landed, "name", "full").withColumns(flags)
    state = F.when(F.col("_wanted").isNull(), F.lit("unexpected")).otherwise(resume_state())
    out = both.select("name", "checksum", "size", "stored", state.alias("state"))
    return out.withColumn("cleanup", F.col("state").isin("stale", "untracked", "orphan"))


def checksum_manifest(files: DataFrame, expected: DataFrame) -> DataFrame:
    """Digest every file and compare with expected (path, checksum)."""
    both = expected.select("path", "checksum").join(file_digests(files), "path", "full")
    status = (
        F.when(F.col("sha256").isNull(), F.lit("missing"))
        .when(F.col("checksum").isNull(), F.lit("unexpected"))
        .when(F.col("checksum") == F.col("sha256"), F.lit("match"))
        .otherwise(F.lit("mismatch"))
    )
    return both.select("path", "bytes_read", "sha256", status.alias("status"))


def changed_since(current: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of ``current`` (path, checksum, ..) to load: not in the ledger with that checksum.

    An absent or empty checksum proves nothing, so such a file is always loaded.
    """
    proven = ledger.select("path", "checksum").filter(F.col("checksum") != "").distinct()
    return current.join(proven, ["path", "checksum"], "left_anti")


def record_loaded(loaded: DataFrame, ledger_path: str) -> None:
    """Append what was loaded; call it after the load's own output is written."""
    loaded.select("path", "checksum").write.mode("append").parquet(ledger_path)


def load_changed(log: CommitLog, current: DataFrame, load: Callable[[DataFrame], DataFrame]) -> int | None:
    """Load the rows of ``current`` (path, checksum, ..) that no commit has with that checksum.

    Output and ledger are one commit, so a load that dies leaves neither, and the next one starts as if it
    had not been. The number of the commit, or None where there was nothing to load. Read the output of
    all loads with ``loaded_output``.
    """
    ledger = log.read("ledger")
    wanted = written(current if ledger is None else changed_since(current, ledger), "wanted")
    if wanted.isEmpty():
        return None
    return log.commit(output=load(wanted), ledger=wanted.select("path", "checksum"))


def loaded_output(log: CommitLog, key: str = "path") -> DataFrame | None:
    """Rows of every file's newest load; rows that an older load of the file gave are passed over."""
    rows, ledger = log.read("output"), log.read("ledger")
    if rows is None:
        return None
    newest = ledger.groupBy(F.col("path").alias("_file")).agg(F.max(VERSION).alias("_newest"))
    same = [F.col(key) == F.col("_file"), F.col(VERSION) == F.col("_newest")]
    return rows.join(newest, same, "left_semi").drop(VERSION)


def compact_ledger(log: CommitLog) -> None:
    """Fold the ledger into one row for each file; what was loaded stays known."""
    newest = F.max_by(F.struct("checksum", F.col(VERSION).alias("v")), VERSION).alias("l")
    log.compact("ledger", lambda rows: rows.groupBy("path").agg(newest).select("path", "l.checksum", F.col("l.v").alias(VERSION)))
