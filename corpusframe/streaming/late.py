"""Index rows whose media land later: rows wait, stored by batch, until the file of their path comes or time is up."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusframe.streaming.ingest import BATCH

PATH, AT, IS_FILE, FOUND = "_path", "_at", "_is_file", "_found"


@dataclass(frozen=True)
class Awaited:
    """Rows and landed files as one stream, and how long a row waits; ``write_told`` runs it."""

    both: DataFrame
    fields: list[str]
    path: str
    at: str
    patience: timedelta
    lateness: str

    def clock(self, batch: DataFrame, before: int | None) -> int | None:
        """Event time in microseconds, behind the latest time seen by ``lateness``; it never goes back."""
        latest = F.max(F.unix_micros(F.col(AT) - F.expr(f"interval '{self.lateness}'")))
        seen = batch.agg(latest).first()[0]
        return max((t for t in (seen, before) if t is not None), default=None)

    def judged(self, waiting: DataFrame, landed: DataFrame, clock: int | None) -> DataFrame:
        """``waiting`` with ``_found``: true, false, or null where the row has to wait on."""
        there = landed.select(F.col("path").alias(PATH), F.lit(True).alias("_there")).distinct()
        both = waiting.join(there, F.col(self.path) == F.col(PATH), "left")
        due = F.unix_micros(F.col(self.at).cast("timestamp")) + self.patience // timedelta(microseconds=1)
        unplaced = F.col(self.path).isNull() | F.col(self.at).isNull()
        found = F.when(unplaced, False).when(F.col("_there"), True).when(due <= F.lit(clock).cast("long"), False)
        return both.select(*self.fields, found.alias(FOUND))


def await_media(rows: DataFrame, files: DataFrame, path: str, at: str, patience: timedelta, lateness: str = "0 seconds") -> Awaited:
    """``rows`` once each with ``_found``: true when the file of column ``path`` has landed, before or after the row,
    false when event time has passed the row's own time by ``patience`` without it.

    Both are streams; ``at`` is the event time of a row, and of a file in ``files`` (path, at). Rows that come with an
    equal path and time are told one by one. A row without a path or time is told at once as not found, a row that
    comes after its time is up too, unless its file is there. A file that lands when its row was given up counts
    for later rows. Landed paths stay known, as in a manifest; waiting rows stay until told. Times are compared
    in the session's zone.
    """
    mine = rows.select("*", F.col(path).alias(PATH), F.when(F.col(path).isNotNull(), F.col(at).cast("timestamp")).alias(AT), F.lit(False).alias(IS_FILE))
    theirs = files.filter("path is not null and at is not null").select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema], F.col("path").alias(PATH), F.col("at").cast("timestamp").alias(AT), F.lit(True).alias(IS_FILE)
    )
    return Awaited(mine.union(theirs), rows.columns, path, at, patience, lateness)


def write_told(awaited: Awaited, target: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write told rows as Parquet, each once over restarts with the same checkpoint.

    Every micro-batch is one join of the new and the waiting rows with all landed paths. It overwrites its own
    ``batch_id`` folders, in ``target`` and below the checkpoint, so a batch that is retried replaces what it left.
    """
    schemas = {"rows": awaited.both.select(*awaited.fields, F.lit(True).alias(FOUND)).schema, "landed": "path string", "clock": "at long"}

    def place(kind: str, batch_id: int) -> str:
        return f"{checkpoint}/late/{kind}/{BATCH}={batch_id}"

    def stored(batch: DataFrame, kind: str, *batch_ids: int) -> DataFrame:
        return batch.sparkSession.read.schema(schemas[kind]).parquet(*[place(kind, n) for n in batch_ids])

    def take(batch: DataFrame, batch_id: int) -> None:
        def store(df: DataFrame, kind: str) -> None:
            df.write.mode("overwrite").parquet(place(kind, batch_id))

        before = stored(batch, "clock", batch_id - 1).first() if batch_id else None
        clock = awaited.clock(batch, before and before["at"])
        store(batch.sparkSession.range(1).select(F.lit(clock).cast("long").alias("at")), "clock")
        store(batch.filter(IS_FILE).select(F.col(PATH).alias("path")).distinct(), "landed")
        waiting = batch.filter(~F.col(IS_FILE)).select(*awaited.fields)
        if batch_id:
            waiting = waiting.union(stored(batch, "rows", batch_id - 1).filter(F.col(FOUND).isNull()).select(*awaited.fields))
        store(awaited.judged(waiting, stored(batch, "landed", *range(batch_id + 1)), clock), "rows")
        told = stored(batch, "rows", batch_id).filter(F.col(FOUND).isNotNull())
        told.write.mode("overwrite").parquet(f"{target}/{BATCH}={batch_id}")

    stream = awaited.both.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return stream.trigger(**(trigger or {"availableNow": True})).start()
