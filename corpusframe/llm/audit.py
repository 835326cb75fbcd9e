"""How filters interact: what each removes in every order, from a Gray-code walk over all subsets of them.

Documents are counted by the set of filters they fail, which is all that any order depends on. The walk
toggles one filter at a time; every cell, a set of failed filters, keeps the number of active filters that
it fails, and the survivors change by the cells whose number leaves or reaches zero. The survivors of all
subsets are stored, and a step of an order is the difference of two of them.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusframe.llm.registry import register, table
from corpusframe.sources.scratch import written

LAST = (1 << 63) - 1  # stands for a null id: later than every other
_SPACE = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_failures(text: Column) -> list[Column]:
    """Short, repetitive, shouted or symbol-laden texts: the four conditions that need no other document."""
    words = F.array_remove(F.split(text, _SPACE), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.length(text) - F.length(F.translate(text, _UPPER, ""))
    return [n < 200, 100 * distinct < 50 * n, 100 * upper > 2 * F.length(text), text.rlike("[#$%&*|]")]


def failures(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, mask, good, toxic) per row: bit k of ``mask`` is set where filter k fails.

    The fifth filter fails texts that a row of smaller id has, null ids last; the text of a group's first
    row is met through its id, so groups of copies are no hot keys. Of several labels of one id any 1 counts.
    """
    own = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(own.cast("binary"), 256)).alias("same"),
        sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(text_failures(own))), F.lit(0)).alias("mask"),
    )
    slim = written(slim, "failures")
    first = slim.groupBy("same").agg(F.min("id").alias("first")).select(F.col("first").alias("id"), "same", F.lit(True).alias("is_first"))
    marks = labels.select(F.col("doc_id").cast("long").alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    marks = marks.filter("id is not null").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    found = slim.join(first, ["id", "same"], "left").join(marks, "id", "left")
    later = F.when(F.col("is_first").isNull(), 16).otherwise(0)
    return found.select("part", (F.col("mask") + later).alias("mask"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def walk(cells: np.ndarray) -> np.ndarray:
    """Survivors of every subset of filters, from the counts of every set of failed filters (last axis of both)."""
    size = cells.shape[-1]
    masks = np.arange(size)
    failing = np.zeros(size, np.int64)  # active filters that each cell fails
    survivors = np.empty_like(cells)
    subset, alive = 0, cells.sum(axis=-1)
    survivors[..., 0] = alive
    for step in range(1, size):
        toggled = step & -step
        subset ^= toggled
        hit = (masks & toggled) > 0
        if subset & toggled:
            alive = alive - cells[..., hit & (failing == 0)].sum(axis=-1)
            failing[hit] += 1
        else:
            failing[hit] -= 1
            alive = alive + cells[..., hit & (failing == 0)].sum(axis=-1)
        survivors[..., subset] = alive
    return survivors


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def _steps(names: str):
    """Rows of (order, step) as numpy arrays, and a function that makes the counts of a batch of parts."""
    n = len(names)
    orders = list(permutations(range(n)))
    before = np.array([[sum(1 << f for f in order[:k]) for k in range(n)] for order in orders])
    which = np.array(orders)
    bit = 1 << which
    masks = np.arange(1 << n)
    fails = np.array([[(m >> f) & 1 for m in masks] for f in range(n)], np.int64)

    def counts(cells: np.ndarray) -> dict[str, np.ndarray]:
        """``cells``: parts x (documents, good, toxic) x masks."""
        stored = walk(cells)
        kept = stored[:, 0][:, before | bit]
        lost = stored[..., before] - stored[..., before | bit]
        failing = cells[:, 0] @ fails.T
        shapley = np.zeros((len(cells), n), np.int64)
        for f in range(n):
            for m in masks[(masks >> f) & 1 == 0].tolist():
                k = m.bit_count()
                shapley[:, f] += factorial(k) * factorial(n - 1 - k) * (stored[:, 0, m] - stored[:, 0, m | 1 << f])
        alone = cells[:, 0][:, 1 << np.arange(n)]
        values = [kept, lost[:, 0], failing[:, which] - lost[:, 0], alone[:, which], lost[:, 1], lost[:, 2], shapley[:, which]]
        return dict(zip(COUNTS, values))

    labels = ["".join(names[f] for f in order) for order in orders]
    return labels, counts


def audit(masks: DataFrame, names: str = "ABCDE") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    ``masks`` has rows (part, mask, good, toxic). One row for each part, order of the filters and step.
    A part is aggregated to one count for each mask before the walk, so its rows never meet; parts are walked
    in parallel. Repeated rows count as often as they come; an empty table has no parts and so no rows.
    """
    n = len(names)
    cells = masks.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("g"), F.count_if("toxic").alias("t"))
    by_part = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "g", "t")).alias("cells"))
    labels, counts = _steps(names)
    order = pa.array(np.repeat(labels, n).tolist())

    def act(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 100):
                some = batch.slice(low, 100)
                table_ = np.zeros((some.num_rows, 3, 1 << n), np.int64)
                for i, own in enumerate(some.column(1).to_pylist()):
                    for c in own:
                        table_[i, :, c["mask"]] = c["n"], c["g"], c["t"]
                found = counts(table_)
                rows = len(labels) * n
                steps = np.tile(np.arange(1, n + 1, dtype=np.int32), some.num_rows * len(labels))
                part = some.column(0).take(pa.array(np.repeat(np.arange(some.num_rows), rows)))
                yield pa.RecordBatch.from_arrays(
                    [part, pa.concat_arrays([order] * some.num_rows), pa.array(steps), *[pa.array(found[c].reshape(-1)) for c in COUNTS]], names=["part", "filter_order", "step", *COUNTS]
                )

    return by_part.mapInArrow(act, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))


SQL = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
f AS (SELECT *, len(words) AS n, list_unique(words) AS u, length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS c, min(doc_id) OVER (PARTITION BY text) AS first FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, CASE WHEN n < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * u < 50 * n THEN 2 ELSE 0 END
  + CASE WHEN 100 * c > 2 * length(text) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
  + CASE WHEN coalesce(doc_id > first, first IS NOT NULL) THEN 16 ELSE 0 END AS mask FROM f LEFT JOIN l USING (doc_id)),
h AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS t FROM m GROUP BY part, mask),
s AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(name, bit)),
o AS (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM s a, s b, s c, s d, s e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
k AS (SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0) AS before FROM o, range(1, 6) r(step)),
r AS (SELECT part, filter_order, step, any_value(bit) AS bit, sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed, sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN g ELSE 0 END) AS good_lost,
  sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN t ELSE 0 END) AS toxic_lost
  FROM h, (SELECT filter_order, step, bit, CAST(before AS BIGINT) AS before FROM k) GROUP BY part, filter_order, step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r
"""


@register("op12_gray_audit", SQL)
def op12_gray_audit(spark, sf_dir):
    return audit(failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))
