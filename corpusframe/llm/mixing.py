"""Mixing sources to target weights with pivotal dependent rounding.

Each document of a source should be taken target / source size times. The whole part of that number
is certain; the fraction is settled by pairs: two open documents pass words between them, in a random
direction that keeps both expectations, until one of them is taken or left for good. Chunks of a
source settle their documents in parallel and hand on the one that stays open, chunk by chunk in a
tree, so the words of a source are off its target by less than one last document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusframe.llm.columns import apart
from corpusframe.llm.registry import register, table
from corpusframe.llm.tokens import NOT_SPACE, chunked, mix
from corpusframe.sources.scratch import written

CHUNK = 10_000  # documents settled by one task
FAN_IN = 1_000  # open documents that meet in one task of the tree
CYCLE = (5.0, 2.0, 1.0)
LIMIT = 3.0


def sizes(docs: DataFrame, text: str = "text", out: str = "size") -> DataFrame:
    """``docs`` with the number of words instead of column ``text``; null has none."""
    place, rest = docs.columns.index(text), [f for f in docs.schema if f.name != text]

    def count(batches):
        for batch in batches:
            found = [np.diff(words.first) for _, _, words in chunked(batch.column(place), NOT_SPACE)]
            n = pa.array(np.concatenate(found) if found else np.zeros(0, np.int64), pa.int64())
            others = [batch.column(i) for i in range(batch.num_columns) if i != place]
            yield pa.RecordBatch.from_arrays([*others, n], names=[*(f.name for f in rest), out])

    return docs.mapInArrow(count, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), f"`{out}` bigint"]))


def numbered(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, counting from 0 by code point, null last; ranges are sorted in parallel."""
    ordered = sources.repartitionByRange(F.col("source").isNull(), "source").sortWithinPartitions(F.col("source").isNull(), "source")
    ordered = written(ordered.withColumn("part", F.spark_partition_id()), "sources")
    counts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition of the sort
    before = counts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inner = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").isNull(), "source"))
    return ordered.withColumn("inner", inner).join(before, "part").withColumn("place", F.col("before") + F.col("inner") - 1).drop("part", "inner", "before")


def targets(sources: DataFrame, weight: Column, limit: float = LIMIT) -> DataFrame:
    """(source, source_size, target): all sizes shared by weight, no target above ``limit`` times its source.

    What is above is shared again among the others, by weight, until none is above. Each round sends
    two sums to the driver.
    """
    table_ = written(sources.withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size") * F.lit(limit)), "targets")
    total = float(table_.agg(F.sum("source_size")).first()[0] or 0)
    rate, capped = 0.0, -1
    while True:
        full = F.col("cap") <= F.lit(rate) * F.col("weight") if capped >= 0 else F.lit(False)
        n, taken, weights = table_.agg(F.count_if(full), F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight")))).first()
        if n == capped or not weights:
            break
        capped, rate = n, (total - (taken or 0.0)) / weights
    return table_.select("source", "source_size", F.least(F.col("cap"), F.lit(rate) * F.col("weight")).alias("target"))


def settle(ids: np.ndarray, size: np.ndarray, part: np.ndarray, salt: int) -> np.ndarray:
    """Pivotal rounding of the fractions ``part``: all but at most one come back as 0 or 1.

    Documents meet from the longest to the shortest, so the one left open tends to be short. Words are
    what is passed, so the sum of size times part is kept. The draws depend on ids and places only.
    """
    part = part.copy()
    open_ = np.flatnonzero((part > 0) & (part < 1) & (size > 0))
    open_ = open_[np.lexsort((ids[open_], -size[open_]))]
    draws = mix(ids[open_].astype(np.int64).view(np.uint64) ^ mix(np.arange(len(open_), dtype=np.uint64) + np.uint64(salt << 32))) >> np.uint64(11)
    draws = (draws / float(1 << 53)).tolist()
    share, words = part.tolist(), size.tolist()
    held = -1
    for nth, i in enumerate(open_.tolist()):
        if held < 0:
            held = i
            continue
        a, b = share[held] * words[held], share[i] * words[i]
        to_i = min(a, words[i] - b)  # most words that can go from the held one to i, and back
        to_held = min(b, words[held] - a)
        if draws[nth] * (to_i + to_held) < to_held:
            a, b, exact = a - to_i, b + to_i, a <= words[i] - b
            first = (0.0 if exact else a / words[held]), (1.0 if not exact else b / words[i])
        else:
            exact = b <= words[held] - a
            a, b = a + to_held, b - to_held
            first = (a / words[held] if exact else 1.0), (0.0 if exact else b / words[i])
        share[held], share[i] = (min(1.0, max(0.0, x)) for x in first)
        if share[held] in (0.0, 1.0):
            held = i if 0.0 < share[i] < 1.0 else -1
    return np.array(share)


_ROWS = "_row long, source string, chunk long, size long, part double"


def _settled(salt: int):
    def act(group: pa.Table) -> pa.Table:
        ids, size, part = (group[c].to_numpy() for c in ("_row", "size", "part"))
        return group.set_column(group.schema.get_field_index("part"), "part", pa.array(settle(ids, size, part, salt), pa.float64()))

    return act


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", cycle: tuple = CYCLE, limit: float = LIMIT, seed: int = 7) -> DataFrame:
    """Per document: doc_id, _key (hash of the text), size, source, source_size, target, copies, taken.

    Sources in code point order, null last, weigh as ``cycle`` repeats. A document is taken ``copies``
    times, never above ``limit``; ``taken`` counts words. Empty texts take no words and one copy of each
    whole time their source is taken. Sources without words have target 0. Draws come from ids and
    texts, so reruns and other partitionings agree; repeated rows are settled one by one. An empty
    table gives no rows.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), F.xxhash64(F.col(text)).alias("_key"), F.col(text).alias("text"))
    rows = written(sizes(slim).withColumn("_row", F.xxhash64("doc_id", "_key")), "sizes")
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    place = numbered(per)
    weights = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (F.pmod("place", F.lit(len(cycle))) + 1).cast("int"))
    shares = targets(place.select("source", "source_size", "n", weights.alias("w")), F.col("w"), limit)
    chunks = written(shares.join(per.select(F.col("source").alias("s"), "n"), F.col("s").eqNullSafe(F.col("source"))).drop("s").withColumn("chunks", F.ceil(F.col("n") / CHUNK)), "chunks")
    known = chunks.select(F.col("source").alias("s"), "source_size", "target", "chunks")
    told = rows.join(known, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    told = told.withColumn("base", F.floor(times)).withColumn("part", times - F.floor(times)).withColumn("chunk", F.pmod(F.xxhash64("_row", F.lit(seed)), "chunks"))
    fields = [*told.columns]
    ordered = {f.name: f.dataType.simpleString() for f in told.schema}
    schema = ", ".join(f"`{c}` {ordered[c]}" for c in fields)
    at = written(told.groupBy("source", "chunk").applyInArrow(_settled(seed), schema), "settled-0")
    most = chunks.agg(F.max("chunks")).first()[0] or 1
    is_open = (F.col("part") > 0) & (F.col("part") < 1) & (F.col("size") > 0)
    done = at.filter(~is_open)
    level = 1
    while most > 1:
        rest = at.filter(is_open).withColumn("chunk", F.floor(F.col("chunk") / FAN_IN))
        at = written(rest.groupBy("source", "chunk").applyInArrow(_settled(seed + level), schema), f"settled-{level}")
        done, most, level = done.union(at.filter(~is_open)), -(-most // FAN_IN), level + 1
    chance = F.pmod(F.xxhash64("_row", F.lit(seed + 1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    last = at.filter(is_open).withColumn("part", F.when(chance < F.col("part"), 1.0).otherwise(0.0))
    copies = (F.col("base") + F.when((F.col("size") > 0) & (F.col("part") >= 1), 1).otherwise(0)).cast("long")
    return done.union(last).select("doc_id", "_key", "size", "source", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` that the mix takes, with the column ``copies`` behind their own columns (``mix_copies`` where they have one of that name, and so on).

    Repeated rows, of one id, text and source, become one row with all their copies.
    """
    out = "copies"
    while out in docs.columns:
        out = f"mix_{out}"
    docs, name = apart(docs)
    doc_id, text, source = name[doc_id], name[text], name[options.pop("source", "source")]
    found = mix_sources(docs, doc_id, text, source, **options).filter("copies > 0")
    per = found.groupBy(F.col("doc_id").alias("_mix_id"), F.col("_key").alias("_mix_key"), F.col("source").alias("_mix_source")).agg(F.sum("copies").alias("_copies"))
    same = [docs[doc_id].eqNullSafe(per["_mix_id"]), F.xxhash64(docs[text]) == per["_mix_key"], docs[source].eqNullSafe(per["_mix_source"])]
    taken = docs.join(per, same).dropDuplicates(["_mix_id", "_mix_key", "_mix_source"])
    return taken.select(*[docs[n].alias(c) for c, n in name.items()], F.col("_copies").alias(out))


@register("op2_pivotal_mixing")
def op2_pivotal_mixing(spark, sf_dir):
    found = mix_sources(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source")
