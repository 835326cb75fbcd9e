"""SimHash near-duplicates: fingerprints, then a self-join of binary tries within a Hamming budget."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from corpusframe.llm.components import components
from corpusframe.llm.columns import apart
from corpusframe.llm.registry import register, table
from corpusframe.llm.tokens import LOWER
from corpusframe.sources.scratch import written

BITS = 64
RUN = 256  # fingerprints that share their leading bits, expected at most
SLICE = 50_000  # rows of one task
HOT = 200_000  # a run above this is split into pairs of parts
PART = 100_000
FRONTIER = 200_000  # node pairs expanded at a time
LEAF = 16  # node pairs of so few combinations are compared at once


def fingerprint(text: bytes, words: int) -> int:
    """Majority bits over XXH64 (seed 42) of all word shingles; a text without words has 0."""
    found = text.split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) + np.arange(len(found))
    begins = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(found) - words + 1)
    last = ends[-n:]
    hashed = xxhash.xxh64_intdigest
    total = np.zeros(BITS, np.int64)
    begins, last = begins.tolist(), last.tolist()
    for low in range(0, n, 65_536):
        part = [hashed(joined[b:e], 42) for b, e in zip(begins[low : min(n, low + 65_536)], last[low : low + 65_536])]
        total += np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = 4, out: str = "_fp") -> DataFrame:
    """``docs`` with its fingerprint as a long in column ``out``; texts are lower-cased (A-Z) and read whole."""
    fields = docs.schema
    place = fields.names.index(text)

    def add(batches):
        lower = LOWER.tobytes()
        for batch in batches:
            texts = batch.column(place)
            found = [fingerprint((t.as_buffer().to_pybytes() if t.is_valid else b"").translate(lower), words) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns)), pa.array(np.array(found, np.uint64).view(np.int64))],
                names=[*batch.schema.names, out],
            )

    return docs.mapInArrow(add, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"`{out}` bigint"]))


def _layouts(count: int, budget: int) -> list[list[tuple[int, int]]]:
    """Bit fields (shift, width), leading ones first, of each trie; two fingerprints within the budget
    agree on all leading fields of at least one trie, as the differing bits touch at most `budget` fields."""
    lead = 1
    while lead < 4 and count / 2 ** (BITS * lead / (budget + lead)) > RUN:
        lead += 1
    cuts = [round(BITS * i / (budget + lead)) for i in range(budget + lead + 1)]
    fields = [(a, b - a) for a, b in zip(cuts, cuts[1:])]
    return [[*first, *(f for f in fields if f not in first)] + [(lead, 0)] for first in combinations(fields, lead)]


def _leading(layout: list[tuple[int, int]]):
    lead = layout[-1][0]
    key = F.lit(0).cast("long")
    for shift, width in layout[:lead]:
        key = F.shiftleft(key, width).bitwiseOR(F.shiftrightunsigned(F.col("_fp"), shift).bitwiseAND(F.lit((1 << width) - 1)))
    return key


def arranged(values: np.ndarray, layout: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros_like(values)
    for shift, width in layout[:-1]:
        out = (out << np.uint64(width)) | ((values >> np.uint64(shift)) & np.uint64((1 << width) - 1))
    return out


class Forest:
    """Disjoint sets over array positions, joined by whole arrays of links."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def find(self, at: np.ndarray) -> np.ndarray:
        at = self.parent[at]
        while True:
            up = self.parent[at]
            if (up == at).all():
                return at
            at = self.parent[up]

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.find(a), self.find(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def trie_join(values: np.ndarray, bounds: np.ndarray, depth: int, budget: int) -> np.ndarray:
    """For each value the position of the least one it is linked to, within its run.

    ``values`` are sorted in each run bounds[i]:bounds[i + 1], whose members share their first
    ``depth`` bits. A node of the trie is a range of a run. Pairs of nodes go down together; a
    pair carries the bits in which it differs so far, and is left when these exceed the budget.
    Pairs are expanded depth first in blocks, so memory is bounded by the block, not by the pairs.
    """
    forest = Forest(len(values))
    lo, hi = bounds[:-1], bounds[1:]
    start = hi - lo > 1
    lo, hi = lo[start], hi[start]
    stack = [(depth, np.stack([lo, hi, lo, hi, np.zeros_like(lo)]))] if len(lo) else []
    sums: dict[int, np.ndarray] = {}
    while stack:
        level, pairs = stack.pop()
        if pairs.shape[1] > FRONTIER:
            stack.append((level, pairs[:, FRONTIER:]))
            pairs = pairs[:, :FRONTIER]
        a0, a1, b0, b1, off = pairs
        same = a0 == b0
        done = ((a1 - a0) * (b1 - b0) <= LEAF) | (level >= BITS)
        if done.any():
            x0, x1, y0, y1, _ = pairs[:, done]
            wide, sizes = y1 - y0, (x1 - x0) * (y1 - y0)
            for part in np.array_split(np.arange(len(sizes)), max(1, int(sizes.sum()) // 4_000_000)):
                which = np.repeat(part, sizes[part])
                nth = np.arange(len(which)) - np.repeat(np.cumsum(sizes[part]) - sizes[part], sizes[part])
                i, j = x0[which] + nth // wide[which], y0[which] + nth % wide[which]
                near = (i < j) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
                forest.join(i[near], j[near])
        if done.all():
            continue
        a0, a1, b0, b1, off = pairs[:, ~done]
        same = same[~done]
        if level not in sums:
            bit = (values >> np.uint64(BITS - 1 - level)) & np.uint64(1)
            sums[level] = np.concatenate(([0], np.cumsum(bit.astype(np.int64))))
        ones = sums[level]
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        children = np.concatenate(
            [np.stack([a0, am, b0, bm, off]), np.stack([am, a1, bm, b1, off]), np.stack([a0, am, bm, b1, off + 1]), np.stack([am, a1, b0, bm, off + 1])[:, ~same]],
            axis=1,
        )
        a0, a1, b0, b1, off = children
        keep = (a1 > a0) & (b1 > b0) & (off <= budget) & ~((a0 == b0) & (a1 - a0 < 2))
        if keep.any():
            stack.append((level + 1, children[:, keep]))
    return forest.find(np.arange(len(values)))


def near_links(distinct: DataFrame, budget: int = 4) -> DataFrame:
    """Links (a, b) that connect all values of column ``_fp`` (distinct longs) within ``budget`` bits.

    Each run of a trie gives a spanning forest instead of all its pairs, so no link between
    components is lost and the output stays linear. A run above HOT values is dealt out as
    pairs of parts, every two of which meet in one task.
    """
    count = distinct.count()
    layouts = _layouts(count, budget)
    slices = max(1, math.ceil(count * len(layouts) / SLICE))
    rows = distinct.select("_fp", F.explode(F.array(*[F.struct(F.lit(i).alias("trie"), _leading(x).alias("key")) for i, x in enumerate(layouts)])).alias("t")).select("_fp", "t.trie", "t.key")
    hot = rows.groupBy("trie", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT).select("trie", "key", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    hot = written(hot, "hot")
    part = F.pmod(F.xxhash64("_fp"), F.col("parts")).cast("int")
    calm = rows
    if not hot.isEmpty():
        joined = rows.join(hot, ["trie", "key"], "left")
        split = joined.filter("parts is not null").withColumn("p", part).withColumn("q", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        split = split.select("_fp", "trie", F.xxhash64("trie", "key", F.least("p", "q"), F.greatest("p", "q")).alias("run"))
        calm = joined.filter("parts is null").select("_fp", "trie", F.xxhash64("trie", "key").alias("run")).union(split)
    else:
        calm = rows.select("_fp", "trie", F.xxhash64("trie", "key").alias("run"))
    calm = calm.withColumn("slice", F.pmod("run", F.lit(slices)).cast("int"))

    def join(group: pa.Table) -> pa.Table:
        tries, runs = group["trie"].to_numpy(), group["run"].to_numpy()
        fps = group["_fp"].to_numpy().view(np.uint64)
        out = []
        for trie in np.unique(tries):
            mine = tries == trie
            keys, values = runs[mine], arranged(fps[mine], layouts[trie])
            order = np.lexsort((values, keys))
            keys, values, own = keys[order], values[order], fps[mine][order]
            bounds = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
            depth = sum(w for _, w in layouts[trie][: layouts[trie][-1][0]])
            root = trie_join(values, bounds, depth, budget)
            linked = np.flatnonzero(root != np.arange(len(root)))
            out.append((own[linked], own[root[linked]]))
        a, b = (np.concatenate([x[i] for x in out]).view(np.int64) for i in (0, 1))
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    return calm.groupBy("slice").applyInArrow(join, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, budget: int = 4) -> DataFrame:
    """One row per document: ``doc_id``, ``_key`` (hash of the text), ``_fp``, ``component_id`` and ``_root``.

    Fingerprints within ``budget`` bits are linked, links are transitive, and ``component_id`` is the
    least id of the component. Null and empty texts have the fingerprint 0 and are linked like any
    others; fewer words than a shingle make one shingle. Repeated rows stay repeated. Null ids count
    only if a component has no other, and then its id is null. An empty table gives no rows.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("_key"))
    marked = written(fingerprints(slim, "text", words).drop("text"), "fingerprints")
    classes = marked.groupBy("_fp").agg(F.min("doc_id").alias("least"))
    stars = components(near_links(classes.select("_fp"), budget))
    rooted = classes.join(stars.withColumnRenamed("node", "_fp"), "_fp", "left").withColumn("root", F.coalesce("root", "_fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("_fp", "root").join(named, "root").select("_fp", "component_id", F.col("root").alias("_root"))
    return marked.join(named, "_fp")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, budget: int = 4) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates, the one with the least id.

    Rows are told apart by id and text, so of repeated rows one stays. All columns are kept.
    """
    docs, name = apart(docs)
    doc_id, text = name[doc_id], name[text]
    found = near_duplicates(docs, doc_id, text, words, budget)
    first = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("_root").agg(F.first("component_id").alias("_kept_id"), F.min("_key").alias("_kept_key"))
    own = docs.withColumn("_kept_key", F.xxhash64(F.col(text))).withColumn("_kept_id", F.col(doc_id))
    same = [own["_kept_key"] == first["_kept_key"], own["_kept_id"].eqNullSafe(first["_kept_id"])]
    kept = own.join(first, same, "left_semi")
    return kept.dropDuplicates(["_kept_key", "_kept_id"]).select(*[F.col(n).alias(c) for c, n in name.items()])


@register("op4_simhash_trie")
def op4_simhash_trie(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")
