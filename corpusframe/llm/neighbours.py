"""Approximate nearest neighbours by cross-polytope hashing with multiprobe tables and exact reranking.

A vector is turned by three rounds of random signs and a fast Hadamard transform; its code is the
signed axis nearest to the result. Several codes make a bucket, several tables make the index. A query
looks into the buckets nearest to it, and every vector found there is compared exactly.

The index is dealt out by vector, not by bucket: each slice of the vectors has all tables over its own, every
query is asked of every slice, and the best of a slice are merged. So a vector is shuffled once, whatever the
number of tables, and a query once a slice, whatever the number of probes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusframe.llm.registry import register, table
from corpusframe.sources.scratch import written

NEAREST = 20
WANTED = 9_000  # vectors that a query should meet; tables with fewer are searched whole
PER_CODE = 1_024  # vectors per bucket up to which one code more isn't used
FEW_TABLES, MORE_TABLES = 8, 12  # with one code a bucket, and with several
LEAST_PROBES, MORE_PROBES = 10, 384
TARGET = 0.95  # least chance that a query meets its last wanted neighbour, if vectors are evenly spread
PAIRS = 400  # simulated pairs of a query and that neighbour
SLICE = 250_000  # vectors of the index in one task
VALUES = 16 << 20  # numbers in them
LEAST = 1_000  # vectors of a slice below which a free core doesn't get one of its own
PART = 4_096  # vectors of a bucket compared at once
PROBES, QUERIES = 4 << 20, 16_384  # probes of a table, and queries, looked up at once
SCORES, PENDING = 2 << 20, 1 << 20  # inner products taken at once, and those that wait to be merged
GATHERED = 1 << 18  # numbers of vectors of small buckets compared together
ROWS = 1_024  # vectors turned at once


def _hadamard_of_columns(x: np.ndarray) -> np.ndarray:
    """The transform of each column, in place; steps run along the rows of x, which are long."""
    width, step, kept = len(x), 1, np.empty_like(x[: len(x) // 2])
    while step < width:
        pairs = x.reshape(width // (2 * step), 2, step, -1)
        above = kept.reshape(width // (2 * step), step, -1)
        np.subtract(pairs[:, 0], pairs[:, 1], out=above)
        pairs[:, 0] += pairs[:, 1]
        pairs[:, 1] = above
        step *= 2
    x /= math.sqrt(width)
    return x


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    return np.ascontiguousarray(_hadamard_of_columns(np.array(x.T, float, order="C")).T)


def last_similarity(count: int, dimensions: int, nearest: int = NEAREST) -> float:
    """The inner product of a unit vector with its ``nearest``-th neighbour among ``count`` evenly spread ones."""
    grid = np.linspace(0, 1, 100_001)[:-1]
    weight = (1 - grid**2) ** ((max(dimensions, 2) - 3) / 2)
    above = weight[::-1].cumsum()[::-1] / (2 * weight.sum())
    return float(grid[np.searchsorted(-above, -nearest / max(count, 2 * nearest))])


def needed_probes(width: int, codes: int, tables: int, similarity: float) -> int:
    """Probes of each table by which a neighbour of this similarity is met with chance TARGET.

    Of simulated pairs, the place of the neighbour's bucket in the query's order of buckets is counted; the
    tables are independent, so a share of the pairs has to be met in each.
    """
    rng = np.random.default_rng(23)
    q, p = rng.normal(size=(2, PAIRS, codes, width))
    q /= np.linalg.norm(q, axis=2, keepdims=True)
    p -= (p * q).sum(2, keepdims=True) * q
    p = similarity * q + math.sqrt(1 - similarity**2) * p / np.linalg.norm(p, axis=2, keepdims=True)
    both = np.concatenate([q, -q], axis=2)
    cost = (both.max(2, keepdims=True) - both) ** 2
    own = np.take_along_axis(cost, np.concatenate([p, -p], axis=2).argmax(2)[:, :, None], 2)[:, :, 0].sum(1)
    places = np.empty(PAIRS, np.int64)
    for i in range(PAIRS):
        sums = np.zeros(1)
        for k in range(codes - 1):
            sums = (sums[:, None] + cost[i, k]).ravel()
        places[i] = np.searchsorted(np.sort(cost[i, -1]), own[i] - sums + 1e-12, side="right").sum()
    share = 1 - (1 - TARGET) ** (1 / tables)
    return int(np.sort(places)[min(PAIRS - 1, math.ceil(share * PAIRS))])


class Tables:
    """Random signs of all tables, and how codes and probes are made from them."""

    def __init__(self, width: int, codes: int, tables: int, probes: int, seed: int = 17):
        self.width, self.codes, self.tables, self.probes = width, codes, tables, probes
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, codes, 3, width))

    @classmethod
    def of(cls, count: int, dimensions: int) -> Tables:
        width = 1 << max(1, (dimensions - 1).bit_length())
        axes, codes = 2 * width, 1
        while count > PER_CODE * axes**codes:
            codes += 1
        share = min(1.0, WANTED / max(1, count))
        if share == 1.0:
            return cls(width, 1, 1, axes)
        similarity = last_similarity(count, dimensions)
        # a code less makes larger buckets, which are dealt out, and every probe reaches further
        while codes > 1 and needed_probes(width, codes, MORE_TABLES, similarity) > MORE_PROBES:
            codes -= 1
        tables = FEW_TABLES if codes == 1 else MORE_TABLES
        probes = max(math.ceil(axes**codes * (1 - (1 - share) ** (1 / tables))), needed_probes(width, codes, tables, similarity))
        return cls(width, codes, tables, min(axes**codes, max(LEAST_PROBES if codes == 1 else MORE_PROBES, probes)))

    def turned(self, x: np.ndarray, t: int, c: int) -> np.ndarray:
        out = np.zeros((self.width, len(x)))
        out[: x.shape[1]] = x.T
        for signs in self.signs[t, c]:
            out *= signs[:, None]
            out = _hadamard_of_columns(out)
        return np.ascontiguousarray(out.T)

    def buckets(self, x: np.ndarray, t: int) -> np.ndarray:
        bucket = np.zeros(len(x), np.int64)
        for c in range(self.codes):
            y = self.turned(x, t, c)
            axis = np.abs(y).argmax(1)
            bucket = bucket * 2 * self.width + axis + self.width * (y[np.arange(len(y)), axis] < 0)
        return bucket

    def probed(self, x: np.ndarray, t: int) -> np.ndarray:
        """The buckets of each row in table t by the squared distance that the row would have to move."""
        bucket, cost = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
        for c in range(self.codes):
            y = self.turned(x, t, c)
            both = np.concatenate([y, -y], axis=1)
            away = (both.max(1, keepdims=True) - both) ** 2
            kept = min(self.probes, cost.shape[1] * away.shape[1])
            near, axes = np.argsort(cost, axis=1), np.argsort(away, axis=1)
            # the sum at places (i, j) of both orders is among the least only if all sums at places no higher are
            i, j = np.nonzero(np.outer(np.arange(1, near.shape[1] + 1), np.arange(1, axes.shape[1] + 1)) <= kept)
            sums = np.take(np.take_along_axis(cost, near, 1), i, axis=1) + np.take(np.take_along_axis(away, axes, 1), j, axis=1)
            best = np.argpartition(sums, kept - 1, axis=1)[:, :kept]
            cost = np.take_along_axis(sums, best, 1)
            near, axes = np.take_along_axis(near, i[best], 1), np.take_along_axis(axes, j[best], 1)
            bucket = np.take_along_axis(bucket, near, 1) * 2 * self.width + axes
        return bucket


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, vec): rows with an id whose vector is neither null nor zero and has finite parts only."""
    vec = F.col("vec")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("vec"))
    return rows.filter(F.col("vec_id").isNotNull() & vec.isNotNull() & (F.size(vec) > 0)).filter(finite & F.exists(vec, lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _by_rows(make, x: np.ndarray) -> np.ndarray:
    return np.concatenate([make(x[low : low + ROWS].astype(float)) for low in range(0, len(x), ROWS)])


class Shelf:
    """Vectors of one length under their buckets in every table."""

    def __init__(self, plan: Tables, cls: np.ndarray, ids: np.ndarray, x: np.ndarray):
        self.plan, self.cls, self.ids, self.x, self.under = plan, cls, ids, x, []
        for t in range(plan.tables):
            bucket = _by_rows(lambda rows: plan.buckets(rows, t), x)
            order = np.argsort(bucket, kind="stable").astype(np.int32)
            names, starts = np.unique(bucket[order], return_index=True)
            self.under.append((order, names, np.append(starts, len(order))))

    def met(self, q: np.ndarray, t: int):
        """(rows of q, rows of the index) for groups of buckets of table t that both have, a bucket a line; -1 fills lines of q."""
        order, names, starts = self.under[t]
        probes = _by_rows(lambda rows: self.plan.probed(rows, t).astype(np.int32 if names[-1] < 1 << 31 else np.int64), q)
        at = np.searchsorted(names, np.arange(names[-1] + 2))[np.minimum(probes, names[-1] + 1)] if names[-1] < 1 << 22 else np.searchsorted(names, probes)
        there = names[np.minimum(at, len(names) - 1)] == probes
        at, rows = at[there].astype(np.uint16 if len(names) < 1 << 16 else np.int64), np.nonzero(there)[0].astype(np.int32)
        del probes, there
        rows = rows[np.argsort(at, kind="stable")]
        asks, holds = np.bincount(at, minlength=len(names)), np.diff(starts)
        first = asks.cumsum() - asks
        todo = np.flatnonzero(asks)
        todo = todo[np.lexsort((asks[todo], holds[todo]))]
        while len(todo):
            # buckets of one size that are asked for about as often, as many as fit
            most = max(1, GATHERED // (max(int(asks[todo[0]]), int(holds[todo[0]])) * q.shape[1]))
            group = todo[:most]
            group = group[(holds[group] == holds[group[0]]) & (asks[group] <= asks[group[0]] * 1.25)]
            todo = todo[len(group) :]
            place = np.arange(asks[group].max())
            some = rows[np.minimum(first[group, None] + place, len(rows) - 1)]
            some[place >= asks[group, None]] = -1
            yield some, order[starts[group, None] + np.arange(holds[group[0]])]

    def best(self, q: np.ndarray, nearest: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows of the ``nearest`` found for each row of q, -1 where there are fewer, and their scores; ties by id."""
        col, score, pending, count = np.full((len(q), nearest), -1, np.int32), np.full((len(q), nearest), -np.inf), [], 0
        for t in range(self.plan.tables):
            for mine, theirs in self.met(q, t):
                for low in range(0, theirs.shape[1], PART):
                    part = theirs[:, low : low + PART]
                    x, step = self.x[part].astype(float).transpose(0, 2, 1), max(1, SCORES // part.size)
                    for first in range(0, mine.shape[1], step):
                        some = mine[:, first : first + step]
                        scores, least = q[some] @ x, np.where(some < 0, np.inf, score[some, -1])[:, :, None]
                        wanted = scores >= least
                        if part.shape[1] > 2 * nearest and wanted.sum() > 2 * nearest * some.size:
                            edge = np.partition(scores, part.shape[1] - nearest, axis=2)[:, :, part.shape[1] - nearest, None]
                            wanted = scores >= np.maximum(least, edge)
                        g, r, c = np.nonzero(wanted)
                        pending.append((some[g, r], part[g, c], scores[g, r, c]))
                        count += len(g)
                        if count > PENDING:
                            pending, count = self._merge(col, score, pending), 0
            pending, count = self._merge(col, score, pending), 0  # a pair comes once a table
        return col, score

    def _merge(self, col: np.ndarray, score: np.ndarray, pending: list) -> list:
        if pending:
            r, c, s = (np.concatenate(x) for x in zip(*pending))
            new = (col[r] != c[:, None]).all(1)
            had = np.nonzero(col >= 0)
            r, c, s = np.append(had[0], r[new]), np.append(col[had], c[new]), np.append(score[had], s[new])
            order = np.argsort(-s)
            order = order[np.argsort(r[order].astype(np.uint16 if len(col) <= 1 << 16 else np.int64), kind="stable")]
            if ((s[order[1:]] == s[order[:-1]]) & (r[order[1:]] == r[order[:-1]])).any():
                order = np.lexsort((self.ids[c], -s, r))
            r, c, s = r[order], c[order], s[order]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            kept = place < col.shape[1]
            col[r[kept], place[kept]], score[r[kept], place[kept]] = c[kept], s[kept]
        return []


def _searched(plan: Tables, nearest: int):
    """The nearest classes of each query among the vectors of a slice; those come before the queries."""
    at_once = max(256, min(QUERIES, PROBES // plan.probes))

    def found(shelf: Shelf, q: np.ndarray, x: np.ndarray):
        col, score = shelf.best(x, nearest)
        row, place = np.nonzero(col >= 0)
        at = col[row, place]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (q[row], shelf.cls[at], shelf.ids[at], score[row, place])], names=["q", "cls", "id", "score"])

    def act(batches):
        index, shelves, asked = {}, {}, {}
        for batch in batches:
            asks, dims = batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy()
            for dim in np.unique(dims):
                for probing, kept in ((False, index), (True, asked)):
                    mine = batch.filter(pa.array((dims == dim) & (asks == probing)))
                    if mine.num_rows:
                        kept.setdefault(dim, []).append((mine.column(3).to_numpy(), mine.column(4).to_numpy(), _matrix(mine.column(5))))
            if asks.any():
                shelves |= {dim: Shelf(plan, *(np.concatenate(v) for v in zip(*index.pop(dim)))) for dim in list(index)}
                for dim in [d for d, x in asked.items() if sum(len(q) for q, *_ in x) >= at_once]:
                    yield from searched(shelves, dim, asked.pop(dim))
        for dim in list(asked):
            yield from searched(shelves, dim, asked.pop(dim))

    def searched(shelves: dict, dim: int, asked: list):
        q, _, x = (np.concatenate(v) for v in zip(*asked))
        if dim in shelves:
            for low in range(0, len(q), at_once):
                yield from found(shelves[dim], q[low : low + at_once], x[low : low + at_once].astype(float))

    return act


def nearest_neighbours(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding", nearest: int = NEAREST, plan: Tables | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``nearest`` found for each query, by inner product in doubles.

    ``is_query`` is a condition on column vec_id; every other usable vector of the same length is indexed
    and may be found. Equal vectors are one entry of the index with their smallest ids, so copies cost
    nothing and none is lost. Ties go to the smaller id. Rows that share an id are one vector to others
    and never neighbours of each other; of their scores the largest counts. Without usable vectors there
    are no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, embedding).withColumn("a", F.xxhash64("vec")).withColumn("b", F.xxhash64(F.reverse("vec"), F.lit(1)))
    classes = rows.groupBy("a", "b").agg(F.min("vec_id").alias("id"), F.min_by("vec", "vec_id").alias("vec"), F.max(is_query).alias("asks"))
    classes = written(classes.select(F.xxhash64("a", "b").alias("cls"), "id", "vec", "asks"), "classes")
    count, dimensions = classes.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
    plan = plan or Tables.of(count, dimensions or 1)
    salts = max(1, math.ceil(vectors.count() / 100_000))
    ids = rows.select(F.xxhash64("a", "b").alias("cls"), "vec_id").distinct().withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(salts)))
    place = F.row_number().over(Window.partitionBy("cls", "salt").orderBy("vec_id"))
    few = ids.withColumn("place", place).filter(F.col("place") <= nearest + 1)
    members = few.withColumn("place", F.row_number().over(Window.partitionBy("cls").orderBy("vec_id"))).filter(F.col("place") <= nearest + 1).select("cls", "vec_id")
    members = written(members, "members")
    queries = written(ids.filter(is_query).select(F.col("cls").alias("q"), F.col("vec_id").alias("query_id")), "queries")

    # slices of the index, and groups of queries where cores are left: a group costs the index once more, a slice the queries
    cores = min(spark.sparkContext.defaultParallelism, math.ceil(count / LEAST))
    groups = max(1, round(math.sqrt(cores / 2)))
    slices = max(1, math.ceil(cores / groups), math.ceil(count / SLICE), math.ceil(count * (dimensions or 1) / VALUES))
    groups = max(1, min(groups, math.ceil(cores / slices)))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    of = lambda n: F.pmod(F.xxhash64("cls", F.lit(n)), F.lit(n)).cast("int")
    given = [F.size("vec").alias("dim"), "cls", "id", "vec"]
    index = classes.select(of(slices).alias("slice"), each(groups).alias("group"), F.lit(False).alias("asking"), *given)
    probes = classes.filter("asks").select(each(slices).alias("slice"), of(groups).alias("group"), F.lit(True).alias("asking"), *given)
    dealt = index.union(probes).withColumn("slice", F.col("slice") * groups + F.col("group")).drop("group")
    dealt = dealt.repartitionById(slices * groups, "slice").sortWithinPartitions("asking")
    found = dealt.mapInArrow(_searched(plan, nearest + 1), "q long, cls long, id long, score double")
    order = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    top = found.withColumn("place", order).filter(F.col("place") <= nearest + 1).select("q", "cls", "score")
    each = top.join(members, "cls").groupBy("q", "vec_id").agg(F.max("score").alias("score"))
    order = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    each = each.withColumn("place", order).filter(F.col("place") <= nearest + 1)
    lists = each.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("list"))
    told = queries.join(lists, "q").select("query_id", F.slice(F.filter("list", lambda x: x["vec_id"] != F.col("query_id")), 1, nearest).alias("list"))
    out = told.select("query_id", F.posexplode("list").alias("rank", "x"))
    return out.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))


@register("op6_cross_polytope")
def op6_cross_polytope(spark, sf_dir):
    return nearest_neighbours(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)
