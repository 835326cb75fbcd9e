"""Benchmark decontamination with a positional inverted index.

Only terms of the benchmark are looked up in the documents. Each benchmark window is found through
its rarest term: the postings of that term give candidate starts, and the postings of the other
terms, shifted by their offsets in the window, are intersected with them from rare to frequent.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusframe.llm.columns import apart
from corpusframe.llm.registry import register, table
from corpusframe.llm.tokens import ALNUM, chunked, sequences, signed
from corpusframe.sources.scratch import written

WINDOW = 13
DICTIONARY = 200_000  # terms (1.6 MB) sent to the tasks at once; a larger benchmark is searched in slices
BROADCAST_WINDOWS = 20_000
KEY = ["_id", "_key"]


def benchmark_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", length: int = WINDOW) -> DataFrame:
    """(item_id, window, terms): every run of ``length`` words of an item; all its words if it has fewer."""

    def cut(batches):
        for batch in batches:
            for low, high, words in chunked(batch.column(1), ALNUM, lower=True):
                hashes = words.hashes()
                for t in range(high - low):
                    own = hashes[words.first[t] : words.first[t + 1]]
                    if not len(own):
                        continue
                    size = min(length, len(own))
                    runs = np.lib.stride_tricks.sliding_window_view(signed(own), size)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch.column(0)[low + t].as_py()] * len(runs), pa.string()), pa.array(signed(sequences(own, size) + np.uint64(size))), pa.array(runs.tolist(), pa.list_(pa.int64()))],
                        names=["item_id", "window", "terms"],
                    )

    slim = items.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text"))
    return slim.mapInArrow(cut, "item_id string, window long, terms array<long>")


def _sorted_terms(df: DataFrame) -> np.ndarray:
    return np.sort(np.array([r[0] for r in df.collect()], dtype=np.int64))


def _lookup(hashes: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """True where a hash is one of the sorted terms."""
    if not len(terms):
        return np.zeros(len(hashes), bool)
    at = np.searchsorted(terms, signed(hashes))
    return terms[np.minimum(at, len(terms) - 1)] == signed(hashes)


def term_counts(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """(term, n): occurrences of the given terms in column ``text``, combined in each task first."""

    def count(batches):
        totals = np.zeros(len(terms), np.int64)
        for batch in batches:
            for _, _, words in chunked(batch.column(0), ALNUM, lower=True):
                hashes = words.hashes()
                found = np.searchsorted(terms, signed(hashes[_lookup(hashes, terms)]))
                totals += np.bincount(found, minlength=len(terms))
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(terms[seen]), pa.array(totals[seen])], names=["term", "n"])

    return docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def positional_index(docs: DataFrame, terms: np.ndarray, anchors: np.ndarray, reach: int) -> DataFrame:
    """(_id, _key, n_words, terms, places) per document: postings of ``terms`` no farther than ``reach``
    words from one of ``anchors``; the others can't be part of a window."""

    def post(batches):
        for batch in batches:
            n_words, found, places, sizes = [], [], [], []
            for low, high, words in chunked(batch.column(2), ALNUM, lower=True):
                hashes = words.hashes()
                listed = _lookup(hashes, terms)
                marks = np.zeros(len(hashes) + 1, np.int64)
                at = np.flatnonzero(listed)
                at = at[_lookup(hashes[at], anchors)]
                text_of = words.text_of()
                np.add.at(marks, np.maximum(at - reach, words.first[text_of[at]]), 1)
                np.add.at(marks, np.minimum(at + reach + 1, words.first[text_of[at] + 1]), -1)
                kept = np.flatnonzero(listed & (np.cumsum(marks)[:-1] > 0))
                found.append(signed(hashes[kept]))
                places.append(kept - words.first[text_of[kept]])
                sizes.append(np.bincount(text_of[kept], minlength=high - low))
                n_words.append(np.diff(words.first))
            joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
            offsets = pa.array(np.concatenate(([0], np.cumsum(joined(sizes)))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(joined(n_words).astype(np.int64)),
                    pa.ListArray.from_arrays(offsets, pa.array(joined(found).astype(np.int64))),
                    pa.ListArray.from_arrays(offsets, pa.array(joined(places).astype(np.int32))),
                ],
                names=[*KEY, "n_words", "terms", "places"],
            )

    return docs.select(*KEY, "text").mapInArrow(post, "_id long, _key long, n_words long, terms array<long>, places array<int>")


def _key(doc_id: Column, text: Column) -> Column:
    """Hash of the text; the last bit says that the id is null."""
    return F.shiftleft(F.xxhash64(text), 1).bitwiseOR(doc_id.isNull().cast("long"))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(doc_id), F.lit(0)).cast("long").alias("_id"), _key(F.col(doc_id), F.col(text)).alias("_key"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))


def _slice(docs: DataFrame, windows: DataFrame, length: int, slop: int) -> tuple[DataFrame, DataFrame]:
    """The index and the matches (_id, _key, window, size, start, exact) of one slice of windows."""
    single = windows.dropDuplicates(["window"]).select("window", "terms")
    terms = _sorted_terms(single.select(F.explode("terms")).distinct())
    counts = term_counts(docs, terms)
    spots = single.select("window", F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "term"))
    spots = spots.join(counts, "term")  # a window with a term that no document has can't occur
    ordered = spots.groupBy("window", "size").agg(F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("by"))
    ordered = written(ordered.filter(F.size("by") == F.col("size")), "windows")
    anchors = _sorted_terms(ordered.select(F.col("by")[0]["term"]).distinct())
    index = written(positional_index(docs, terms, anchors, length - 1 + slop), "index")
    postings = index.filter(F.size("terms") > 0).dropDuplicates(KEY)
    postings = postings.select(*KEY, F.explode(F.arrays_zip("terms", "places")).alias("p"))
    postings = postings.select(*KEY, F.col("p.terms").alias("term"), F.col("p.places").alias("place"))
    first = ordered.select("window", "size", "by", F.col("by")[0]["term"].alias("term"), F.col("by")[0]["offset"].alias("offset"))
    if ordered.count() <= BROADCAST_WINDOWS:
        first = F.broadcast(first)
    starts = postings.join(first, "term").select(*KEY, "window", "size", "by", (F.col("place") - F.col("offset")).alias("start")).filter("start >= 0")
    done = starts.filter("size = 1").select(*KEY, "window", "size", "start", F.lit(True).alias("exact"))
    near = F.explode(F.array(*[F.lit(d) for d in range(-slop, slop + 1)]))
    second = starts.filter("size > 1").withColumn("shift", near).select(
        *KEY, "window", "size", "by", "start", "shift", F.col("by")[1]["term"].alias("term"), (F.col("start") + F.col("by")[1]["offset"] + F.col("shift")).alias("place")
    )
    met = second.join(postings, [*KEY, "term", "place"]).groupBy(*KEY, "window", "size", "start").agg(F.first("by").alias("by"), F.max(F.col("shift") == 0).alias("aligned"))
    met = written(met, "met")
    rest = met.filter("aligned").select(*KEY, "window", "size", "start", F.explode(F.expr("slice(by, 2, size - 1)")).alias("s"))
    rest = rest.select(*KEY, "window", "size", "start", F.col("s.term").alias("term"), (F.col("start") + F.col("s.offset")).alias("place"))
    whole = rest.join(postings, [*KEY, "term", "place"]).groupBy(*KEY, "window", "size", "start").agg(F.count(F.lit(1)).alias("n"))
    exact = whole.filter(F.col("n") == F.col("size") - 1).select(*KEY, "window", "size", "start", F.lit(True).alias("exact"))
    found = done.union(exact)
    if slop:
        found = found.union(met.join(exact, [*KEY, "window", "start"], "left_anti").select(*KEY, "window", "size", "start", F.lit(False)))
    return index, found


def _search(docs: DataFrame, items: DataFrame, item_id: str, item_text: str, length: int, slop: int):
    windows = written(benchmark_windows(items, item_id, item_text, length), "benchmark")
    n_terms = windows.select(F.explode("terms")).distinct().count()
    slices = max(1, math.ceil(n_terms / DICTIONARY))
    index = found = None
    for i in range(slices):
        index, part = _slice(docs, windows.filter(F.pmod("window", F.lit(slices)) == i), length, slop)
        found = part if found is None else found.union(part)
    return windows, index, written(found, "matches")


def find_passages(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", length: int = WINDOW, slop: int = 3) -> DataFrame:
    """(doc_id, item_id, start, size, exact) for each benchmark window in a document.

    ``exact``: the window's words stand there in a row. Otherwise a proximity match: its two rarest
    words stand there in order, at most ``slop`` words off their distance in the window.
    """
    keyed = _keyed(docs, doc_id, text)
    windows, _, found = _search(keyed, items, item_id, item_text, length, slop)
    ids = keyed.select(*KEY, "doc_id").distinct()
    return found.join(windows.select("item_id", "window").distinct(), "window").join(ids, KEY).select("doc_id", "item_id", "start", "size", "exact")


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", length: int = WINDOW, share: int = 20) -> DataFrame:
    """Per document: doc_id, _key, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit inside any exact occurrence of a window; a document is contaminated if hits are at
    least one in ``share`` words. Null and empty texts have no words. Items without words match
    nothing, equal windows of several items count for each, null item ids are not listed. Rows with
    the same id are told apart by their texts; repeated rows stay repeated. Empty tables on either
    side give no hits.
    """
    keyed = _keyed(docs, doc_id, text)
    windows, index, found = _search(keyed, items, item_id, item_text, length, 0)
    found = found.filter("exact").withColumn("end", F.col("start") + F.col("size"))
    before = Window.partitionBy(*KEY).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
    hits = found.withColumn("covered", covered).groupBy(*KEY).agg(F.sum("covered").alias("n_hit"))
    named = found.select(*KEY, "window").distinct().join(windows.select("item_id", "window").distinct(), "window")
    named = named.groupBy(*KEY).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    sums = index.select(F.col("_id"), "_key", "n_words").join(hits, KEY, "left").join(named, KEY, "left")
    ids = F.when(F.col("_key").bitwiseAND(1) == 0, F.col("_id"))
    n_hit, items_ = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("items", F.array().cast("array<string>"))
    return sums.select(
        ids.alias("doc_id"),
        "_key",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items_).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items_), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated ones; all columns are kept."""
    bad = contamination(docs, items, doc_id, text, **options).filter("contaminated").select(F.col("doc_id").alias("_bad_id"), F.col("_key").alias("_bad_key")).distinct()
    own, name = apart(docs)
    same = [_key(own[name[doc_id]], own[name[text]]) == bad["_bad_key"], own[name[doc_id]].eqNullSafe(bad["_bad_id"])]
    return own.join(bad, same, "left_anti").select(*[F.col(n).alias(c) for c, n in name.items()])


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_UPPER, _LOWER)
SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(13, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
m AS (SELECT r, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM m) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""


@register("op9_positional_decontamination", SQL)
def op9_positional_decontamination(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_key")
