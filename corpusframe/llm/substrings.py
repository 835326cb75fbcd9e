"""Substring dedup with repeated-phrase automata.

A window is a run of words. Every window holds one phrase, the run of a few words with the least hash
in it, so equal windows hold equal phrases and a window can only recur if its phrase does. Phrases
are counted first; those that recur are sent back to the blocks of documents that hold them, where an
Aho-Corasick automaton of them (one shard per block, no larger than the block) is compiled and run
over the block's documents. Windows around the located phrases are then compared by hash, and each
word covered by a window that also starts earlier is removed.
"""

from __future__ import annotations

import hashlib
import math

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from corpusframe.llm.registry import register, table
from corpusframe.llm.tokens import NOT_SPACE, Words, chunked, sequences, signed
from corpusframe.sources.scratch import written

WINDOW = 20
PHRASE = 8
BLOCK_BYTES = 6 << 20
LAST = (1 << 63) - 1  # stands for a null id: later than every other


def anchors(words: Words, hashes: np.ndarray, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all phrases, the starts of whole windows, and the place of the phrase of each."""
    grams = sequences(hashes, phrase)
    reach = window - phrase + 1
    count = len(grams) - reach + 1
    if count <= 0:
        return grams, np.zeros(0, np.int64), np.zeros(0, np.int64)
    least, place = grams[:count].copy(), np.zeros(count, np.int64)
    for k in range(1, reach):
        other = grams[k : k + count]
        better = other < least
        least[better] = other[better]
        place[better] = k
    marks = np.zeros(count + 1, np.int64)
    sizes = np.diff(words.first) - window + 1
    long = sizes > 0
    marks[words.first[:-1][long]] += 1
    marks[words.first[:-1][long] + sizes[long]] -= 1
    starts = np.flatnonzero(np.cumsum(marks)[:count] > 0)
    return grams, starts, starts + place[starts]


def _phrase_rows(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """(h, block, n): phrases of each block, one row per batch of documents that holds one."""

    def find(batches):
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            for low, high, words in chunked(batch.column(1), NOT_SPACE):
                grams, _, place = anchors(words, words.hashes(), window, phrase)
                place = np.unique(place)
                if len(place):
                    at = blocks[low:high][np.searchsorted(words.first, place, side="right") - 1]
                    h = signed(grams[place])
                    rank = np.lexsort((at, h))
                    h, at = h[rank], at[rank]
                    lead = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (at[1:] != at[:-1])])
                    n = np.diff(np.r_[lead, len(h)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(h[lead]), pa.array(at[lead]), pa.array(n)], names=["h", "block", "n"])

    return docs.select("block", "text").mapInArrow(find, "h long, block int, n int")


def _automaton(ids: np.ndarray, phrases: list[int], length: int):
    """The automaton of the phrases that start at the given places of a sequence of word numbers."""
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for at in phrases:
        found.add_word(tuple(ids[at : at + length].tolist()), length)
    found.make_automaton()
    return found


def _locate(words: Words, hashes: np.ndarray, grams: np.ndarray, place: np.ndarray, recurring: np.ndarray, phrase: int) -> np.ndarray:
    """True at each word where a recurring phrase starts, found by the block's automaton."""
    own, where = np.unique(signed(grams[place]), return_index=True)
    listed = place[where[np.isin(own, recurring, assume_unique=True)]]
    starts = np.zeros(len(words) + 1, bool)
    if not len(listed):
        return starts
    _, ids = np.unique(hashes, return_inverse=True)
    automaton = _automaton(ids, listed.tolist(), phrase)
    for t in range(len(words.first) - 1):
        low, high = words.first[t], words.first[t + 1]
        ends = [end for end, _ in automaton.iter(tuple(ids[low:high].tolist()))]
        starts[low + np.array(ends, np.int64) - phrase + 1] = True
    return starts


_MARKED = "doc_id long, order long, block int, n_words long, n_removed long, kept_sha256 string, text string, spans array<int>"


def _mark(window: int, phrase: int):
    def mark(docs: pa.Table, told: pa.Table) -> pa.Table:
        copies = told["copy"].to_numpy(zero_copy_only=False)
        recurring = np.unique(told["h"].to_numpy()[~copies])
        first_of = dict(zip(told["h"].to_numpy()[copies].tolist(), told["first"].to_numpy()[copies].tolist()))
        out = {name: [] for name in ("doc_id", "order", "block", "n_words", "n_removed", "kept_sha256", "text", "spans")}
        if not docs.num_rows:
            return pa.table({f: pa.array([], t) for f, t in _TYPES.items()})
        order, digest = docs["order"].to_numpy(), docs["digest"].to_numpy()
        ids, block, texts = docs["doc_id"].to_pylist(), docs["block"].to_pylist(), docs["text"].combine_chunks()
        for low, high, words in chunked(texts, NOT_SPACE):
            hashes = words.hashes()
            grams, starts, place = anchors(words, hashes, window, phrase)
            located = _locate(words, hashes, grams, place, recurring, phrase) if len(recurring) else np.zeros(len(words) + 1, bool)
            repeated = starts[located[place]] if len(place) else starts
            bounds = np.searchsorted(repeated, words.first)
            for t in range(high - low):
                i, begin, end = low + t, words.first[t], words.first[t + 1]
                text = texts[i].as_buffer().to_pybytes() if texts[i].is_valid else b""
                copy = first_of.get(int(digest[i]), LAST) < order[i]
                runs = repeated[bounds[t] : bounds[t + 1]] - begin
                whole = copy and end - begin >= window
                open_ = len(runs) > 0 and not copy
                out["doc_id"].append(ids[i])
                out["order"].append(order[i])
                out["block"].append(block[i])
                out["n_words"].append(end - begin)
                out["n_removed"].append(end - begin if whole else 0)
                out["kept_sha256"].append(hashlib.sha256(b"" if whole else b" ".join(text.split())).hexdigest())
                out["text"].append(text.decode() if open_ else None)
                cuts = np.flatnonzero(np.diff(runs) > 1) + 1
                out["spans"].append(np.stack([runs[np.r_[0, cuts]], runs[np.r_[cuts - 1, len(runs) - 1]]], 1).ravel().tolist() if open_ else [])
        return pa.table({f: pa.array(out[f], t) for f, t in _TYPES.items()})

    return mark


_TYPES = {"doc_id": pa.int64(), "order": pa.int64(), "block": pa.int32(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "text": pa.string(), "spans": pa.list_(pa.int32())}


def _candidates(words: Words, spans: list, window: int):
    """Hashes of the windows inside the spans (first and last starts) of each text, and their starts."""
    places = [np.concatenate([np.arange(a, b + 1) for a, b in zip(s[::2], s[1::2])]) + words.first[t] if len(s) else np.zeros(0, np.int64) for t, s in enumerate(spans)]
    at = np.concatenate(places) if places else np.zeros(0, np.int64)
    return sequences(words.hashes(), window)[at], at


def _window_rows(marked: DataFrame, window: int) -> DataFrame:
    """(h, block, order): candidate windows, the least document of each in a batch."""

    def find(batches):
        for batch in batches:
            block, order = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            spans = batch.column(3).to_pylist()
            for low, high, words in chunked(batch.column(2), NOT_SPACE):
                hashes, at = _candidates(words, spans[low:high], window)
                doc = low + np.searchsorted(words.first, at, side="right") - 1
                rank = np.lexsort((order[doc], block[doc], hashes))
                h, b, o = signed(hashes[rank]), block[doc[rank]], order[doc[rank]]
                lead = np.r_[True, (h[1:] != h[:-1]) | (b[1:] != b[:-1])] if len(h) else np.zeros(0, bool)
                yield pa.RecordBatch.from_arrays([pa.array(h[lead]), pa.array(b[lead]), pa.array(o[lead])], names=["h", "block", "order"])

    return marked.select("block", "order", "text", "spans").mapInArrow(find, "h long, block int, order long")


def _cut(window: int):
    """Decide a block: a window goes if its text is in an earlier document, or earlier in its own."""

    def cut(docs: pa.Table, told: pa.Table) -> pa.Table:
        ids, orders, kept, n_words, removed, digests = docs["doc_id"].to_pylist(), docs["order"].to_numpy() if docs.num_rows else np.zeros(0, np.int64), [], [], [], []
        texts, spans = docs["text"].combine_chunks(), docs["spans"].to_pylist()
        known = told["h"].to_numpy()
        rank = np.argsort(known, kind="stable")
        known, earliest = known[rank], told["order"].to_numpy()[rank]
        own_h, own_o, parts = [], [], []
        for low, high, words in chunked(texts, NOT_SPACE):
            hashes, at = _candidates(words, spans[low:high], window)
            doc = low + np.searchsorted(words.first, at, side="right") - 1
            parts.append((low, high, words, signed(hashes), at, doc))
            own_h.append(signed(hashes))
            own_o.append(orders[doc])
        all_h = np.concatenate([known, *own_h]) if parts else known
        all_o = np.concatenate([earliest, *own_o]) if parts else earliest
        rank = np.lexsort((all_o, all_h))
        all_h, all_o = all_h[rank], all_o[rank]
        lead = np.r_[True, all_h[1:] != all_h[:-1]] if len(all_h) else np.zeros(0, bool)
        all_h, all_o = all_h[lead], all_o[lead]  # each window's earliest document
        for low, high, words, hashes, at, doc in parts:
            gone = all_o[np.searchsorted(all_h, hashes)] < orders[doc]
            pairs = np.lexsort((at, hashes, doc))
            again = np.r_[False, (hashes[pairs][1:] == hashes[pairs][:-1]) & (doc[pairs][1:] == doc[pairs][:-1])] if len(pairs) else np.zeros(0, bool)
            gone[pairs[again]] = True
            marks = np.zeros(len(words) + 1, np.int64)
            np.add.at(marks, at[gone], 1)
            np.add.at(marks, at[gone] + window, -1)
            stay = np.cumsum(marks)[:-1] == 0
            for t in range(high - low):
                begin, end = words.first[t], words.first[t + 1]
                left = b" ".join(words.word(i) for i in (begin + np.flatnonzero(stay[begin:end])).tolist())
                n_words.append(end - begin)
                removed.append(end - begin - int(stay[begin:end].sum()))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode())
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string()), "kept": pa.array(kept, pa.string())})

    return cut


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, and ``kept`` where some but not all words go.

    A word goes if a window of ``window`` words that covers it has its words also starting earlier: in
    a document of smaller id, or earlier in the same one. Windows are judged on the input. Null and
    empty texts have no words; texts shorter than a window lose nothing. Null ids come last and, like
    rows that share an id, are no copies of each other. An empty table gives no rows.
    """
    frame = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(doc_id), F.lit(LAST)).cast("long").alias("order"), F.col(text).alias("text"))
    frame = frame.withColumn("digest", F.xxhash64("text", F.length("text")))
    total = frame.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    frame = frame.withColumn("block", F.pmod(F.xxhash64("order", "digest"), F.lit(blocks)).cast("int"))

    phrases = _phrase_rows(frame, window, phrase)
    same = Window.partitionBy("h")  # counted where the rows are, so they are computed and shuffled once
    routed = phrases.withColumn("n", F.sum("n").over(same)).filter("n > 1").select("block", "h", F.lit(False).alias("copy"), F.lit(0).cast("long").alias("first"))
    by_text = frame.select("digest", "order", F.sha2("text", 256).alias("sha"), "block")
    groups = by_text.groupBy("digest").agg(F.min("order").alias("first"), F.count(F.lit(1)).alias("n"), F.min("sha").alias("a"), F.max("sha").alias("b"))
    groups = groups.filter("n > 1 and a = b").select("digest", "first")
    copies = by_text.join(groups, "digest").filter(F.col("order") > F.col("first")).groupBy("block", "digest").agg(F.min("first").alias("first"))
    told = routed.union(copies.select("block", F.col("digest").alias("h"), F.lit(True), "first"))
    marked = written(frame.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_mark(window, phrase), _MARKED), "marked")

    open_ = marked.filter("text is not null")
    rows = _window_rows(open_, window)
    later = rows.withColumn("earliest", F.min("order").over(same)).filter(F.col("earliest") < F.col("order")).select("block", "h", F.col("earliest").alias("order"))
    cut = open_.groupBy("block").cogroup(later.groupBy("block")).applyInArrow(_cut(window), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    done = marked.filter("text is null").select("doc_id", "n_words", "n_removed", "kept_sha256", F.lit(None).cast("string").alias("kept"))
    return done.union(cut)


@register("op1_phrase_automata")
def op1_phrase_automata(spark, sf_dir):
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
