"""Best-fit packing of tokenized documents by length patterns, fitted with non-negative least squares.

Documents become pieces of at most one sequence. All the plan needs is how many pieces have each length,
a histogram no longer than a sequence. Patterns of up to three lengths that fill a sequence exactly are
enumerated, their repeat counts fitted to the histogram by non-negative least squares and rounded within
it; what is left goes into patterns of any number of lengths, longest first. Pieces then look up their
place by their rank among the pieces of their length, so no task and not the driver ever sees more
than its share.
"""

from __future__ import annotations

import re
import zlib
from array import array
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from corpusframe.llm.places import places
from corpusframe.llm.registry import register, table
from corpusframe.sources.scratch import written

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CAPACITY = 2048
END = 0  # id behind each document
ROUNDS = 80  # of the fit, at most
WORTH = 0.01  # pieces, weighed by length, that a pattern has to mend to join the fit
SLICE = 1 << 20  # characters tokenized at once
KEPT = 300_000  # words (about 60 MB) remembered by a Python worker, and as many of those met before

# The characters that the tokenizer's pattern takes as white space.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Parts of a text that its tokens never cross: a word with the blank before it, or white space that no word takes.
_PARTS = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: A blank inside other white space, before which a text can't be cut.
_INNER = re.compile(f"[{_SPACE}] (?:[{_SPACE}]|\\Z)")
_CUT = re.compile(f"(?<=[^{_SPACE}]) (?=[^{_SPACE}])")


_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Parts of visible ASCII characters and accented letters, and the runs that the pattern takes apart in them.
_WORD = re.compile(f" ?[{_LETTERS}]+")
_PLAIN = re.compile(f" ?[!-~{_LETTERS}]+")
_RUNS = re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[0-9]+| ?[^ {_LETTERS}0-9]+")
_SHOWN = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
#: The byte alphabet of the merges: printable bytes stand for themselves, the others for characters from 256 on.
_ALPHABET = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class Encoder(dict):
    """Token ids of texts as little-endian 32-bit numbers; parts met lately are looked up, not tokenized again."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # a special token's name in a text is ordinary text
        self.model = self.tokenizer.model
        self.before: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        ids = self.before.get(part)
        if ids is not None:
            pass
        elif _WORD.fullmatch(part):  # merges alone
            shown = part.replace(" ", "\u0120") if part.isascii() else part.encode().decode("latin-1").translate(_ALPHABET)
            ids = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        else:
            plain = _PLAIN.fullmatch(part)
            parts = (_RUNS if plain else _PARTS).findall(part)
            if len(parts) < 2:
                ids = array("I", self.tokenizer.encode(part, add_special_tokens=False).ids).tobytes()
            else:
                ids = b"".join([self[p] for p in parts])
                if not plain:  # holds a line break, so it hardly comes again
                    return ids
        if len(part) <= 64:
            self[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text; about ``SLICE`` characters of a long one are in work at once."""
        if len(self) > KEPT:
            self.before = dict(self)
            self.clear()
        out, at = [], 0
        while at < len(text):
            cut = _CUT.search(text, at + SLICE) if len(text) - at > SLICE else None
            end = cut.start() if cut else len(text)
            some = text[at:end]
            if "\0" in some or _INNER.search(some):
                parts = _PARTS.findall(some)
            else:  # the same but for line breaks, which a part may hold
                parts = some.replace(" ", "\0 ").split("\0")
            out.append(b"".join(map(self.__getitem__, parts)))
            at = end
        return b"".join(out)


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker, kept from task to task."""
    return Encoder(path)


def cut_points(size: int, capacity: int) -> list[int]:
    """Starts and the end of the pieces of ``size`` ids: only the first piece may be shorter than the capacity."""
    return [0, *range((size - 1) % capacity + 1, size + 1, capacity)]


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = VOCABULARY, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of tokenized documents, each with one ``END`` behind it."""
    end = np.array([END], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches):
        encode = encoder(path).encode
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                some = batch.slice(low, 500)
                rows = [[], [], [], [], [], []]
                for row, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    ids = encode(text or "") + end
                    points = cut_points(len(ids) // 4, capacity)
                    for n, (a, b) in enumerate(zip(points, points[1:])):
                        own = ids[4 * a : 4 * b]
                        for column, value in zip(rows, (row, n, a, b - a, zlib.crc32(own), own)):
                            column.append(value)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)][: len(names)], names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, schema)


def exact_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All patterns of one to three of ``lengths`` that sum to the capacity: rows of three, longest first, 0 for none."""
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    there[0] = True
    a, b = np.meshgrid(lengths, np.append(0, lengths), indexing="ij")
    c = capacity - a - b
    good = (b <= a) & (c >= 0) & (c <= b)
    a, b, c = a[good], b[good], c[good]
    good = there[c]
    return np.stack([a[good], b[good], c[good]], axis=1)


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS, least: float = 1e-4) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns that bring the histogram ``counts`` nearest, errors weighed in tokens.

    An active-set method: the patterns that would mend most, one for each longest length, join the set in
    use; least squares over the set by conjugate gradients; patterns that would turn negative leave it. Where
    many at once do not help, one joins at a time, until the share ``least`` of the error is no longer gained.
    """
    weight = (np.arange(len(counts)) / (len(counts) - 1.0)) ** 2
    x, used = np.zeros(len(patterns)), np.zeros(len(patterns), bool)

    def times(columns, values):
        out = np.zeros(len(counts))
        for k in range(columns.shape[1]):
            out += np.bincount(columns[:, k], values, minlength=len(counts))
        out[0] = 0.0
        return out

    def mended(columns, rest):
        return (weight * rest)[columns].sum(axis=1)

    def solved(columns, start):
        z = start.copy()
        residual = mended(columns, counts - times(columns, z))
        step, norm = residual.copy(), residual @ residual
        goal = norm * 1e-10
        for _ in range(200):
            if norm <= goal or norm == 0.0:
                break
            image = mended(columns, times(columns, step))
            rate = norm / (step @ image)
            z += rate * step
            residual -= rate * image
            norm, last = residual @ residual, norm
            step = residual + norm / last * step
        return z

    def joined(chosen, exact):
        """Least squares over the set with the patterns ``chosen``; ``exact``: no step makes the error grow."""
        used[chosen] = True
        for _ in range(len(patterns) if exact else 10):
            at = np.flatnonzero(used)
            z, old = solved(patterns[at], x[at]), x[at]
            bad = z <= 0
            stuck = bad & (old == 0) if exact else bad
            if bad.any() and not stuck.any():  # as far towards the solution as none turns negative
                reach = np.where(bad, old / np.where(bad, old - z, 1.0), np.inf)
                z = np.maximum(old + reach.min() * (z - old), 0.0)
                stuck = reach <= reach.min() * (1 + 1e-9)
            elif exact and stuck.any():
                z = old
            x[at] = np.where(stuck, 0.0, np.maximum(z, 0.0))
            used[at[stuck]] = False
            if not bad.any():
                break
        return (weight * (counts - times(patterns[used], x[used])) ** 2).sum()

    error, single = np.inf, False
    for _ in range(rounds):
        gain = np.where(used, 0.0, mended(patterns, counts - times(patterns[used], x[used])))
        order = np.flatnonzero(gain > WORTH)
        if not len(order):
            break
        order = order[np.argsort(-gain[order], kind="stable")]
        first = np.unique(patterns[order, 0], return_index=True)[1]
        last, error = error, joined(order[:1] if single else order[first], single)
        if single and last - error < least * last:
            break
        single = single or last - error < 1e-3 * last  # many at once no longer help
    return x


def plan(counts: np.ndarray, rounds: int = ROUNDS) -> list[tuple[list[int], int]]:
    """(lengths, repeats) of patterns that take each piece once; ``counts[n]`` pieces have length n.

    The capacity is the greatest index. Patterns that fill a sequence come first, by the fit; the rest
    of the histogram is packed longest first into patterns that repeat as often as their lengths last.
    """
    capacity, left = len(counts) - 1, counts.astype(np.int64).copy()
    known = exact_patterns(np.flatnonzero(left), capacity)
    x = fit(known, left.astype(float), rounds)
    out = []
    for p in np.argsort(-x, kind="stable"):
        if x[p] < 0.5:
            break
        lengths, often = np.unique(known[p][known[p] > 0], return_counts=True)
        repeats = int(min(round(x[p]), (left[lengths] // often).min()))
        if repeats:
            left[lengths] -= repeats * often
            out.append((known[p][known[p] > 0].tolist(), repeats))
    while True:
        there = np.flatnonzero(left)
        if not len(there):
            return out
        lengths, often, room, at = [], [], capacity, len(there) - 1
        while at >= 0:
            n = int(there[at])
            q = min(room // n, int(left[n]))
            if q:
                lengths.append(n)
                often.append(q)
                room -= q * n
            at = min(at, int(np.searchsorted(there, room, side="right"))) - 1
        repeats = int((left[lengths] // np.array(often)).min())
        left[lengths] -= repeats * np.array(often)
        out.append(([n for n, q in zip(lengths, often) for _ in range(q)], repeats))


def seats(patterns: list[tuple[list[int], int]], capacity: int) -> tuple[np.ndarray, ...]:
    """The plan as arrays: the first piece of each length, and of each seat its first piece, sequence and offset.

    Pieces are numbered by length and rank; a seat is one place of one pattern and takes as many
    pieces in a row as the pattern repeats. There are at most a few seats for each length.
    """
    rows, sequence = [], 0
    for lengths, repeats in patterns:
        offset = 0
        for n in lengths:
            rows.append((n, repeats, sequence, offset))
            offset += n
        sequence += repeats
    length, repeats, first, offset = np.array(sorted(rows), np.int64).reshape(-1, 4).T
    piece = np.cumsum(repeats) - repeats
    per_length = np.bincount(length, repeats, minlength=capacity + 1).astype(np.int64)
    return np.cumsum(per_length) - per_length, piece, first, offset


def packed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = VOCABULARY, capacity: int = CAPACITY, with_ids: bool = True, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset): every piece of every document and its place.

    Ids are those of the tokenizer at ``path`` without special tokens, then ``END``; documents longer
    than ``capacity`` are cut. Null and empty texts are one ``END``; rows with equal or null ids are packed as
    rows of their own. The driver gets a count for each length up to ``capacity`` and nothing else. The
    places follow from lengths, ids and texts, so reruns agree but for the order of rows that are equal in
    all of these. An empty table gives no rows.
    """
    cut = written(pieces(docs, doc_id, text, path, capacity, with_ids), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():
        counts[length] = n
    first_of, piece, sequence, offset = seats(plan(counts, rounds), capacity)
    ranked = places(cut, ["length"], ["doc_id", "piece", "ids_crc32"], "ranked").drop("_n", "_group")
    names, length_at = ranked.columns[:-1], ranked.columns.index("length")

    def seat(batches):
        for batch in batches:
            number = first_of[batch.column(length_at).to_numpy()] + batch.column(batch.num_columns - 1).to_numpy()
            at = np.searchsorted(piece, number, side="right") - 1
            found = [pa.array(sequence[at] + number - piece[at]), pa.array(offset[at])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], names=[*names, "sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInArrow(seat, f"{kinds}, sequence_id long, offset long")


def sequences(found: DataFrame) -> DataFrame:
    """(sequence_id, length, ids, doc_ids, offsets) of pieces packed with their ids; a sequence is bounded by its capacity."""
    rows = found.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids"))).alias("p"))

    def number(batches):
        for batch in batches:
            joined = [np.frombuffer(b"".join(parts), "<i4") for parts in batch.column(2).to_pylist()]
            ids = pa.array(joined, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ids, batch.column(3), batch.column(4)], names=["sequence_id", "length", "ids", "doc_ids", "offsets"])

    length = F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["length"])
    flat = rows.select("sequence_id", length.alias("length"), F.col("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets"))
    return flat.mapInArrow(number, "sequence_id long, length long, ids array<int>, doc_ids array<long>, offsets array<long>")


@register("op13_pattern_packing")
def op13_pattern_packing(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"), with_ids=False)
