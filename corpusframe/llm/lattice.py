"""Language-model scores from a subword lattice, beside an add-one unigram word model.

A published vocabulary gives pieces and scores. A word's probability is the sum over all its
segmentations into pieces, by forward recursion in log space. The scores only rank the pieces, so
their probabilities start from the ranks and are fitted to the training text by expectation
maximisation over the same lattices. Each distinct word is scored once; documents look up their words.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from corpusframe.llm.registry import register, table
from corpusframe.llm.tokens import NOT_SPACE, chunked, signed
from corpusframe.sources.scratch import written

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK_BYTES = 16 << 20
ROUNDS = 1
PRIOR = 10_000.0  # pieces that the ranks count for, beside the training text
END = "\n"  # keys of the end and of bytes begin with a line feed, so no text of a word equals one


def vocabulary(path: str = VOCABULARY) -> dict[str, float]:
    """Log probabilities of the pieces that can stand in a word, of single bytes and of the end, from the scores' ranks."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    weights = {END: 1e-3}
    for i in range(model.get_piece_size()):
        piece, score = model.id_to_piece(i), model.get_score(i)
        if model.is_byte(i):
            weights["\n" + piece[3:5]] = 1e-6
        elif not (model.is_control(i) or model.is_unknown(i) or score < -1e8 or "▁" in piece[1:]):
            weights[piece] = 1.0 / (10.0 - score)
    total = math.log(sum(weights.values()))
    return {piece: math.log(w) - total for piece, w in weights.items()}


class Lattice:
    """Segmentations of a word: ``▁`` and its characters, cut into pieces; a character without a piece goes by its bytes."""

    def __init__(self, logs: dict[str, float]):
        self.logs = logs
        #: Pieces and all their beginnings; a beginning that is no piece itself has no probability.
        self.beginnings: dict[str, float | None] = {}
        for piece, log in logs.items():
            if piece[0] != "\n":
                for size in range(1, len(piece)):
                    self.beginnings.setdefault(piece[:size], None)
                self.beginnings[piece] = log
        self.bytes = [logs[f"\n{b:02X}"] for b in range(256)]

    def forward(self, text: str) -> tuple[list[float], list[list[tuple[int, float]]]]:
        """For each place the log probability of reaching it, and what reaches it: (start, log so far)."""
        get, bytes_, size, exp = self.beginnings.get, self.bytes, len(text), math.exp
        alpha, into = [0.0] * (size + 1), [[] for _ in range(size + 1)]
        for start in range(size + 1):
            if start:
                terms = into[start]
                if len(terms) == 1:
                    alpha[start] = terms[0][1]
                else:
                    top = max([t[1] for t in terms])
                    alpha[start] = top + math.log(sum([exp(t[1] - top) for t in terms]))
            here, alone = alpha[start], False
            for end in range(start + 1, size + 1):
                log = get(text[start:end], 0.0)
                if log is None:
                    continue
                if log == 0.0:  # no piece begins like this
                    break
                into[end].append((start, here + log))
                alone = alone or end == start + 1
            if not alone and start < size:
                into[start + 1].append((start, here + sum([bytes_[b] for b in text[start].encode()])))
        return alpha, into

    def log(self, word: str) -> float:
        """Natural logarithm of the word's probability over all segmentations."""
        return self.forward("▁" + word)[0][-1]

    def expect(self, word: str, weight: float, counts: dict[str, float]) -> None:
        """Add ``weight`` times the expected number of each piece in a segmentation of the word."""
        text = "▁" + word
        alpha, into = self.forward(text)
        inside = [0.0] * len(alpha)  # weight of the segmentations that have a cut here
        inside[-1] = weight
        for end in range(len(text), 0, -1):
            mass, reach = inside[end], alpha[end]
            if mass <= 0.0:
                continue
            for start, so_far in into[end]:
                share = mass * math.exp(min(0.0, so_far - reach))
                inside[start] += share
                piece = text[start:end]
                if piece in self.logs:
                    counts[piece] = counts.get(piece, 0.0) + share
                else:
                    for b in piece.encode():
                        name = f"\n{b:02X}"
                        counts[name] = counts.get(name, 0.0) + share


def _distinct(texts: pa.Array, train: np.ndarray):
    """Hashes of the distinct words of some texts, their training counts, and a function giving word i."""
    parts, hashes, counts = [], [], []
    for low, high, words in chunked(texts, NOT_SPACE, lower=True):
        h = words.hashes()
        own, where, inverse = np.unique(h, return_index=True, return_inverse=True)
        weight = train[low:high].astype(np.int64)[words.text_of()]
        counts.append(np.bincount(inverse, weight, minlength=len(own)).astype(np.int64))
        hashes.append(own)
        parts.append((words.data, words.starts[where].tolist(), words.ends[where].tolist()))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), []
    sizes = np.array([len(h) for h in hashes])
    own, where, inverse = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    total = np.bincount(inverse, np.concatenate(counts), minlength=len(own)).astype(np.int64)
    chunk = np.searchsorted(np.cumsum(sizes), where, side="right")
    inner = where - (np.cumsum(sizes) - sizes)[chunk]
    return own, total, [parts[c][0][parts[c][1][i] : parts[c][2][i]].tobytes().decode() for c, i in zip(chunk.tolist(), inner.tolist())]


def _words_of(group: pa.Table) -> pa.Table:
    hashes, counts, words = _distinct(group["text"], group["train"].to_numpy(zero_copy_only=False))
    block = group["block"][0].as_py() if group.num_rows else 0
    return pa.table({"block": pa.array(np.full(len(hashes), block, np.int32)), "h": pa.array(signed(hashes)), "word": pa.array(words, pa.string()), "n": pa.array(counts)})


def _expected(logs: dict[str, float]):
    def expect(batches):
        lattice, counts = Lattice(logs), {}
        for batch in batches:
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lattice.expect(word, float(n), counts)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.float64())], names=["piece", "n"])

    return expect


def fit(types: DataFrame, ends: int, logs: dict[str, float], rounds: int = ROUNDS, prior: float = PRIOR) -> dict[str, float]:
    """Piece probabilities from the lattices of all training words; the driver gets one number per piece."""
    seen = types.filter("c > 0").select("word", "c")
    for _ in range(rounds):
        rows = seen.mapInArrow(_expected(logs), "piece string, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        counts = {p: prior * math.exp(log) for p, log in logs.items()}
        for piece, n in rows:
            counts[piece] += round(n, 6)
        counts[END] += ends
        total = math.log(math.fsum(counts.values()))
        logs = {p: math.log(n) - total for p, n in counts.items()}
    return logs


def _scored(logs: dict[str, float]):
    def score(batches):
        lattice = Lattice(logs)
        for batch in batches:
            values = [lattice.log(word) / math.log(10) for word in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(values, pa.float64())], names=["word", "h", "c", "log"])

    return score


_OUT = {"doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "train_tokens": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}


def _sum_up(tokens: int, distinct: int, ends: int, end_log: float):
    floor = math.log10(tokens + distinct + 1)

    def add(docs: pa.Table, known: pa.Table) -> pa.Table:
        h = known["h"].to_numpy()
        rank = np.argsort(h)
        h, c, log = h[rank], known["c"].to_numpy()[rank], known["log"].to_numpy()[rank]
        out = [[], [], [], []]
        for low, high, words in chunked(docs["text"], NOT_SPACE, lower=True):
            at, doc, n = np.searchsorted(h, signed(words.hashes())), words.text_of(), high - low
            own = c[at]
            out[0].append(np.diff(words.first) + 1)
            out[1].append(np.bincount(doc, own > 0, minlength=n).astype(np.int64) + (ends > 0))
            out[2].append(np.bincount(doc, np.log10(own + 1.0) - floor, minlength=n) + math.log10(ends + 1) - floor)
            out[3].append(np.bincount(doc, log[at], minlength=n) + end_log)
        n_tokens, n_known, base, score = (np.concatenate(x) if x else np.zeros(0) for x in out)
        columns = [docs["doc_id"], docs["held_out"], n_tokens, n_known, np.full(docs.num_rows, tokens), base, score]
        return pa.table({name: x.cast(kind) if isinstance(x, pa.ChunkedArray) else pa.array(x, kind) for (name, kind), x in zip(_OUT.items(), columns)})

    return add


def lattice_scores(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10).

    ``held_out`` is a condition; the other documents are the training text. Tokens are the words
    (A-Z lower-cased) and one end. Null and empty texts have the end only; words of any length and
    alphabet have a probability. Repeated rows count as often as they come. An empty table, or one
    without training text, gives the untrained probabilities.
    """
    logs = vocabulary(path)
    frame = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text"))
    size, ends = frame.agg(F.sum(F.octet_length("text")), F.count_if(~F.col("held_out"))).first()
    blocks = max(1, math.ceil((size or 0) / BLOCK_BYTES))
    frame = frame.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    grouped = frame.select("block", "text", (~F.col("held_out")).alias("train")).groupBy("block")
    words = written(grouped.applyInArrow(_words_of, "block int, h long, word string, n long"), "words")
    types = written(words.groupBy("word", "h").agg(F.sum("n").alias("c")).select("word", "h", "c"), "types")
    tokens, distinct = types.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    tokens, distinct = tokens + ends, distinct + (ends > 0)
    logs = fit(types, ends, logs)
    scored = types.mapInArrow(_scored(logs), "word string, h long, c long, log double").select("h", "c", "log")
    known = words.select("block", "h").join(scored, "h")
    cut = _sum_up(tokens, distinct, ends, logs[END] / math.log(10))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return frame.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(cut, schema)


def hashed_remainder(doc_id: str, parts: int):
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts


@register("op7_subword_lattice")
def op7_subword_lattice(spark, sf_dir):
    return lattice_scores(table(spark, sf_dir, "documents"), hashed_remainder("doc_id", 7) == 2)
