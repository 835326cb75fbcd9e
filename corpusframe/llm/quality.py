"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded by its shape (case, punctuation, repetition)
and hashed words; a gated attention network, trained on document labels, weighs the passages and
scores their weighted mean.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusframe.llm.columns import apart
from corpusframe.llm.lattice import hashed_remainder
from corpusframe.llm.registry import register, table
from corpusframe.llm.tokens import NOT_SPACE, Words, chunked

PASSAGE = 128  # words
BUCKETS = 48  # of hashed words
TRAIN_DOCS = 1_500  # labelled documents of each class, the first by hash
TRAIN_PASSAGES = 48  # of a training document, evenly spread; scoring reads all
HIDDEN, GATE, STEPS, RATE, DECAY = 24, 12, 300, 0.02, 1e-4
_UPPER, _LOWER_CASE, _DIGIT, _BREAK = (0x41, 0x5A), (0x61, 0x7A), (0x30, 0x39), (0x0A, 0x0A)


def encode(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Passage vectors, and for each text the place of its first passage (one behind the last at the end)."""
    counts = np.diff(words.first)
    passages = np.maximum(1, -(-counts // PASSAGE))
    first = np.concatenate(([0], np.cumsum(passages)))
    total = int(first[-1])
    text_of = words.text_of()
    inner = np.arange(len(words)) - words.first[text_of]
    at = first[text_of] + inner // PASSAGE
    n = np.bincount(at, minlength=total).astype(float)
    some = np.maximum(n, 1)
    h = words.hashes()
    lead = np.flatnonzero(inner % PASSAGE == 0)
    tail = np.r_[lead[1:], len(words)] - 1 if len(lead) else lead
    lo, hi = np.zeros(total, np.int64), np.zeros(total, np.int64)
    lo[at[lead]], hi[at[lead]] = words.starts[lead], words.ends[tail]
    size = np.maximum(hi - lo, 1).astype(float)

    def share(mask):
        sums = np.concatenate(([0], np.cumsum(mask)))
        return (sums[hi] - sums[lo]) / size

    data = words.data
    span = lambda ends: (data >= ends[0]) & (data <= ends[1])
    upper, lower, digit, wide = span(_UPPER), span(_LOWER_CASE), span(_DIGIT), data >= 0x80
    lengths = (words.ends - words.starts).astype(float)
    order = np.lexsort((h, at))
    hs, ats = h[order], at[order]
    fresh = np.r_[True, (hs[1:] != hs[:-1]) | (ats[1:] != ats[:-1])] if len(hs) else np.zeros(0, bool)
    distinct = np.bincount(ats[fresh], minlength=total)
    again = np.bincount(at[1:][(h[1:] == h[:-1]) & (at[1:] == at[:-1])], minlength=total) if len(h) else np.zeros(total)
    mean = np.bincount(at, lengths, minlength=total) / some
    square = np.bincount(at, lengths * lengths, minlength=total) / some
    shape = [
        np.log1p(n), mean, np.sqrt(np.maximum(square - mean * mean, 0)), distinct / some, again / some,
        share(upper), share(lower), share(digit), share(wide), share(data == 0x21), share(data == 0x2E), share(data == 0x2C),
        share(span(_BREAK)), share(~(upper | lower | digit | wide | ~NOT_SPACE[data])),
    ]
    hashed = np.bincount(at * BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64), minlength=total * BUCKETS).reshape(total, BUCKETS)
    return np.column_stack([*shape, np.sqrt(hashed / some[:, None])]), first


class Model:
    """Gated attention over the passages of a document; all arrays are small and travel with the tasks."""

    def __init__(self, mean, scale, weights, constant=None):
        self.mean, self.scale, self.weights, self.constant = mean, scale, weights, constant

    def forward(self, x, first):
        w = self.weights
        e = np.tanh(x @ w["E"] + w["e"])
        t, g = np.tanh(e @ w["T"]), 1 / (1 + np.exp(-(e @ w["G"])))
        raw = (t * g) @ w["a"]
        top = np.maximum.reduceat(raw, first[:-1])
        rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
        part = np.exp(raw - top[rows])
        part /= np.add.reduceat(part, first[:-1])[rows]
        z = np.add.reduceat(part[:, None] * e, first[:-1], axis=0)
        return e, t, g, part, rows, z, 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["d"], -30, 30)))

    def score(self, x, first):
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        return self.forward((x - self.mean) / self.scale, first)[-1]


def train(x: np.ndarray, first: np.ndarray, label: np.ndarray, seed: int = 5) -> Model:
    """Full-batch Adam on the mean log loss, each class weighing one half."""
    if len(label) == 0 or label.min() == label.max():
        return Model(None, None, None, 0.5 if len(label) == 0 else float(label[0]))
    mean, scale = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / scale
    rng = np.random.default_rng(seed)
    shapes = {"E": (x.shape[1], HIDDEN), "e": HIDDEN, "T": (HIDDEN, GATE), "G": (HIDDEN, GATE), "a": GATE, "c": HIDDEN}
    weights = {k: rng.normal(0, 0.2, s) for k, s in shapes.items()} | {"d": np.zeros(1)}
    model = Model(mean, scale, weights)
    importance = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean())) / len(label)
    m, v = ({k: np.zeros_like(w) for k, w in weights.items()} for _ in range(2))
    for step in range(1, STEPS + 1):
        w = model.weights
        e, t, g, part, rows, z, p = model.forward(x, first)
        off = (p - label) * importance
        dz = off[:, None] * w["c"]
        along = np.einsum("ij,ij->i", dz[rows], e)
        mid = np.add.reduceat(part * along, first[:-1])[rows]
        draw = part * (along - mid)  # through the softmax
        dt, dg = draw[:, None] * w["a"] * g * (1 - t * t), draw[:, None] * w["a"] * t * g * (1 - g)
        de = (part[:, None] * dz[rows] + dt @ w["T"].T + dg @ w["G"].T) * (1 - e * e)
        grads = {"E": x.T @ de, "e": de.sum(0), "T": e.T @ dt, "G": e.T @ dg, "a": (t * g).T @ draw, "c": z.T @ off, "d": off.sum(keepdims=True)}
        for k, grad in grads.items():
            grad = grad + DECAY * w[k]
            m[k] = 0.9 * m[k] + 0.1 * grad
            v[k] = 0.999 * v[k] + 0.001 * grad * grad
            w[k] = w[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def _bags(batches):
    """(doc_id, label, width, vectors) of training documents, with at most TRAIN_PASSAGES passages each."""
    for batch in batches:
        for low, high, words in chunked(batch.column(2), NOT_SPACE):
            x, first = encode(words)
            kept = []
            for t in range(high - low):
                n = first[t + 1] - first[t]
                own = first[t] + np.unique(np.linspace(0, n - 1, min(n, TRAIN_PASSAGES)).astype(np.int64))
                kept.append(x[own].astype(np.float32).ravel().tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low), pa.array(kept, pa.list_(pa.float32()))],
                names=["doc_id", "label", "x"],
            )


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", limit: int = TRAIN_DOCS) -> Model:
    """Train on ``limit`` labelled documents of each class, the first by the hash of the id.

    Labels other than 0 and 1 and null ids are left out; an id labelled both ways has the larger label.
    The sample is the only thing that comes to the driver: at most limit x 2 x TRAIN_PASSAGES vectors.
    With one class only, every score is that label; without any label it is 0.5.
    """
    known = labels.select(F.col(doc_id).alias("_label_id"), F.col(label).cast("int").alias("label")).filter("label in (0, 1) and _label_id is not null")
    known = known.groupBy("_label_id").agg(F.max("label").alias("label"))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    known = known.join(own.select(F.col("doc_id").alias("_label_id")).distinct(), "_label_id", "left_semi")
    parts = [known.filter(F.col("label") == k).orderBy(F.xxhash64("_label_id"), "_label_id").limit(limit) for k in (0, 1)]
    sample = own.join(F.broadcast(parts[0].union(parts[1])), F.col("doc_id") == F.col("_label_id"))
    sample = sample.groupBy("doc_id", "label").agg(F.min_by(F.coalesce("text", F.lit("")), F.xxhash64("text")).alias("text"))
    rows = sorted(sample.select("doc_id", "label", "text").mapInArrow(_bags, "doc_id long, label int, x array<float>").collect())
    if not rows:
        return train(np.zeros((0, 1)), np.zeros(1, np.int64), np.zeros(0))
    width = encode(Words(np.zeros(0, np.uint8), np.zeros(2, np.int64), NOT_SPACE, False))[0].shape[1]
    bags = [np.array(r.x, float).reshape(-1, width) for r in rows]
    first = np.concatenate(([0], np.cumsum([len(b) for b in bags])))
    return train(np.concatenate(bags), first, np.array([r.label for r in rows], float))


def scored(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 in column ``out``; every passage of every whole text is read.

    Null and empty texts are one empty passage. All columns are kept, and repeated rows score alike.
    """
    place = docs.columns.index(text)

    def add(batches):
        for batch in batches:
            found = [model.score(*encode(words)) for _, _, words in chunked(batch.column(place), NOT_SPACE)]
            values = pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns)), values], names=[*batch.schema.names, out])

    return docs.mapInArrow(add, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{out}` double"]))


def held_out(doc_id: str) -> Column:
    return hashed_remainder(doc_id, 3) == 1


def good_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """``docs`` whose score is at least one half, with their own columns; trained on labels that are not held out."""
    model = fit(docs, labels.filter(~held_out(doc_id)), doc_id, text, label)
    own, name = apart(docs)
    return scored(own, model, name[text], "_quality_score").filter("_quality_score >= 0.5").select(*[F.col(n).alias(c) for c, n in name.items()])


@register("op3_attention_quality")
def op3_attention_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").filter(~held_out("doc_id")))
    found = scored(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score")
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
