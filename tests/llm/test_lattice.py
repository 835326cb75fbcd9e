import math
import random
import re
import zlib
from collections import Counter

import pytest

from corpusframe.llm import lattice
from llm.conftest import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def every_segmentation(word, logs):
    """Sum of the products over all segmentations, one by one."""
    text = "▁" + word

    def rest(at):
        if at == len(text):
            return 1.0
        total = 0.0
        for end in range(at + 1, len(text) + 1):
            piece = text[at:end]
            if piece in logs:
                total += math.exp(logs[piece]) * rest(end)
            elif end == at + 1:
                total += math.prod(math.exp(logs[f"\n{b:02X}"]) for b in piece.encode()) * rest(end)
        return total

    return math.log(rest(0))


def test_forward_sums_all_segmentations():
    logs = lattice.vocabulary()
    assert abs(sum(math.exp(x) for x in logs.values()) - 1) < 1e-9
    found = lattice.Lattice(logs)
    for word in ["a", "there", "tionable", "éclair", "𝄞x", "?!", "\x00", "</s>", "<0x41>"]:
        assert found.log(word) == pytest.approx(every_segmentation(word, logs), rel=1e-12)
    assert found.log("ab" * 20_000) < -1000  # no underflow


def test_expected_counts_add_up():
    found, counts = lattice.Lattice(lattice.vocabulary()), {}
    found.expect("there", 3.0, counts)
    assert sum(n * len(p) for p, n in counts.items()) == pytest.approx(3.0 * len("▁there"))


def sample():
    rng = random.Random(1)
    vocabulary = ["".join(rng.choices(["th", "er", "é", "in", "X"], k=rng.randint(1, 5))) for _ in range(150)]
    return [rng.choice([" ", "\n"]).join(rng.choices(vocabulary, k=rng.randint(1, 80))) for _ in range(80)] + [None, "", " \t", "A a A", "𝄞 日本 </s> <0x41>", "y" * 5000, "th " * 4000]


@pytest.mark.parametrize("block", [24 << 20, 500])
def test_query_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(lattice, "BLOCK_BYTES", block)
    texts = sample()
    frame = documents(spark, texts).selectExpr("*", "1 as block", "2 as h", "true as held_out")
    got = {r.doc_id: r for r in lattice.lattice_scores(frame, lattice.hashed_remainder("doc_id", 7) == 2).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))}
    words = [WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) for t in texts]
    count = Counter(w for i, own in enumerate(words) if not held[i] for w in [*own, lattice.END])
    n, v = sum(count.values()), len(count)
    logs, fitted = lattice.vocabulary(), {}
    model = lattice.Lattice(logs)
    for w, c in count.items():
        if w != lattice.END:
            model.expect(w, c, fitted)
    mass = {p: lattice.PRIOR * math.exp(x) + fitted.get(p, 0) for p, x in logs.items()}
    mass[lattice.END] += count[lattice.END]
    total = sum(mass.values())
    model = lattice.Lattice({p: math.log(m / total) for p, m in mass.items()})
    assert len(got) == len(texts)
    for i, own in enumerate(words):
        r, tokens = got[i], [*own, lattice.END]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(tokens), sum(count[t] > 0 for t in tokens), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[t] + 1) / (n + v + 1)) for t in tokens), rel=1e-9)
        want = (sum(model.log(w) for w in own) + math.log(mass[lattice.END] / total)) / math.log(10)
        assert r.score == pytest.approx(want, rel=1e-7)


def test_without_training_text(spark):
    docs = documents(spark, ["a b", None], [None, None])
    rows = lattice.lattice_scores(docs, lattice.F.lit(True)).collect()
    assert [(r.doc_id, r.train_tokens, r.n_known) for r in rows] == [(None, 0, 0)] * 2
    assert lattice.lattice_scores(docs.limit(0), lattice.F.lit(False)).count() == 0
