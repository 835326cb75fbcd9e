"""Words of Arrow text columns as numpy arrays: bounds, 64-bit hashes, hashes of word sequences."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 1 << 20


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    """A table that is True for the bytes inside the spans."""
    table = np.zeros(256, dtype=bool)
    for low, high in spans:
        table[low : high + 1] = True
    return table


#: Everything but space, tab, line feed, vertical tab, form feed and carriage return.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Lower-case letters, digits and every character beyond ASCII.
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)
FACTOR = np.uint64(0x9E3779B97F4A7C15)
SHORT = 64  # bytes of a word that are hashed by whole arrays


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a text column; nulls become empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if isinstance(texts, pa.ChunkedArray):  # no chunk at all
        texts = pa.array([], pa.string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), bounds


class Words:
    """Words of some consecutive texts. Word i is data[starts[i]:ends[i]]; text t has words first[t] to first[t + 1]."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, inside: np.ndarray, lower: bool):
        self.data = LOWER[data] if lower else data
        member = inside[self.data]
        size = len(member)
        edge = np.zeros(size + 1, dtype=bool)
        edge[bounds] = True
        before = np.zeros(size, dtype=bool)
        before[1:] = member[:-1]
        before &= ~edge[:-1]
        after = np.zeros(size, dtype=bool)
        after[:-1] = member[1:]
        after &= ~edge[1:]
        self.starts = np.flatnonzero(member & ~before)
        self.ends = np.flatnonzero(member & ~after) + 1
        self.first = np.searchsorted(self.starts, bounds)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: its length, then eight bytes at a time, mixed after each; XXH64 of words above SHORT bytes.

        Equally long words of up to eight bytes never share a hash, as every step is a bijection.
        """
        lengths = self.ends - self.starts
        padded = np.zeros(len(self.data) + 8, np.uint8)
        padded[: len(self.data)] = self.data
        eights = np.ndarray(len(self.data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each byte on
        out = lengths.astype(np.uint64)
        active = np.flatnonzero(lengths <= SHORT)
        for done in range(0, SHORT, 8):
            active = active[lengths[active] > done]
            if not len(active):
                break
            beyond = np.maximum(8 - (lengths[active] - done), 0).astype(np.uint64)
            value = eights[self.starts[active] + done] & (~np.uint64(0) >> (np.uint64(8) * beyond))
            out[active] = mix((out[active] * FACTOR) ^ value)
        for i in np.flatnonzero(lengths > SHORT):
            out[i] = xxhash.xxh64_intdigest(self.word(i))
        return out

    def text_of(self) -> np.ndarray:
        """The number of the text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def chunked(texts: pa.Array, inside: np.ndarray = NOT_SPACE, lower: bool = False, limit: int = CHUNK_BYTES):
    """(first row, row behind the last, Words) for runs of texts of about `limit` bytes; a longer text is alone."""
    data, bounds = buffers(texts)
    low, rows = 0, len(bounds) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + limit, side="right")) - 1)
        part = bounds[low : high + 1]
        yield low, high, Words(data[part[0] : part[-1]], part - part[0], inside, lower)
        low = high


def sequences(hashes: np.ndarray, length: int, factor: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """The hash of each run of `length` consecutive numbers, at the run's start."""
    count = max(0, len(hashes) - length + 1)
    out, step = np.zeros(count, np.uint64), np.uint64(factor)
    for k in range(length):
        out = out * step + hashes[k : k + count]
    return mix(out)


def whole_runs(first: np.ndarray, length: int, count: int) -> np.ndarray:
    """True at the starts, of `count` possible ones, whose run of `length` words stays inside one text."""
    marks = np.zeros(count + length + 1, np.int64)
    sizes = np.maximum(np.diff(first) - length + 1, 0)
    np.add.at(marks, first[:-1], sizes > 0)
    np.add.at(marks, first[:-1] + sizes, -(sizes > 0).astype(np.int64))
    return np.cumsum(marks)[:count] > 0


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
