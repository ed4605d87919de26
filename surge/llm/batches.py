"""Vectorised text primitives for Arrow batches inside Spark tasks.

Texts are handled as one UTF-8 byte array per slice of a batch: word borders
come from a byte table, word and shingle hashes from prefix sums, so there is
no Python loop per word.  A slice holds at most ``SLICE_BYTES`` of text (or one
longer document), which bounds the memory of a task whatever the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_MULT = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULT))

#: Byte tables: ASCII lower-casing; white space U+0020, U+0009-U+000D.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Everything but ASCII letters, digits and bytes of multi-byte characters.
NOT_WORD = np.ones(256, dtype=bool)
NOT_WORD[48:58] = NOT_WORD[65:91] = NOT_WORD[97:123] = NOT_WORD[128:] = False

_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        inverse = pow(_MULT, -1, 1 << 64)
        for key, base in (("up", _MULT), ("down", inverse)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            table = np.multiply.accumulate(p)
            if size <= 4 * SLICE_BYTES:
                _POWERS[key] = table
            elif key == "up":
                up = table
            else:
                return up, table
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Texts:
    """The texts of a slice as bytes; ``offs`` has the borders of documents."""

    def __init__(self, column: pa.Array, lower: bool = True):
        column = pc.fill_null(column.cast(pa.large_string()), "")
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        n, at = len(column), column.offset
        _, offsets, data = column.buffers()
        if n == 0:
            self.offs = np.zeros(1, dtype=np.int64)
        else:
            self.offs = np.frombuffer(offsets, dtype=np.int64)[at:at + n + 1]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        raw = raw[self.offs[0]:self.offs[-1]]
        self.offs = self.offs - self.offs[0]
        self.data = LOWER[raw] if lower else raw
        self.n = n

    @staticmethod
    def shingle_codes(words: np.ndarray, k: int) -> np.ndarray:
        """Distinct shingle hashes of one sequence of word hashes, as ``Words.shingles`` makes them."""
        n = len(words)
        if n < k:
            return words[:0]
        h = words[:n - k + 1].copy()
        for j in range(1, k):
            h = mix64(h * np.uint64(_MULT) + words[j:n - k + 1 + j])
        return np.unique(h)

    def words(self, separators: np.ndarray = SPACE) -> "Words":
        return Words(self, separators)


class Words:
    """Word borders: ``starts``/``ends`` in bytes, ``first[d]:first[d+1]`` of document d."""

    def __init__(self, texts: Texts, separators: np.ndarray):
        data, offs = texts.data, texts.offs
        self.texts = texts
        if len(data) == 0:
            self.starts = self.ends = np.zeros(0, dtype=np.int64)
            self.first = np.zeros(len(offs), dtype=np.int64)
            return
        gap = separators[data]
        before = np.empty(len(gap), dtype=bool)
        before[0] = True
        before[1:] = gap[:-1]
        heads = offs[:-1][np.diff(offs) > 0]
        before[heads] = True
        after = np.empty(len(gap), dtype=bool)
        after[-1] = True
        after[:-1] = gap[1:]
        after[offs[1:][np.diff(offs) > 0] - 1] = True
        self.starts = np.flatnonzero(~gap & before)
        self.ends = np.flatnonzero(~gap & after) + 1
        self.first = np.searchsorted(self.starts, offs)

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word's bytes."""
        data = self.texts.data
        if len(self.starts) == 0:
            return np.zeros(0, dtype=np.uint64)
        up, down = _powers(len(data) + 1)
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODES[data] * up[:len(data)], out=total[1:])
        return mix64((total[self.ends] - total[self.starts]) * down[self.starts])

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, hash) of every run of k words; a document with 1..k-1 words has one, of all its words."""
        w, first = self.hashes(), self.first
        counts = np.diff(first)
        doc = np.repeat(np.arange(len(counts)), counts)
        if len(w) == 0:
            return doc, w
        h = w.copy()
        length = len(w)
        for j in range(1, k):
            shifted = np.zeros(length, dtype=np.uint64)
            shifted[:length - j] = w[j:]
            h = mix64(h * np.uint64(_MULT) + shifted)
        left = first[1:][doc] - np.arange(length)
        whole = left >= k
        short = np.flatnonzero((counts > 0) & (counts < k))
        if len(short):
            heads = first[:-1][short]
            value = w[heads]
            for j in range(1, k):
                more = counts[short] > j
                step = mix64(value * np.uint64(_MULT) + w[np.minimum(heads + j, length - 1)])
                value = np.where(more, step, value)
            h[heads] = mix64(value + counts[short].astype(np.uint64))
            whole[heads] = True
        return doc[whole], h[whole]


def distinct_sorted(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (doc, value) pairs, sorted."""
    order = _order(doc, value)
    doc, value = doc[order], value[order]
    same = doc[1:] == doc[:-1]
    keep = np.ones(len(doc), dtype=bool)
    keep[1:] = ~same | (value[1:] != value[:-1])
    return doc[keep], value[keep]


def _order(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Order by (doc, value): one sort of words that hold doc, the upper bits of the value and the place."""
    n = len(doc)
    low = n.bit_length()
    high = int(doc.max(initial=0)).bit_length()
    if not 0 < high <= 62 - low:  # one document, or too many for a word
        return np.lexsort((value, doc))
    key = doc.astype(np.uint64) << np.uint64(64 - high) | value >> np.uint64(high + low) << np.uint64(low) | np.arange(n, dtype=np.uint64)
    key.sort()
    order = (key & np.uint64((1 << low) - 1)).astype(np.int64)
    first, then = order[:-1], order[1:]
    if ((doc[first] == doc[then]) & (value[first] > value[then])).any():  # values that differ in lower bits only
        return np.lexsort((value, doc))
    return order


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds at most ``limit`` bytes of text, or one row."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.cumsum(size)
    at = 0
    while at < batch.num_rows:
        base = upto[at - 1] if at else 0
        end = int(np.searchsorted(upto, base + limit, side="right"))
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType = pa.int64()) -> pa.ListArray:
    """A list column from flat values and the length of each list."""
    offs = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(values, type=kind))


def blobs(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, type=pa.binary())
