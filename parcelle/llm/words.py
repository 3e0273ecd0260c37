"""Vectorised words of a batch of texts: byte offsets, document index and 64-bit hash.

Texts are handled as their UTF-8 bytes, a few MB at a time whatever the batch
size, so a task's memory is bounded by its longest single text.  No word, line or
text is cut.  A null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20


def byte_class(keep) -> np.ndarray:
    """A 256-entry table of the bytes for which ``keep`` holds."""
    return np.array([bool(keep(b)) for b in range(256)])


#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing; upper case is listed for texts left as they are.
LETTERS = byte_class(lambda b: b >= 0x80 or chr(b).isalnum())
_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (public domain), element-wise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS = np.empty(0, np.uint64)


def multipliers(n: int) -> np.ndarray:
    """Odd pseudo-random multipliers by position, made by rule; longer words extend the table."""
    global _POWERS
    if n > len(_POWERS):
        size = max(256, 1 << (n - 1).bit_length())
        _POWERS = mix64(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return _POWERS


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit multilinear hash of ``data[start:end]`` for each span (all non-empty)."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lens = ends - starts
    first = np.cumsum(lens) - lens
    total = int(lens.sum())
    place = np.arange(total) - np.repeat(first, lens)
    at = place + np.repeat(starts, lens)
    r = multipliers(int(lens.max()))
    prod = (data[at].astype(np.uint64) + np.uint64(1)) * r[place]
    return mix64(np.add.reduceat(prod, first) + lens.astype(np.uint64))


def hash_word(word: str) -> int:
    """The hash that ``words`` gives this word."""
    b = np.frombuffer(word.encode(), np.uint8)
    return int(hash_spans(b, np.array([0]), np.array([len(b)]))[0])


@dataclass
class Texts:
    """Texts ``first .. first + n`` of a batch. ``data``: their bytes; ``off``: n + 1 offsets into them."""

    first: int
    n: int
    data: np.ndarray
    off: np.ndarray

    def words(self, keep: np.ndarray = NOT_SPACE, lower: bool = True) -> Words:
        low = _LOWER[self.data] if lower else self.data
        w = keep[low]
        m = len(w)
        starts = ends = np.empty(0, np.int64)
        if m:
            filled = self.off[:-1] < self.off[1:]
            before = np.empty(m, bool)
            before[0], before[1:] = False, w[:-1]
            before[self.off[:-1][filled]] = False
            after = np.empty(m, bool)
            after[-1], after[:-1] = False, w[1:]
            after[self.off[1:][filled] - 1] = False
            starts, ends = np.flatnonzero(w & ~before), np.flatnonzero(w & ~after) + 1
        doc = np.searchsorted(self.off, starts, "right") - 1
        return Words(low, starts, ends, doc, np.searchsorted(doc, np.arange(self.n + 1)))


@dataclass
class Words:
    """``doc``: index of each word's text; ``at``: each text's first word (n + 1 entries)."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    at: np.ndarray

    def hashes(self) -> np.ndarray:
        return hash_spans(self.data, self.starts, self.ends)

    def text(self, i: int) -> str:
        return self.data[self.starts[i]:self.ends[i]].tobytes().decode("utf-8", "replace")


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts of an Arrow column in runs of about ``limit`` bytes (a longer text makes its own run)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, values = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.empty(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield Texts(a, b - a, data[off[a]:off[b]], off[a:b + 1] - off[a])
        a = b


def shingle_hashes(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first position of every window of ``k`` words inside one text."""
    m = len(h) - k + 1
    if m <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.flatnonzero(doc[:m] == doc[k - 1:])
    r = multipliers(k)
    out = np.zeros(len(at), np.uint64)
    for j in range(k):
        out += h[at + j] * r[j]
    return mix64(out + np.uint64(k)), at
