"""Codes of words, hashes of runs of words, and groups of equal runs.

``word_codes`` depends on the word's bytes alone, so codes of different tasks agree; two words
may share one by chance.  ``distinct_codes`` tells whether any do, and ``numbered`` gives codes
that never do; ``equal_runs`` compares runs code by code.
"""

from __future__ import annotations

import numpy as np
from xxhash import xxh64_intdigest

from parcelle.llm.words import Words, mix64

#: Words beyond so many bytes are hashed and compared one by one.
LONG_WORD = 256
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << 8 * b) - 1 for b in range(9)], np.uint64)


class _Chunks:
    """Eight bytes from any place of ``data``, those behind a word's end set to zero."""

    def __init__(self, w: Words):
        padded = np.concatenate([w.data, np.zeros(8, np.uint8)])
        self.at = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
        self.starts, self.lens = w.starts, w.ends - w.starts

    def get(self, words: np.ndarray, c: int) -> np.ndarray:
        return self.at[self.starts[words] + c] & _MASKS[np.minimum(self.lens[words] - c, 8)]


def word_codes(w: Words) -> np.ndarray:
    """A 64-bit code of each word, a function of its bytes."""
    chunks = _Chunks(w)
    codes = chunks.lens.astype(np.uint64) * _MIX
    live, c = np.flatnonzero(chunks.lens <= LONG_WORD), 0
    while len(live):
        codes[live] = mix64(codes[live] ^ chunks.get(live, c))
        c += 8
        live = live[chunks.lens[live] > c]
    for i in np.flatnonzero(chunks.lens > LONG_WORD):
        codes[i] = xxh64_intdigest(w.data[w.starts[i]:w.ends[i]].tobytes())
    return codes


def _same_words(w: Words, chunks: _Chunks, a: np.ndarray, b: np.ndarray) -> bool:
    if (chunks.lens[a] != chunks.lens[b]).any():
        return False
    big = chunks.lens[a] > LONG_WORD
    for i, j in zip(a[big], b[big]):
        if not np.array_equal(w.data[w.starts[i]:w.ends[i]], w.data[w.starts[j]:w.ends[j]]):
            return False
    a, b, c = a[~big], b[~big], 0
    while len(a):
        if (chunks.get(a, c) != chunks.get(b, c)).any():
            return False
        c += 8
        more = chunks.lens[a] > c
        a, b = a[more], b[more]
    return True


def distinct_codes(w: Words, codes: np.ndarray, which: np.ndarray) -> bool:
    """Whether different words among those of the places ``which`` have different codes:
    each is compared with one representative of its code."""
    chunks = _Chunks(w)
    size = 1 << max(4, (2 * len(which)).bit_length())
    rep, todo = np.empty(size, np.int64), which
    while len(todo):
        slot = (codes[todo] & np.uint64(size - 1)).astype(np.int64)
        rep[slot] = todo
        first = rep[slot]
        met = codes[first] == codes[todo]
        if not _same_words(w, chunks, todo[met], first[met]):
            return False
        todo = todo[~met]
    return True


def numbered(w: Words) -> np.ndarray:
    """Codes from a dictionary of the words: exact by themselves, and good within this call only."""
    seen: dict[bytes, int] = {}
    return mix64(np.array([seen.setdefault(w.data[s:e].tobytes(), len(seen)) for s, e in zip(w.starts, w.ends)], np.uint64))


def run_hash(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive codes (n - k + 1 entries), from runs of doubled length."""
    n = len(codes)
    if n < k:
        return np.empty(0, np.uint64)
    out, have, level, width = None, 0, codes, 1
    while True:
        if k & 1:
            if out is None:
                out = level
            else:
                m = n - have - width + 1
                out = mix64(out[:m] * _MIX + level[have:have + m])
            have += width
        k >>= 1
        if not k:
            return out
        level = mix64(level[:-width] * _MIX + level[width:])
        width *= 2


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Smallest of every ``w`` consecutive values (n - w + 1 entries)."""
    if len(x) < w:
        return x[:0]
    width = 1
    while 2 * width <= w:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    return np.minimum(x[:len(x) - (w - width)], x[w - width:]) if w > width else x


def equal_runs(codes: np.ndarray, at: np.ndarray, k: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``codes[p:p + k]`` of the places ``at``, sorted so that equal ones are neighbours; ``hashes``: ``run_hash(codes, k)`` if at hand.

    Returns (order, new): ``at[order]`` is sorted and ``new`` marks the first of each group.
    Runs are sorted by hash and neighbours of one hash compared code by code; where they differ,
    the runs of that hash are sorted by the codes themselves."""
    h = (run_hash(codes, k) if hashes is None else hashes)[at]
    order = np.argsort(h, kind="stable")
    new = np.ones(len(at), bool)
    if len(at) < 2:
        return order, new
    h = h[order]

    def compare():
        place = at[order]
        pairs = np.flatnonzero(h[1:] == h[:-1])
        same = np.ones(len(pairs), bool)
        for j in range(k):
            same &= codes[place[pairs] + j] == codes[place[pairs + 1] + j]
        return pairs, same

    pairs, same = compare()
    if not same.all():
        mixed = np.flatnonzero(np.isin(h, h[pairs[~same]]))
        place = at[order[mixed]]
        order[mixed] = order[mixed][np.lexsort([codes[place + j] for j in range(k)] + [h[mixed]])]
        pairs, same = compare()
    new[pairs[same] + 1] = False
    return order, new
