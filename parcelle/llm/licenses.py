"""License scans (operator 8): exact set-similarity join of license templates and text blocks.

Base: the places where a phrase's words stand consecutively.  Method: a text's blocks are its
paragraphs (``wrapped``: a notice may run over several lines; a line without words, a bare comment mark too, ends
one) or its lines, cut further after sentence ends; a block matches a template if it holds at least
``threshold`` of the template's distinct words (containment).  Tokens are ordered by their frequency over all
blocks, rarest first.  Of a template with n tokens that needs o = ceil(threshold * n) of them, any matching
block holds one of the n - o + 1 rarest (prefix filter); it has at least o template tokens at
all (length filter); and from the first shared prefix token on, enough tokens must remain on both sides
(positional filter).  What passes is verified by its exact overlap, so the join is exact.

The templates are a fixed parameter of a few hundred words; the frequencies come from one pass over
all documents (a row per token and task leaves the scan), the join itself needs no shuffle: every block is
a query against the templates.

Defined results: null and empty texts have no words, no labels and score 0; null ids and repeated rows
are scanned like others; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.words import LETTERS, Texts, hash_word, slices

#: Base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Sentences by which licenses are granted, with the label that a matching block adds.
TEMPLATES = [
    ("gpl-notice", "this work is licensed under the gnu general public license version 3"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl-notice", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("apache-notice", "licensed under the apache license version 2 0"),
    ("apache-notice", "you may not use this file except in compliance with the license"),
    ("mit-notice", "released under the mit license"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc-notice", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-notice", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc-notice", "licensed under cc by nc 4 0"),
    ("cc-by-sa-notice", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("unlicense-notice", "this is free and unencumbered software released into the public domain"),
]
THRESHOLD = 0.85


def blocks(t: Texts, w, wrapped: bool = False) -> np.ndarray:
    """Block number of every word: a new one for each text, line (``wrapped``: paragraph) and sentence."""
    data = t.data
    m = len(data)
    if not m or not len(w.starts):
        return np.empty(0, np.int64)
    line = data == 0x0A
    stop = (data == 0x2E) | (data == 0x21) | (data == 0x3F)
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    stop[:-1] &= space[1:]
    lines, ends = np.cumsum(line)[w.starts], np.cumsum(stop)[w.starts]
    new = np.concatenate([[True], (np.diff(lines) > int(wrapped)) | (np.diff(ends) > 0) | (w.doc[1:] != w.doc[:-1])])
    return np.cumsum(new) - 1


class Index:
    """Templates over one token table; ``order``: rank of each token, rarest first."""

    def __init__(self, templates, threshold: float = THRESHOLD):
        self.labels = [label for label, _ in templates]
        sets = [sorted(set(text.split())) for _, text in templates]
        self.tokens = sorted({w for s in sets for w in s})
        at = {w: i for i, w in enumerate(self.tokens)}
        self.sets = [[at[w] for w in s] for s in sets]
        self.need = [max(1, math.ceil(threshold * len(s) - 1e-9)) for s in sets]
        h = np.array([hash_word(w) for w in self.tokens], np.uint64)
        self.sorted = np.argsort(h)
        self.hashes = h[self.sorted]
        self.member = np.zeros((len(self.tokens), len(sets)), np.int64)
        for j, s in enumerate(self.sets):
            self.member[s, j] = 1

    def ids(self, h: np.ndarray) -> np.ndarray:
        """Token number of every word hash, -1 for words in no template."""
        i = np.searchsorted(self.hashes, h)
        i[i == len(self.hashes)] = 0
        return np.where(self.hashes[i] == h, self.sorted[i], -1)

    def ranked(self, counts: np.ndarray) -> Index:
        """With the global order, and each template's prefix and places in that order."""
        self.rank = np.empty(len(self.tokens), np.int64)
        self.rank[np.lexsort((np.arange(len(self.tokens)), counts))] = np.arange(len(self.tokens))
        self.prefix = np.zeros_like(self.member, dtype=bool)
        self.place = np.zeros_like(self.member)
        for j, s in enumerate(self.sets):
            s = sorted(s, key=lambda i: self.rank[i])
            self.place[s, j] = np.arange(len(s))
            self.prefix[s[:len(s) - self.need[j] + 1], j] = True
        self.any_prefix = self.prefix.any(1)
        return self

    def match(self, block: np.ndarray, token: np.ndarray):
        """(block, template, containment) of every block that reaches a template's threshold."""
        none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        hit = np.unique(block[self.any_prefix[token]])
        if not len(hit):
            return none
        use = np.isin(block, hit)
        pairs = np.unique(np.stack([block[use], self.rank[token[use]]]), axis=1)  # distinct tokens, rarest first in each block
        own, rank = pairs
        by_rank = np.argsort(self.rank)
        tok = by_rank[rank]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        size = np.diff(np.concatenate([first, [len(own)]]))
        where = np.arange(len(own)) - np.repeat(first, size)
        which = np.repeat(np.arange(len(first)), size)
        out = []
        for j, need in enumerate(self.need):
            n = len(self.sets[j])
            seen = np.flatnonzero(self.prefix[tok, j])
            if not len(seen):
                continue
            b, at = np.unique(which[seen], return_index=True)
            at = seen[at]  # the first shared prefix token of each block
            left = 1 + np.minimum(n - self.place[tok[at], j] - 1, size[b] - where[at] - 1)
            b = b[(size[b] >= need) & (left >= need)]
            shared = np.add.reduceat(self.member[tok, j], first)[b]
            ok = shared >= need
            out.append((own[first[b[ok]]], np.full(int(ok.sum()), j), shared[ok] / n))
        return tuple(map(np.concatenate, zip(*out))) if out else none


def token_counts(docs: DataFrame, text_col: str, index: Index, wrapped: bool = False) -> np.ndarray:
    """Blocks that hold each template token, over all of ``docs``."""
    def count(batches):
        n = np.zeros(len(index.tokens), np.int64)
        for b in batches:
            for t in slices(b.column(0)):
                w = t.words(LETTERS)
                ids = index.ids(w.hashes())
                use = ids >= 0
                key = np.unique(blocks(t, w, wrapped)[use] * len(index.tokens) + ids[use])
                n += np.bincount(key % len(index.tokens), minlength=len(index.tokens))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n))), pa.array(n)], names=["token", "n"])

    rows = docs.select(text_col).mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()  # a row per token
    counts = np.zeros(len(index.tokens), np.int64)
    for r in rows:
        counts[r["token"]] = r["n"]
    return counts


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict = PHRASES, templates=TEMPLATES, threshold: float = THRESHOLD,
         wrapped: bool = False) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (highest containment that reached the threshold, else 0)."""
    index = Index(templates, threshold)
    index.ranked(token_counts(docs, text_col, index, wrapped))
    base = [([hash_word(x) for x in p.split()], label) for p, label in phrases.items()]

    def run(batches):
        for b in batches:
            for t in slices(b.column(1)):
                w = t.words(LETTERS)
                h = w.hashes()
                n_words = np.diff(w.at)
                n_base, first, last = np.zeros(t.n, np.int64), np.full(t.n, np.iinfo(np.int64).max), np.full(t.n, -1)
                found: dict[int, set] = {}
                for words, label in base:
                    k, m = len(words), len(h) - len(words) + 1
                    if m <= 0:
                        continue
                    ok = w.doc[:m] == w.doc[k - 1:]
                    for j, x in enumerate(words):
                        ok &= h[j:m + j] == np.uint64(x)
                    at = np.flatnonzero(ok)
                    d = w.doc[at]
                    n_base += np.bincount(d, minlength=t.n)
                    np.minimum.at(first, d, at - w.at[d])
                    np.maximum.at(last, d, at - w.at[d])
                    for i in np.unique(d).tolist():
                        found.setdefault(i, set()).add(label)
                own = blocks(t, w, wrapped)
                ids = index.ids(h)
                use = ids >= 0
                bl, tm, share = index.match(own[use], ids[use])
                doc_of = w.doc[np.searchsorted(own, bl)] if len(bl) else bl
                score = np.zeros(t.n)
                np.maximum.at(score, doc_of, share)
                more: dict[int, set] = {}
                for i, j in zip(doc_of.tolist(), tm.tolist()):
                    more.setdefault(i, set()).add(index.labels[j])
                join = lambda s: ",".join(sorted(s))
                none = n_base == 0
                part = b.slice(t.first, t.n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_words.astype(np.int64)), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none),
                     pa.array([join(found.get(i, ())) for i in range(t.n)]), pa.array([join(found.get(i, set()) | more.get(i, set())) for i in range(t.n)]), pa.array(score)],
                    names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).alias("_t")).mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
