"""Quality rules (operator 9): base counts, and line labels by a linear-chain CRF.

Base: counts of words, symbols, repeated lines and words in repeated 3-word windows.  Method: every line
with a word is content or boilerplate; a linear-chain conditional random field over binary line
features (length, symbols, bars, case, repeats, end mark, word shape) scores the labels of a
text's lines together and Viterbi decoding finds the best sequence.  A document is kept if it passes the base
rules and content lines hold at least ``share`` of its word characters.

The field is trained here by gradient ascent on its conditional log-likelihood (forward-backward).  Its sequences
have labels that change inside a text: a run of content lines (documents of quality 1) stands between a head and
a foot of boilerplate lines (documents of quality 0), beside runs of one kind alone.  It learns from at most
``fit_docs`` labelled documents of each class, those with the smallest hash of their id, and of these from at most
``fit_runs`` runs of ``RUN_LINES`` lines a class, picked by hash from all places of the texts (documented bounds of
the training sample); scoring reads every line of every document.

Defined results: null and empty texts have no words and fail the base rules; null ids and repeated
rows are judged like others; without labels of both classes every line is content; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelle.llm.words import Texts, mix64, shingle_hashes, slices

FIT_DOCS, FIT_RUNS, RUN_LINES = 1500, 3000, 64
EDGE_LINES = 4  # a head or foot of a training sequence has at most as many
SHARE = 0.5
N_FEATURES = 18
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_STOP = np.isin(np.arange(256), np.frombuffer(b".!?", np.uint8))


def lines_of(t: Texts, w):
    """Lines with a word: text of each, first word, and each word's line; bits of the features of each line."""
    data = w.data
    newline = np.concatenate([[0], np.cumsum(data == 0x0A)])
    own = newline[w.starts]
    new = np.concatenate([[True], (own[1:] != own[:-1]) | (w.doc[1:] != w.doc[:-1])]) if len(own) else np.empty(0, bool)
    first = np.flatnonzero(new)
    line = np.cumsum(new) - 1
    return w.doc[first], first, line, newline


def line_spans(t: Texts, doc: np.ndarray, first: np.ndarray, w):
    """Start and end byte of each of these lines, whole (white space included)."""
    marks = np.flatnonzero(t.data == 0x0A)
    i = np.searchsorted(marks, w.starts[first])
    start = np.where(i > 0, marks[np.maximum(i - 1, 0)] + 1 if len(marks) else 0, 0)
    end = np.where(i < len(marks), marks[np.minimum(i, len(marks) - 1)] if len(marks) else 0, len(t.data))
    return np.maximum(start, t.off[doc]), np.minimum(end, t.off[doc + 1])


def _sums(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    c = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
    return c[b] - c[a]


def earlier_equal(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """True for a line equal to an earlier line of its text."""
    key = mix64(h + mix64(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key), bool)
    s = key[order]
    same[order[1:]] = s[1:] == s[:-1]
    return same


def measure(t: Texts) -> dict[str, np.ndarray]:
    """Counts by text, and of its lines: text, word characters and features."""
    from parcelle.llm.words import hash_spans
    w = t.words(lower=False)
    h = w.hashes()
    lead = (t.data & 0xC0) != 0x80  # first bytes of code points
    chars = _sums(lead, w.starts, w.ends)
    out = {"n_words": np.diff(w.at), "word_chars": np.bincount(w.doc, weights=chars, minlength=t.n).astype(np.int64),
           "n_symbols": _sums(_SYMBOL[t.data], t.off[:-1], t.off[1:])}
    doc, first, line, _ = lines_of(t, w)
    a, b = line_spans(t, doc, first, w)
    dup = earlier_equal(doc, hash_spans(t.data, a, b))
    out["n_dup_lines"] = np.bincount(doc[dup], minlength=t.n)
    g, at = shingle_hashes(h, w.doc, 3)
    key = mix64(g + mix64(w.doc[at].astype(np.uint64) + np.uint64(1)))
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    again = at[count[inverse] > 1]
    covered = np.zeros(len(h), bool)
    for j in range(3):
        covered[again + j] = True
    out["n_repeat_words"] = np.bincount(w.doc[covered], minlength=t.n)
    n = np.bincount(line, minlength=len(doc))
    per = lambda x: np.bincount(line, weights=x, minlength=len(doc)) / np.maximum(n, 1)
    mean_chars, repeats = per(chars), per(covered)
    same = np.concatenate([[False], (h[1:] == h[:-1]) & (line[1:] == line[:-1])])
    stutter = per(same)
    symbols, bars = _sums(_SYMBOL[t.data], a, b) / np.maximum(n, 1), _sums(t.data == 0x7C, a, b) / np.maximum(n, 1)
    marks = _sums((t.data == 0x21) | (t.data == 0x3F), a, b) / np.maximum(n, 1)
    capital = _sums((t.data >= 0x41) & (t.data <= 0x5A), a, b) / np.maximum(b - a, 1)
    digits = _sums((t.data >= 0x30) & (t.data <= 0x39), a, b) / np.maximum(b - a, 1)
    last = _STOP[t.data[w.ends[np.concatenate([first[1:], [len(h)]]) - 1] - 1]] if len(first) else np.empty(0, bool)
    bits = [np.ones(len(doc), bool), n < 4, (n >= 4) & (n < 12), n >= 40, symbols == 0, symbols > 0.1, symbols > 0.5, bars > 0.1, bars > 0.3, capital > 0.3, capital > 0.6,
            digits > 0.2, dup, repeats > 0.3, stutter > 0.1, marks > 0.5, last, mean_chars < 2.5]
    out["lines"] = (doc, np.bincount(line, weights=chars, minlength=len(doc)), np.stack(bits, 1).astype(np.float64) if len(doc) else np.zeros((0, N_FEATURES)))
    return out


def viterbi(score: np.ndarray, at: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best labels of many sequences: ``score`` (lines, 2), sequence i is lines at[i] .. at[i + 1]; step by step over all at once."""
    lens = np.diff(at)
    out = np.zeros(len(score), np.int64)
    order = np.argsort(-lens, kind="stable")
    order = order[lens[order] > 0]
    if not len(order):
        return out
    start, size = at[:-1][order], lens[order]
    best = score[start].copy()
    back = np.zeros((len(score), 2), np.int8)
    for step in range(1, int(size[0])):
        m = int(np.searchsorted(-size, -step, "left"))  # sequences longer than step
        both = best[:m, :, None] + trans[None]
        back[start[:m] + step] = both.argmax(1)
        best[:m] = both.max(1) + score[start[:m] + step]
    now = best.argmax(1)
    out[start + size - 1] = now
    for step in range(int(size[0]) - 1, 0, -1):
        m = int(np.searchsorted(-size, -step, "left"))
        at_step = start[:m] + step
        out[at_step - 1] = back[at_step, out[at_step]]
    return out


def train(x: np.ndarray, y: np.ndarray, at: np.ndarray, rounds: int = 120, rate: float = 0.5, l2: float = 1e-3):
    """Weights (features, 2) and transitions (2, 2) by gradient ascent; sequences as in ``viterbi``."""
    w, trans = np.zeros((x.shape[1], 2)), np.zeros((2, 2))
    lens = np.diff(at)
    order = np.argsort(-lens, kind="stable")
    order = order[lens[order] > 0]
    start, size = at[:-1][order], lens[order]
    longest = int(size[0])
    live = [int(np.searchsorted(-size, -s, "left")) for s in range(longest)]  # sequences longer than s
    seen = np.zeros((x.shape[1], 2))
    for k in (0, 1):
        seen[:, k] = x[y == k].sum(0)
    inner = np.ones(len(y), bool)
    inner[at[:-1][lens > 0]] = False
    later = np.flatnonzero(inner)
    seen_t = np.zeros((2, 2))
    np.add.at(seen_t, (y[later - 1], y[later]), 1)
    for _ in range(rounds):
        s = x @ w
        e = np.exp(s - s.max(1, keepdims=True))
        t = np.exp(trans)
        f, b = np.zeros_like(e), np.ones_like(e)
        f[start] = e[start] / e[start].sum(1, keepdims=True)
        for step in range(1, longest):
            i = start[:live[step]] + step
            v = (f[i - 1] @ t) * e[i]
            f[i] = v / v.sum(1, keepdims=True)
        for step in range(longest - 1, 0, -1):
            i = start[:live[step]] + step
            v = (b[i] * e[i]) @ t.T
            b[i - 1] = v / v.sum(1, keepdims=True)
        p = f * b
        p /= p.sum(1, keepdims=True)
        pair = f[later - 1][:, :, None] * t[None] * (e[later] * b[later])[:, None, :]
        pair /= pair.sum((1, 2), keepdims=True)
        w += rate * ((seen - x.T @ p) / len(y) - l2 * w)
        trans += rate * ((seen_t - pair.sum(0)) / len(y) - l2 * trans)
    return w, trans


def stitched(content: list[np.ndarray], boilerplate: list[np.ndarray]):
    """Line codes, labels (0 content) and offsets of the training sequences: of four content runs one stands alone, one
    has a head, one a foot, one both, 1 to ``EDGE_LINES`` lines each; then every boilerplate run alone."""
    parts, labels, lens = [], [], []
    for i, run in enumerate(content):
        head, foot = boilerplate[i % len(boilerplate)], boilerplate[-1 - i % len(boilerplate)]
        n = 1 + i // 4 % EDGE_LINES
        pieces = [(head[:n], 1)] * (i & 1) + [(run, 0)] + [(foot[-n:], 1)] * (i >> 1 & 1)
        parts += [p for p, _ in pieces]
        labels += [np.full(len(p), y) for p, y in pieces]
        lens.append(sum(len(p) for p, _ in pieces))
    parts += boilerplate
    labels += [np.ones(len(p), np.int64) for p in boilerplate]
    lens += [len(p) for p in boilerplate]
    return np.concatenate(parts), np.concatenate(labels), np.concatenate([[0], np.cumsum(lens)])


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, fit_docs: int = FIT_DOCS, fit_runs: int = FIT_RUNS):
    """Weights of the field, all zero without labels of both classes."""
    from parcelle.llm.importance import labelled
    sample = labelled(labels, fit_docs).toPandas()  # at most 2 * fit_docs rows
    none = np.zeros((N_FEATURES, 2)), np.zeros((2, 2))
    if sample["good"].nunique() < 2:
        return none
    good = dict(zip(sample["doc_id"].tolist(), sample["good"].tolist()))

    def runs(batches):
        for b in batches:
            keep = [i for i, d in enumerate(b.column(0).to_pylist()) if d in good]
            b = b.take(pa.array(keep, pa.int64()))
            for t in slices(b.column(1)):
                doc, _, x = measure(t)["lines"]
                code = (x.astype(np.int64) << np.arange(N_FEATURES)).sum(1)
                cut = np.searchsorted(doc, np.arange(t.n + 1))
                at = [(t.first + k, r, i, min(i + RUN_LINES, cut[k + 1])) for k in range(t.n) for r, i in enumerate(range(cut[k], cut[k + 1], RUN_LINES))]
                ids = [b.column(0)[k].as_py() for k, *_ in at]
                yield pa.RecordBatch.from_arrays([pa.array([good[d] for d in ids], pa.int64()), pa.array(ids, pa.int64()), pa.array([r for _, r, _, _ in at], pa.int64()),
                                                  pa.array([code[i:j].tolist() for *_, i, j in at], pa.list_(pa.int64()))], names=["good", "doc_id", "run", "code"])

    few = F.col("doc_id").isin(list(good)) if len(good) <= 50 else F.lit(True)
    order = Window.partitionBy("good").orderBy(F.xxhash64("doc_id", "run"), "doc_id", "run", "code")
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_t")).filter(few)
            .mapInArrow(runs, "good long, doc_id long, run long, code array<long>").distinct()
            .withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= fit_runs)
            .select("good", "_n", "code").collect())  # at most 2 * fit_runs rows of RUN_LINES numbers
    content, boilerplate = ([np.array(r["code"], np.int64) for r in sorted(rows, key=lambda r: r["_n"]) if r["good"] == g] for g in (1, 0))
    if not content or not boilerplate:
        return none
    code, y, at = stitched(content, boilerplate)
    return train((code[:, None] >> np.arange(N_FEATURES) & 1).astype(np.float64), y, at)


def label_lines(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, line (among the lines with a word, from 0), boilerplate, for every such line of every text."""
    w, trans = fit(docs, labels, id_col, text_col)

    def run(batches):
        for b in batches:
            for t in slices(b.column(1)):
                doc, _, x = measure(t)["lines"]
                at = np.searchsorted(doc, np.arange(t.n + 1))
                label = viterbi(x @ w, at, trans)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(t.first + doc)), pa.array(np.arange(len(doc)) - at[doc]), pa.array(label == 1)],
                                                 names=["doc_id", "line", "boilerplate"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_t")).mapInArrow(run, "doc_id long, line long, boilerplate boolean")


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lines, content_share, kept."""
    w, trans = fit(docs, labels, id_col, text_col)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches):
        for b in batches:
            for t in slices(b.column(1)):
                m = measure(t)
                doc, chars, x = m["lines"]
                at = np.searchsorted(doc, np.arange(t.n + 1))
                label = viterbi(x @ w, at, trans)
                total = np.bincount(doc, weights=chars, minlength=t.n)
                content = np.bincount(doc, weights=chars * (label == 0), minlength=t.n) / np.maximum(total, 1)
                failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(t.first, t.n), *[pa.array(m[c].astype(np.int64)) for c in names], pa.array(failed),
                                                  pa.array(np.diff(at).astype(np.int64)), pa.array(content.astype(float)), pa.array(~failed & (content >= share))],
                                                 names=["doc_id", *names, "base_failed", "n_lines", "content_share", "kept"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_t")).mapInArrow(
        run, "doc_id long, " + ", ".join(f"{c} long" for c in names) + ", base_failed boolean, n_lines long, content_share double, kept boolean")
