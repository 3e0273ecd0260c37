"""Substring dedup against a count of all windows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from parcelle.llm import ngrams, superkmers
from parcelle.llm.words import Texts, NOT_SPACE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    count = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), kept))
    return sorted(out, key=str)


def make_rows(window, seed=3):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["é", "Ü", "naïve", "x" * 300, "日本", "a", "A"]
    passages = [r.choices(vocab, k=n) for n in (window - 1, window, window + 1, 3 * window, 8 * window)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(r.randrange(4)):
            parts += r.choices(vocab, k=r.randrange(3 * window)) + (r.choice(passages) if r.random() < 0.6 else [])
        rows.append((i, r.choice([" ", "\n", " \t ", "\r\n"]).join(parts)))
    own = r.choices(vocab, k=window)
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, " ".join(own + ["y"] + own)), (104, "z " * (2 * window)), (105, "q " * window),
             (None, " ".join(r.choices(vocab, k=2 * window))), (None, rows[0][1]), rows[1], rows[1], (106, " ".join(["no", "break"] * window)),
             (107, "nul\x00 \x00 " * window), (108, " ".join(r.choices(vocab, k=50 * window)))]
    return rows


def result(spark, rows, window):
    docs = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], "doc_id long, text string, _a string, n_words int").repartition(5)
    return sorted([tuple(x) for x in superkmers.remove_repeats(docs, window).collect()], key=str)


@pytest.mark.parametrize("window", [1, 3, 35])
def test_equals_window_count(spark, window):
    rows = make_rows(window)
    assert result(spark, rows, window) == brute(rows, window)


def test_hot_minimisers_are_split_level_by_level(spark, monkeypatch):
    """With a limit of a few bytes every minimiser is hot, down to whole windows; a common passage in many contexts."""
    r = random.Random(1)
    vocab = [f"v{i}" for i in range(500)]
    shared = r.choices(vocab, k=30)
    rows = [(i, " ".join(r.choices(vocab, k=r.randrange(40)) + shared + r.choices(vocab, k=r.randrange(40)))) for i in range(80)]
    rows += [(200 + i, " ".join(shared + shared)) for i in range(5)]
    monkeypatch.setattr(superkmers, "HOT_BYTES", 500)
    monkeypatch.setattr(superkmers, "BUCKET_BYTES", 2000)
    levels = []
    plain = superkmers._count
    monkeypatch.setattr(superkmers, "_count", lambda t, w, lv: levels.append(lv[0]) or plain(t, w, lv))
    assert result(spark, rows, 20) == brute(rows, 20)
    assert levels == [4, 16, 20]


def test_empty_table(spark):
    assert result(spark, [], 5) == []


def words_of(texts):
    data = [t.encode() for t in texts]
    off = np.cumsum([0] + [len(d) for d in data])
    return Texts(0, len(texts), np.frombuffer(b"".join(data), np.uint8), off).words(NOT_SPACE, lower=False)


def test_groups_are_exact_even_with_bad_hashes(monkeypatch):
    r = random.Random(5)
    texts = [" ".join(r.choices(["a", "b", "ab", "ba", "abcdefgh", "abcdefghi", "y" * 400, "y" * 399 + "z"], k=60)) for _ in range(8)]
    monkeypatch.setattr(ngrams, "word_codes", lambda w: (w.ends - w.starts).astype(np.uint64) % np.uint64(2))
    w = words_of(texts)
    assert not ngrams.distinct_codes(w, ngrams.word_codes(w), np.arange(len(w.doc)))
    codes = ngrams.numbered(w)
    assert ngrams.distinct_codes(w, codes, np.arange(len(w.doc)))
    said = [w.text(i) for i in range(len(codes))]
    assert len(set(zip(codes.tolist(), said))) == len(set(said)) == len(set(codes.tolist()))
    monkeypatch.setattr(ngrams, "run_hash", lambda c, k: np.zeros(len(c) - k + 1, np.uint64))
    at = np.arange(len(codes) - 3)
    order, new = ngrams.equal_runs(codes, at, 4)
    group = np.cumsum(new)
    runs = [tuple(said[i:i + 4]) for i in at[order]]
    assert len(set(zip(group.tolist(), runs))) == len(set(runs)) == group[-1]


def test_words_with_one_code_do_not_count_as_equal(spark, monkeypatch):
    texts = ["a b c d e", "b a c d e", "a b c d f", "x y c d e"]
    table = pa.table({"_a": pa.array(range(4), pa.int64()), "_b": pa.array(range(4), pa.int64()), "_n": pa.array([1] * 4, pa.int32()),
                      "_at": pa.array([7, 0, 0, 0], pa.int32()), "_text": pa.array([t.encode() for t in texts])})
    monkeypatch.setattr(superkmers, "word_codes", lambda w: np.zeros(len(w.doc), np.uint64))
    got = superkmers.repeated_spans(table, 3).to_pylist()
    assert sorted((g["_a"], g["_lo"], g["_hi"]) for g in got) == [(0, 7, 12), (1, 2, 5), (2, 0, 4), (3, 2, 5)]


def test_equal_windows_share_their_minimiser():
    passage = [f"p{i}" for i in range(50)]
    w = words_of([" ".join(["x", "y"] + passage + ["z"]), " ".join(passage)])
    first, end, least = superkmers.super_kmers(w, ngrams.word_codes(w), 35, 4)
    seen = {}
    for i, j, m in zip(first, end, least):
        for p in range(i, j - 34):
            seen.setdefault(tuple(w.text(q) for q in range(p, p + 35)), set()).add(m)
    assert all(len(v) == 1 for v in seen.values()) and len(seen) == 19


def test_query_on_given_tables(spark):
    from parcelle.llm.queries import op13_superkmers
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = sorted((d, n, g, hashlib.sha256(k.encode()).hexdigest()) for d, n, g, k in brute([tuple(x) for x in docs], 35))
    got = op13_superkmers(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(tuple(x) for x in got.collect()) == want
    assert any(x[2] for x in want)
