"""Quality rules: base counts, Viterbi and training against brute force; held-out accuracy."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa

from parcelle.llm import linecrf
from parcelle.llm.words import slices

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hot = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hot), len(words) < 50 or 100 * len(hot) > 50 * len(words))


def test_base_counts_equal_brute_force(spark):
    r = random.Random(1)
    vocab = ["a", "bb", "é", "日本", "#x", "|", "$%", "the", "x y"]
    texts = [None, "", "\n\n", " \t", "a", "a\na\n a\na", "x" * 50000, "a b c a b c a b"]
    texts += ["".join(r.choice(vocab) + r.choice([" ", " ", "\n", "\t", "\r\n", "  "]) for _ in range(r.randrange(1, 120))) for _ in range(120)]
    data = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "'k' kept", "1 n_words")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out = linecrf.judge(df, labels)
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = out.collect()
    assert sorted(((r.doc_id, *(r[c] for c in cols)) for r in rows), key=str) == sorted(((d, *brute(t)) for d, t in data), key=str)
    assert all(r.kept == (not r.base_failed) for r in rows)  # no labels: every line is content
    assert linecrf.judge(df.limit(0), labels).count() == 0


def test_viterbi_equals_enumeration():
    r = np.random.default_rng(2)
    lens = [0, 1, 5, 3, 0, 7, 2]
    at = np.concatenate([[0], np.cumsum(lens)])
    score, trans = r.normal(size=(at[-1], 2)), r.normal(size=(2, 2))
    got = linecrf.viterbi(score, at, trans)
    for a, b in zip(at, at[1:]):
        total = lambda y: sum(score[a + i, k] for i, k in enumerate(y)) + sum(trans[p, q] for p, q in zip(y, y[1:]))  # noqa: B023, E731
        if b > a:
            best = max(itertools.product((0, 1), repeat=b - a), key=total)
            assert tuple(got[a:b]) == best


def test_training_raises_the_exact_likelihood():
    r = np.random.default_rng(3)
    lens = [4, 1, 6, 3]
    at = np.concatenate([[0], np.cumsum(lens)])
    x = r.integers(0, 2, (at[-1], 3)).astype(float)
    y = (x[:, 0] > 0).astype(int)

    def loglik(w, trans):
        out = 0.0
        for a, b in zip(at, at[1:]):
            total = lambda z: sum((x[a + i] @ w)[k] for i, k in enumerate(z)) + sum(trans[p, q] for p, q in zip(z, z[1:]))  # noqa: B023, E731
            out += total(y[a:b]) - np.logaddexp.reduce([total(z) for z in itertools.product((0, 1), repeat=b - a)])
        return out
    values = [loglik(*linecrf.train(x, y, at, rounds=n)) for n in (0, 5, 40, 200)]
    assert values == sorted(values) and values[-1] > -1
    one = linecrf.train(x, y, at, rounds=1, rate=1e-4, l2=0)
    grad = np.array([(loglik(np.eye(1, 6, i).reshape(3, 2) * 1e-5, np.zeros((2, 2))) - loglik(np.zeros((3, 2)), np.zeros((2, 2)))) / 1e-5 for i in range(6)])
    assert np.allclose(one[0].ravel() / 1e-4 * len(y), grad, atol=1e-3)


def test_held_out_accuracy(spark):
    from conftest import SF_MID
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    out = linecrf.judge(docs, labels.filter("doc_id % 2 = 0")).join(labels.filter("doc_id % 2 = 1"), "doc_id").toPandas()
    out = out[~out.base_failed]
    assert out[out.quality == 1].kept.mean() > 0.97 and out[out.quality == 0].kept.mean() < 0.15


def test_features_are_binary_and_per_line():
    t = next(slices(pa.array(["A b c.\n\n| x | y |\n", "", "Z"])))
    doc, chars, x = linecrf.measure(t)["lines"]
    assert doc.tolist() == [0, 0, 2] and x.shape == (3, linecrf.N_FEATURES) and set(np.unique(x)) <= {0.0, 1.0} and chars.tolist() == [4, 5, 1]


def _page(r, kind, n):
    if kind == "content":
        return [" ".join(r.choice(["river", "stone", "walking", "garden", "window", "people"]) + str() for _ in range(r.randrange(9, 20))) + "." for _ in range(n)]
    return [" | ".join(r.choice(["HOME", "NEWS", "LOGIN", "SHOP"]) for _ in range(r.randrange(2, 5))) for _ in range(n)]


def test_head_and_foot_around_content_are_found(spark):
    r = random.Random(5)
    good = [(i, "\n".join(_page(r, "content", r.randrange(3, 12)))) for i in range(40)]
    bad = [(100 + i, "\n".join(_page(r, "boilerplate", r.randrange(3, 12)))) for i in range(40)]
    shapes = [(200 + i, r.randrange(0, 4), r.randrange(2, 300), r.randrange(0, 4)) for i in range(30)]
    mixed = [(d, "\n\n".join(_page(r, "boilerplate", a) + _page(r, "content", n) + _page(r, "boilerplate", b))) for d, a, n, b in shapes]
    docs = spark.createDataFrame(good + bad + mixed + [(None, None), (999, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
    got = {}
    for row in linecrf.label_lines(docs, labels).collect():
        got.setdefault(row.doc_id, {})[row.line] = row.boilerplate
    hit = wrong = missed = 0
    for d, a, n, b in shapes:
        want = [True] * a + [False] * n + [True] * b
        have = [got[d][i] for i in range(len(want))]
        hit += sum(x and y for x, y in zip(want, have))
        wrong += sum(y and not x for x, y in zip(want, have))
        missed += sum(x and not y for x, y in zip(want, have))
    assert 2 * hit / (2 * hit + wrong + missed) > 0.95 and 999 not in got
    kept = {row.doc_id: (row.kept, row.content_share) for row in linecrf.judge(docs, labels).collect()}
    assert all(kept[d][1] > 0.5 for d, a, n, b in shapes if n > 2 * (a + b))


def test_training_sequences_change_their_label_inside():
    code, y, at = linecrf.stitched([np.arange(n) for n in (3, 5, 2, 4, 6)], [np.arange(100, 100 + n) for n in (2, 9)])
    assert len(code) == len(y) == at[-1] and at[0] == 0 and len(at) == 5 + 2 + 1
    assert (y == (code >= 100)).all()
    changes = [int((np.diff(y[a:b]) != 0).sum()) for a, b in zip(at, at[1:])]
    assert changes == [0, 1, 1, 2, 0, 0, 0]


def test_fit_uses_runs_from_all_places_and_repeats_exactly(spark):
    r = random.Random(6)
    text = lambda kind: "\n".join(_page(r, kind, 400))
    docs = spark.createDataFrame([(i, text("content" if i < 3 else "boilerplate")) for i in range(6)] + [(0, text("content"))], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 3)) for i in range(6)], "doc_id long, quality int")
    a = linecrf.fit(docs, labels, "doc_id", "text", fit_runs=5)
    b = linecrf.fit(docs.repartition(5), labels, "doc_id", "text", fit_runs=5)
    assert np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1]) and a[0].any()
