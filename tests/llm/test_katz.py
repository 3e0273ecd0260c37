"""Katz backoff against a dictionary model written from the definition; exact normalisation."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelle.llm import katz


def brute(rows):
    def words(t):
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", t), "</s>"]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in rows]
    train = [words(t) for (_, t), x in zip(rows, held) if not x]
    one = Counter(w for t in train for w in t)
    two = Counter(p for t in train for p in zip(["<s>", *t], t))
    n, v = sum(one.values()), len(one)
    stars = []
    for c in (one, two):
        coc = Counter(c.values())
        stars.append(katz.discounted(np.array([coc[i] for i in range(1, katz.K + 2)])))
    star = lambda level, r: stars[level][r] if r <= katz.K else r - katz.EPS
    unknown = 1 - sum(star(0, c) for c in one.values()) / n if n else 1.0
    p1 = lambda w: star(0, one[w]) / n if one[w] else unknown
    after = defaultdict(list)
    for h, w in two:
        after[h].append(w)
    total = {h: sum(two[h, w] for w in ws) for h, ws in after.items()}
    alpha = {h: (1 - sum(star(1, two[h, w]) for w in ws) / total[h]) / (1 - sum(p1(w) for w in ws)) for h, ws in after.items()}

    def p2(h, w):
        if two[h, w]:
            return star(1, two[h, w]) / total[h]
        return alpha.get(h, 1.0) * p1(w)
    for h in list(after)[:20]:
        assert math.isclose(sum(p2(h, w) for w in one) + p2(h, "<never met>"), 1, rel_tol=1e-9)
    out = []
    for (d, t), x in zip(rows, held):
        t = words(t)
        out.append((d, x, len(t), sum(one[w] > 0 for w in t), n, sum(math.log10((one[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t),
                    sum(math.log10(p2(h, w)) for h, w in zip(["<s>", *t], t))))
    return out


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", F.lit("own"))
    got = sorted((tuple(r) for r in katz.score(df.repartition(3), **kw).collect()), key=lambda r: (str(r[0]), r[2], round(r[5], 6)))
    want = sorted(brute(rows), key=lambda r: (str(r[0]), r[2], round(r[5], 6)))
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-8), (a, b)


def made(seed, n, vocab, hot=0.0):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(vocab)] + ["The", "É", "#x"]
    pick = lambda: "the" if r.random() < hot else words[int(len(words) * r.random() ** 3)]
    return [(i * 7, " ".join(pick() + r.choice(["", "", "\n", "\t "]) for _ in range(r.choice([0, 1, 5, 60, 200])))) for i in range(n)]


@pytest.mark.parametrize("seed,hot", [(1, 0.0), (2, 0.4)])
def test_scores_equal_the_definition(spark, seed, hot, monkeypatch):
    monkeypatch.setattr(katz, "SLICE_BYTES", 4000)
    check(spark, made(seed, 120, 300, hot), min_buckets=8)


def test_documents(spark):
    from conftest import SF_SMALL
    check(spark, [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()])


def test_hostile_rows(spark):
    rows = [(None, None), (None, "a b"), (3, ""), (4, "a b a b"), (4, "a b a b"), (5, "x " * 40000), (6, " "), (9, "y" * 50000), (11, None)]
    check(spark, rows)
    assert katz.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    held = [(i, "a b") for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    out = katz.score(spark.createDataFrame(held, "doc_id long, text string")).collect()
    assert len(out) == 3 and all(r.train_tokens == 0 and r.n_known == 0 and r.score == 0 for r in out)
