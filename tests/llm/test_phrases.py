"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from parcelle.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows, max_words=3):
    counts, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    return counts, n


def brute(rows, min_count=10, max_words=3, per_lang=2000, covered=50):
    counts, n = brute_counts(rows, max_words)
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        longer = Counter()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i:i + m]] = max(longer[p[i:i + m]], a)
        scored = []
        for p, a in candidates.items():
            if longer[p] * 100 >= covered * a:
                continue
            score, cut = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:per_lang], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def make_rows(seed=2, n=250):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["É", "é", "İ", "ΑΒ", "a b", "日本", "x" * 300, "Q", "\x00"]
    fixed = [["New", "York", "City"], ["red", "fox"], ["ad", "hoc", "fix"], ["la", "la", "la"]]
    rows = []
    for i in range(n):
        words = []
        for _ in range(r.randrange(30)):
            words += r.choice(fixed) if r.random() < 0.3 else [r.choice(vocab)]
            words[-1] += r.choice(["", "", "", ".", ",", "\n", "!?", ";:"])
        rows.append((i, r.choice([" ", "\t", "  "]).join(words), r.choice(["en", "en", "en", "de", None, "", "und"])))
    return rows + [(900, None, "en"), (901, "", None), (None, "new york city " * 12, "fr"), (902, ".,;", "it"), rows[0], rows[0], (903, "only", "xx")]


def frame(spark, rows):
    return spark.createDataFrame([(*x, "clash", 0) for x in rows], "doc_id long, text string, lang string, phrase string, a int").repartition(4)


def collected(df):
    return sorted(tuple(x) for x in df.collect())


@pytest.mark.parametrize("share", [0.0, 0.1, 1.0])
def test_equals_plain_count_whatever_the_sample(spark, share):
    rows = make_rows()
    assert collected(phrases.collocations(frame(spark, rows), share=share)) == brute(rows)


def test_other_lengths_and_thresholds(spark):
    rows = make_rows(7)
    got = collected(phrases.collocations(frame(spark, rows), min_count=3, max_words=5, per_lang=20, covered_percent=80))
    assert got == brute(rows, 3, 5, 20, 80)


def test_all_frequent_phrases_found_through_border_failures(spark, monkeypatch):
    """An empty sample proposes nothing: each pass opens one length more, and the last one finds no failure."""
    rows = make_rows(4)
    opened = []
    plain = phrases._counts
    monkeypatch.setattr(phrases, "_counts", lambda d, m, *sets: opened.append(sets) or plain(d, m, *sets))
    got = {(x.lang, x.k, x.phrase): x.a for x in phrases.frequent_phrases(frame(spark, rows), share=0.0).collect()}
    counts, n = brute_counts(rows)
    want = {(lang, len(p), " ".join(p)): a for lang, f in counts.items() for p, a in f.items() if a >= 10}
    assert got == want | {(lang, 0, ""): a for lang, a in n.items() if a}
    assert len(opened) == 1 + 3


def test_shared_hashes_and_bits_change_nothing(spark, monkeypatch):
    rows = make_rows(6)
    monkeypatch.setattr(phrases, "LEAST_BITS", 6)
    monkeypatch.setattr(phrases, "PART_ROWS", 7)
    monkeypatch.setattr(phrases, "MOST_BITS", 7)
    assert collected(phrases.collocations(frame(spark, rows))) == brute(rows)


def test_score_is_exact_beyond_64_bits(spark):
    big = 3 * 10**13 + 7
    row = spark.createDataFrame([(big, big + 11, big + 1)], "a long, l long, r long")
    got = row.select(F.expr("cast((cast(1000000 as decimal(38,0)) * a * a) div (cast(l as decimal(38,0)) * r) as long)")).first()[0]
    assert got == 10**6 * big * big // ((big + 11) * (big + 1))


def test_empty_table(spark):
    assert collected(phrases.collocations(frame(spark, []))) == []


def test_lowered_threshold():
    assert phrases.lowered(10, 0.1, 0.01) == 2
    assert 60 < phrases.lowered(1000, 0.1, 0.01) < 100


def test_counted_texts_are_sent_on_in_small_batches(spark):
    """A task takes texts a megabyte at a time and never sends or holds a large table of counted phrases."""
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa

    from parcelle.llm import phrases

    class Docs:
        sparkSession = SimpleNamespace(sparkContext=SimpleNamespace(broadcast=lambda v: SimpleNamespace(value=v)))  # noqa: N815

        def mapInArrow(self, run, schema):  # noqa: N802
            return SimpleNamespace(groupBy=lambda *c: SimpleNamespace(agg=lambda *a: run))

    texts = [" ".join(f"w{i}x{j}" for j in range(100)) for i in range(2600)]
    assert max(len(t.data) for t in phrases._parts(pa.array(texts))) <= 1 << 20
    every = phrases.Proposed({k: np.full(1 << 17, 255, np.uint8) for k in (1, 2, 3)})
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array([7] * len(texts), pa.int64()), pa.array(texts)], names=["_lang", "_seed", "_text"])
    out = list(phrases._texts(Docs(), every, 3)(iter([batch])))
    assert max(b.num_rows for b in out) <= 20_000
    counted = pa.Table.from_batches(out).group_by("k").aggregate([("a", "sum")]).to_pydict()
    assert dict(zip(counted["k"], counted["a_sum"])) == {0: 260_000, 1: 260_000, 2: 2600 * 99, 3: 2600 * 98}
