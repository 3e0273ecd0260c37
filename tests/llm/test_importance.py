"""Importance resampling: held-out accuracy, exact top-k, hostile rows."""

import numpy as np
from pyspark.sql import functions as F

from parcelle.llm import importance


def test_kth_largest_is_exact(spark):
    r = np.random.default_rng(0)
    x = np.concatenate([r.integers(0, 2**62, 500), np.full(60, 12345), r.integers(0, 9, 200)])
    df = spark.createDataFrame([(int(v),) for v in x], "v long").cache()
    top = np.sort(x)[::-1]
    for k in (1, 2, 499, 540, 760):
        assert importance.kth_largest(df, "v", k) == top[k - 1]
    assert importance.kth_largest(df, "v", 0) is None


def test_ratio_equals_plain_counts(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, None), (None, "a")], "doc_id long, text string")
    got = importance.log_ratios(docs, np.array([1]), "doc_id", "text", 64)
    from parcelle.llm.words import hash_word, slices
    import pyarrow as pa
    feats = lambda t: importance.features(next(slices(pa.array([t]))), 64)[0]
    raw = np.bincount(np.concatenate([feats(t) for t in ("a b a", "b c", "a")]), minlength=64)
    tgt = np.bincount(feats("a b a"), minlength=64)
    assert np.allclose(got, np.log((tgt + 5) / (raw * tgt.sum() / raw.sum() + 5)))
    assert feats("a")[0] == hash_word("a") % 64


def test_held_out_accuracy(spark):
    from conftest import SF_MID
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    train, held = labels.filter("doc_id % 2 = 0"), labels.filter("doc_id % 2 = 1")
    out = importance.resample(docs, train).join(held, "doc_id").toPandas()
    assert len(out) > 150
    good, bad = out[out.quality == 1], out[out.quality == 0]
    assert good.kept.mean() > 0.95 and bad.kept.mean() < 0.25


def test_k_rows_by_perturbed_weight(spark):
    docs = spark.createDataFrame([(i, f"w{i % 7} x{i}") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    out = importance.resample(docs, labels, k=50).toPandas()
    assert out.kept.sum() == 50 and out[out.kept].gumbel_score.min() > out[~out.kept].gumbel_score.max()
    again = importance.resample(docs.repartition(3), labels, k=50).filter("kept").toPandas()
    assert set(again.doc_id) == set(out[out.kept].doc_id)


def test_hostile_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a b", None), (3, "q " * 30000, "y"), (3, "q " * 30000, "y"), (4, "### $$$ %%%", "z"), (5, "fine words here", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string").withColumn("kept", F.lit("mine"))
    labels = spark.createDataFrame([(5, 1), (4, 0), (None, 1), (5, 1), (3, None), (2, 1), (1, 1)], "doc_id long, quality int")
    out = importance.quality_filter(docs, labels)
    assert out.columns == docs.columns and sum(1 for r in out.collect() if r.doc_id == 3) in (0, 2)
    none = spark.createDataFrame([], labels.schema)
    assert importance.quality_filter(docs, none).count() == len(rows)
    assert importance.quality_filter(docs.limit(0), labels).count() == 0
