"""Boosted trees of one job against MLlib's own GBTRegressor; many tasks against one task; save and load."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from parcelle.models import leastsquares
from parcelle.models.combined import CombinedModel
from parcelle.models.regressors import BoostedTrees
from parcelle.sources.model_io import load_combined, save_combined

PARAMS = {"n_estimators": 6, "learning_rate": 0.3, "max_depth": 4, "min_child_weight": 5}


def table(spark, n=600, seed=0):
    r = np.random.default_rng(seed)
    kind = r.integers(0, 12, n)
    x = np.column_stack([r.integers(0, 20, n) / 3, r.integers(0, 9, n), *[(kind == k).astype(float) for k in range(12)]])
    y = x[:, 0] * 2 + np.where(kind > 6, x[:, 1], -kind) + r.standard_normal(n)
    return spark.createDataFrame([(i, Vectors.dense(v.tolist()), float(t)) for i, (v, t) in enumerate(zip(x, y))], ["id", "features", "label"]).repartition(3)


def predicted(model, df):
    return model.transform(df).select("id", "prediction").toPandas().sort_values("id").prediction.to_numpy()


def test_equals_mllib(spark):
    df = table(spark)
    want = GBTRegressor(maxIter=6, stepSize=0.3, maxDepth=4, minInstancesPerNode=5, seed=1).fit(df)
    assert np.allclose(predicted(BoostedTrees(PARAMS).fit(df), df), predicted(want, df), atol=1e-8)


def test_a_fit_takes_few_jobs(spark):
    df = table(spark).cache()
    df.count()
    spark.sparkContext.setJobGroup("fit", "fit")
    try:
        BoostedTrees(PARAMS).fit(df)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("fit")) < 12  # a job per level were 24 and more
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def _first(params, df, monkeypatch):
    monkeypatch.setattr(leastsquares, "ALONE_ROWS", 10_000)
    return BoostedTrees(params | {"n_estimators": 2}).fit(df)


def test_many_tasks_give_the_trees_of_one(spark, monkeypatch):
    df = table(spark)
    params = PARAMS | {"subsample": 0.7}
    one = predicted(BoostedTrees(params).fit(df), df)
    monkeypatch.setattr(leastsquares, "ALONE_ROWS", 200)
    monkeypatch.setattr(leastsquares, "RESTART_TREES", 2)
    assert np.allclose(predicted(BoostedTrees(params).fit(df), df), one, atol=1e-8)
    monkeypatch.setattr(leastsquares, "DRIVER_BYTES", 1)
    assert np.allclose(predicted(BoostedTrees(params | {"n_estimators": 2}).fit(df), df), predicted(_first(params, df, monkeypatch), df), atol=1e-8)


def test_saved_and_bad_input(spark, tmp_path):
    df = table(spark, 100)
    m = BoostedTrees(PARAMS).fit(df)
    save_combined(spark, CombinedModel(m, m, 0.5, None, False, "features", "features"), str(tmp_path / "m"))
    assert np.allclose(predicted(load_combined(spark, str(tmp_path / "m")), df), predicted(m, df))
    with pytest.raises(ValueError):
        BoostedTrees(PARAMS).fit(df.filter("id < 0"))
    with pytest.raises(ValueError):
        BoostedTrees(PARAMS).fit(df.withColumn("label", F.when(F.col("id") > 5, F.col("label"))))


def test_sums_of_dense_features_keep_their_fractions():
    rows = leastsquares._Rows(np.array([[0], [1], [0], [1]], np.uint8), np.array([0.25, 0.5, 0.5, 0.125]), np.zeros(4, np.uint64), np.array([0, 2]))
    got = rows.sums(0, leastsquares.Boosting(1), (np.array([-1]), np.array([0]), np.array([0])), np.array([0]), 1)
    assert got.tolist() == [[[0.75, 0.625]], [[2.0, 2.0]]]


def test_shared_codes_give_the_sums_of_each_feature():
    r = np.random.default_rng(3)
    n, sizes = 5000, [32, 7, 2, 1, 20, 2, 32, 3, 2]
    bins = np.stack([np.where(r.random(n) < (0.9 if j in (2, 5, 7) else 0), 0, r.integers(0, s, n)) for j, s in enumerate(sizes)], 1).astype(np.uint8)
    starts, y = np.concatenate([[0], np.cumsum(sizes)]), r.integers(-9, 9, n).astype(float)
    rows = leastsquares._Rows(bins, y, np.zeros(n, np.uint64), starts)
    nodes = (np.array([0, 5, -1, -1, -1]), np.array([15, 0, 0, 0, 0]), np.array([1, 3, 0, 0, 0]))  # the left child is split by a feature of one usual bin
    node = np.where(bins[:, 0] > 15, 2, np.where(bins[:, 5] > 0, 4, 3))
    got = rows.sums(0, leastsquares.Boosting(1), nodes, np.array([-1, -1, 1, -1, 0]), 2)
    want = np.zeros((2, 2, starts[-1]))
    for slot, leaf in enumerate((4, 2)):
        for j in range(len(sizes)):
            np.add.at(want[0, slot], starts[j] + bins[node == leaf, j].astype(int), y[node == leaf])
            np.add.at(want[1, slot], starts[j] + bins[node == leaf, j].astype(int), 1)
    assert np.array_equal(got, want)
    rows.advanced([(0, nodes, np.arange(5.0))])
    assert np.array_equal(rows.f, node)


def test_held_rows_carry_no_byte_per_indicator():
    import pickle
    r = np.random.default_rng(4)
    kind = r.integers(0, 200, 20_000)
    bins = np.concatenate([r.integers(0, 32, (20_000, 6)), kind[:, None] == np.arange(200)], 1).astype(np.uint8)
    starts = np.concatenate([[0], np.cumsum([32] * 6 + [2] * 200)])
    assert len(pickle.dumps(leastsquares._Rows(bins, np.zeros(20_000), np.zeros(20_000, np.uint64), starts))) < 60 * 20_000


def test_some_hundred_thousand_rows_take_no_job_per_level(spark):
    from pyspark.ml.feature import VectorAssembler
    df = spark.range(300_000).select(F.pmod("id", F.lit(31)).alias("a"), F.pmod("id", F.lit(7)).alias("b"), (F.pmod("id", F.lit(31)) * 2.0 + F.pmod("id", F.lit(7))).alias("label"))
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).cache()
    df.count()
    spark.sparkContext.setJobGroup("large", "large")
    try:
        BoostedTrees(PARAMS).fit(df)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("large")) < 12
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        df.unpersist()
