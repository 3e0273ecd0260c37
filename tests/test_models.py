"""Model properties: closed-form elastic net, GAM recovers a smooth curve,
boosting reduces the loss, save/load round trip, unsupported parameters."""

import math
import tempfile

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T
from pyspark.sql import functions as F

from parcelle.models.combined import Combined, CombinedModel, weight_sweep
from parcelle.models.regressors import GAM, BatchBoost, BoostedTrees, ElasticNet, gbt_params
from parcelle.sources.model_io import load_combined, save_combined


def _frame(spark, X, y, col="features"):
    schema = T.StructType([T.StructField(col, VectorUDT()), T.StructField("label", T.DoubleType())])
    return spark.createDataFrame([(Vectors.dense(list(map(float, x))), float(t)) for x, t in zip(X, y)],
                                 schema)


def _cd_elastic_net(X, y, alpha, l1, iters=5000):
    """Coordinate descent on the original objective (with intercept)."""
    n, d = X.shape
    xm, ym = X.mean(0), y.mean()
    Xc, yc = X - xm, y - ym
    w = np.zeros(d)
    for _ in range(iters):
        for j in range(d):
            r = yc - Xc @ w + Xc[:, j] * w[j]
            rho = Xc[:, j] @ r / n
            z = (Xc[:, j] ** 2).sum() / n + alpha * (1 - l1)
            w[j] = np.sign(rho) * max(abs(rho) - alpha * l1, 0) / z
    return w, ym - xm @ w


def test_elastic_net_matches_coordinate_descent(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(400, 3))
    y = X @ np.array([3.0, -2.0, 0.5]) + 1.0 + rng.normal(scale=0.5, size=400)
    m = ElasticNet(alpha=0.5, l1_ratio=0.5, tol=1e-10, max_iter=5000).fit(_frame(spark, X, y))
    w, b = _cd_elastic_net(X, y, 0.5, 0.5)
    assert np.allclose(m.coefficients.toArray(), w, rtol=2e-3, atol=2e-3)
    assert math.isclose(m.intercept, b, rel_tol=2e-3, abs_tol=2e-3)


def test_gam_recovers_smooth_function(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 6, 800)
    y = np.sin(x) + rng.normal(scale=0.1, size=800)
    df = _frame(spark, x[:, None], y)
    m = GAM(lam=0.5).fit(df)
    pred = np.array([r.prediction for r in m.transform(df).select("prediction").collect()])
    assert np.sqrt(np.mean((pred - np.sin(x)) ** 2)) < 0.08


def test_batch_boost_reduces_loss(spark):
    rng = np.random.default_rng(2)
    X = rng.uniform(-1, 1, (600, 2))
    y = np.where(X[:, 0] > 0, 5.0, -5.0) + X[:, 1]
    df = _frame(spark, X, y).withColumn("batch_id", (F.monotonically_increasing_id() % 2).cast("int"))
    m = BatchBoost(rounds=3, learning_rate=0.5, max_depth=3, subsample=1.0, min_child_weight=1).fit(df)
    pred = m.transform(df).select(F.avg(F.pow(F.col("label") - F.col("prediction"), 2))).first()[0]
    assert pred < 0.1 * float(np.var(y))


def test_unsupported_boosting_params_are_not_ignored():
    with pytest.raises(ValueError):
        gbt_params({"n_estimators": 10, "gamma": 0.2})
    p, dropped = gbt_params({"n_estimators": 10, "gamma": 0.2}, drop_unsupported=True)
    assert p == {"maxIter": 10} and dropped == {"gamma": 0.2}


def test_combined_weighted_and_save_load(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(300, 4))
    y = X @ np.array([1.0, 2.0, -1.0, 0.5])
    rows = [(Vectors.dense(x[:2].tolist()), Vectors.dense(x[2:].tolist()), Vectors.dense(x.tolist()), float(t),
             str(i)) for i, (x, t) in enumerate(zip(X, y))]
    schema = T.StructType([T.StructField(c, VectorUDT()) for c in ("x_phys", "x_ctx", "x_all")]
                          + [T.StructField("label", T.DoubleType()), T.StructField("id_mutation", T.StringType())])
    df = spark.createDataFrame(rows, schema)
    model = Combined(lambda: ElasticNet(0.01, 0.5), lambda: GAM(lam=1.0), weight=0.3).fit(df)
    out = model.transform(df).select("p_phys", "p_ctx", "prediction").collect()
    assert all(math.isclose(r.prediction, 0.3 * r.p_phys + 0.7 * r.p_ctx, abs_tol=1e-9) for r in out)
    path = tempfile.mkdtemp(prefix="parcelle-model-")
    save_combined(spark, model, path)
    again = load_combined(spark, path).transform(df).select("prediction").collect()
    assert [r.prediction for r in again] == pytest.approx([r.prediction for r in out])
    oof = model.transform(df)
    sweep = {r.weight: r.mse for r in weight_sweep(oof, [0.0, 1.0]).collect()}
    assert sweep[0.0] == pytest.approx(
        oof.select(F.avg(F.pow(F.col("label") - F.col("p_ctx"), 2))).first()[0])


def test_shapley_values_are_additive(spark):
    """Σφ(x) = f(x) − mean over the background of f(b): every permutation's
    marginal contributions telescope, so the sampled values are additive."""
    from pyspark.ml.regression import LinearRegression
    from parcelle.models.combined import shapley_values
    rng = np.random.default_rng(4)
    X = rng.normal(size=(60, 4))
    y = X @ np.array([1.0, -2.0, 0.5, 3.0]) + 0.3 * X[:, 0] * X[:, 3]
    schema = T.StructType([T.StructField("_sid", T.LongType()), T.StructField("x_all", VectorUDT()),
                           T.StructField("x_phys", VectorUDT()), T.StructField("x_ctx", VectorUDT()),
                           T.StructField("label", T.DoubleType())])
    df = spark.createDataFrame([(i, Vectors.dense(x.tolist()), Vectors.dense(x[:2].tolist()),
                                 Vectors.dense(x[2:].tolist()), float(t)) for i, (x, t) in enumerate(zip(X, y))],
                               schema)
    phys = LinearRegression(featuresCol="x_phys", labelCol="label").fit(df)
    ctx = LinearRegression(featuresCol="x_ctx", labelCol="label").fit(df)
    model = CombinedModel(phys, ctx, 0.3)
    bg = X[:5].tolist()
    phi = shapley_values(model, df.filter("_sid >= 50"), bg, 2, n_permutations=3)
    sums = {r["_sid"]: r["s"] for r in phi.groupBy("_sid").agg(F.sum("phi").alias("s")).collect()}

    def f(rows):
        return np.array([0.3 * (phys.intercept + r[:2] @ phys.coefficients.toArray())
                         + 0.7 * (ctx.intercept + r[2:] @ ctx.coefficients.toArray()) for r in rows])

    base = f(np.array(bg)).mean()
    for i in range(50, 60):
        assert sums[i] == pytest.approx(f(X[i:i + 1])[0] - base, abs=1e-6)
