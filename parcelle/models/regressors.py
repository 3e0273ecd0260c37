"""Regressors on vector columns: elastic net, gradient-boosted trees,
batch-wise continued boosting, P-spline GAM.

Every ``fit`` takes a DataFrame with a vector column and a label column and
returns a model whose ``transform`` adds a prediction column — the MLlib
contract, so they compose with the combined model and the searches.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark import SparkContext, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle.models.histtrees import Boosting, HistModel
from parcelle.models.leastsquares import fit_least_squares
from parcelle.session import scratch_path


# ---------------------------------------------------------------------------
# Elastic net
# ---------------------------------------------------------------------------
@dataclass
class ElasticNet:
    """min 1/(2n)‖y − Xw − b‖² + α·ρ‖w‖₁ + α(1−ρ)/2‖w‖².

    MLlib scales the label by its population standard deviation σ before applying the
    penalty, so α and ρ are re-parameterised: regParam = αρ + α(1−ρ)σ and
    elasticNetParam = αρ / regParam (no feature standardisation).
    """
    alpha: float = 1.0
    l1_ratio: float = 0.5
    max_iter: int = 1000
    tol: float = 1e-6
    fit_intercept: bool = True
    features_col: str = "features"
    label_col: str = "label"
    prediction_col: str = "prediction"

    def fit(self, df: DataFrame):
        sigma = df.agg(F.stddev_pop(self.label_col)).first()[0] or 0.0
        if sigma == 0:
            sigma = abs(df.agg(F.avg(self.label_col)).first()[0] or 1.0)
        reg = self.alpha * self.l1_ratio + self.alpha * (1 - self.l1_ratio) * sigma
        mix = (self.alpha * self.l1_ratio / reg) if reg > 0 else 0.0
        lr = LinearRegression(featuresCol=self.features_col, labelCol=self.label_col,
                              predictionCol=self.prediction_col, regParam=reg, elasticNetParam=mix,
                              maxIter=self.max_iter, tol=self.tol, standardization=False,
                              fitIntercept=self.fit_intercept)
        return lr.fit(df)


# ---------------------------------------------------------------------------
# Gradient-boosted trees
# ---------------------------------------------------------------------------
# Boosting parameters with an MLlib equivalent (squared error: a child's
# hessian weight is its row count, so min_child_weight = min rows per child).
_GBT_MAP = {"n_estimators": "maxIter", "learning_rate": "stepSize", "max_depth": "maxDepth",
            "subsample": "subsamplingRate", "min_child_weight": "minInstancesPerNode"}
# Accepted and meaningless for a distributed fit (thread count, objective).
_GBT_NEUTRAL = {"objective", "n_jobs", "tree_method"}
# No MLlib equivalent: split gain penalty and leaf-weight L2/L1 regularisation.
GBT_UNSUPPORTED = {"gamma", "lambda", "reg_lambda", "alpha", "reg_alpha"}


def gbt_params(params: dict, drop_unsupported: bool = False) -> tuple[dict, dict]:
    """Translate boosting parameters to ``GBTRegressor`` ones.

    Parameters without an equivalent raise unless ``drop_unsupported`` is
    set, in which case they are returned separately (never silently lost)."""
    out, dropped = {}, {}
    for k, v in params.items():
        if k in _GBT_MAP:
            out[_GBT_MAP[k]] = int(v) if _GBT_MAP[k] in ("maxIter", "maxDepth", "minInstancesPerNode") else float(v)
        elif k == "objective" and v != "reg:squarederror":
            raise ValueError("only the squared-error objective is supported")
        elif k in _GBT_NEUTRAL:
            continue
        elif k in GBT_UNSUPPORTED and drop_unsupported:
            dropped[k] = v
        else:
            raise ValueError(f"boosting parameter {k!r} has no MLlib GBTRegressor equivalent")
    return out, dropped


@dataclass
class BoostedTrees:
    params: dict = field(default_factory=lambda: {"n_estimators": 100, "learning_rate": 0.1,
                                                  "max_depth": 6})
    drop_unsupported: bool = False
    features_col: str = "features"
    label_col: str = "label"
    prediction_col: str = "prediction"
    seed: int = 42

    def fit(self, df: DataFrame) -> HistModel:
        """Least-squares boosting by ``GBTRegressor``'s definition (``leastsquares``), without its job per level."""
        p, self.unsupported = gbt_params(self.params, self.drop_unsupported)
        spec = Boosting(p.get("maxIter", 20), p.get("stepSize", 0.1), p.get("maxDepth", 5), subsample=p.get("subsamplingRate", 1.0),
                        min_child_weight=p.get("minInstancesPerNode", 1), seed=self.seed)
        return fit_least_squares(df, spec, self.features_col, self.label_col, self.prediction_col)


# ---------------------------------------------------------------------------
# Batch-wise continued boosting
# ---------------------------------------------------------------------------
class BatchBoostModel:
    """base + learning rate · Σ trees; ``ensemble`` is one MLlib model that scores all trees in one step."""

    def __init__(self, base: float, ensemble: GBTRegressionModel | None, features_col: str,
                 prediction_col: str = "prediction"):
        self.base, self.ensemble = base, ensemble
        self.features_col, self.prediction_col = features_col, prediction_col

    def transform(self, df: DataFrame) -> DataFrame:
        if self.ensemble is None:
            return df.withColumn(self.prediction_col, F.lit(self.base))
        m = self.ensemble.copy().setFeaturesCol(self.features_col).setPredictionCol(self.prediction_col)
        return m.transform(df).withColumn(self.prediction_col, F.lit(self.base) + F.col(self.prediction_col))


def tree_ensemble(trees: list, weight: float) -> GBTRegressionModel:
    """One model predicting weight · Σ of the fitted regression ``trees``."""
    gateway = SparkContext._active_spark_context._gateway
    ml = gateway.jvm.org.apache.spark.ml.regression
    nodes = gateway.new_array(ml.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(gateway.jvm.double, len(trees))
    for i, t in enumerate(trees):
        nodes[i], weights[i] = t._java_obj, float(weight)
    return GBTRegressionModel(ml.GBTRegressionModel(f"GBTRegressor_{uuid4().hex[:12]}", nodes, weights))


class BatchBoost:
    """Each batch of the training rows adds ``rounds`` trees fitted to the
    current residuals of that batch (the original continues one booster batch
    by batch).

    The training rows are written once, partitioned by batch.  A batch is read
    alone, scored once by the trees so far, and only its own running
    prediction is checkpointed per tree, so all the work is rounds × table, not
    batches × rounds × table.  Subsampling hashes the row's content and does
    not depend on the partitioning."""

    def __init__(self, rounds: int = 10, learning_rate: float = 0.5, max_depth: int = 10,
                 subsample: float = 0.8, min_child_weight: int = 10,
                 features_col: str = "features", label_col: str = "label",
                 batch_col: str = "batch_id", seed: int = 42):
        self.rounds, self.lr, self.max_depth = rounds, learning_rate, max_depth
        self.subsample, self.min_child = subsample, min_child_weight
        self.features_col, self.label_col, self.batch_col, self.seed = features_col, label_col, batch_col, seed

    def fit(self, df: DataFrame) -> BatchBoostModel:
        spark = df.sparkSession
        rows = df.select(self.features_col, self.label_col, self.batch_col)
        path = scratch_path(spark, "batch-boost")
        rows.hint("rebalance", self.batch_col).write.partitionBy(self.batch_col).parquet(path)
        stored = spark.read.schema(rows.schema).parquet(path)
        base = stored.agg(F.avg(self.label_col)).first()[0]
        batches = [r[0] for r in stored.select(self.batch_col).distinct().orderBy(self.batch_col).collect()]
        trees = []
        for b in batches:
            sofar = BatchBoostModel(base, tree_ensemble(trees, self.lr) if trees else None, self.features_col, "_f")
            cur = sofar.transform(stored.filter(F.col(self.batch_col).eqNullSafe(F.lit(b)))).select(
                self.features_col, self.label_col, "_f").checkpoint()
            for _ in range(self.rounds):
                part = cur.withColumn("_res", F.col(self.label_col) - F.col("_f"))
                if self.subsample < 1.0:
                    key = F.xxhash64(F.lit(self.seed + len(trees)), vector_to_array(self.features_col), self.label_col)
                    part = part.filter(F.pmod(key, F.lit(10**6)) < self.subsample * 10**6)
                tree = DecisionTreeRegressor(featuresCol=self.features_col, labelCol="_res",
                                             predictionCol="_tp", maxDepth=self.max_depth,
                                             minInstancesPerNode=self.min_child, seed=self.seed).fit(part)
                trees.append(tree)
                cur = (tree.transform(cur).withColumn("_f", F.col("_f") + F.lit(self.lr) * F.col("_tp"))
                       .drop("_tp").checkpoint())
        return BatchBoostModel(base, tree_ensemble(trees, self.lr) if trees else None, self.features_col)


# ---------------------------------------------------------------------------
# P-spline GAM (Eilers & Marx, 1996)
# ---------------------------------------------------------------------------
def bspline_basis(x: np.ndarray, lo: float, hi: float, n_splines: int = 20, order: int = 3) -> np.ndarray:
    """Cubic (``order``) B-spline basis with equally spaced knots over [lo, hi];
    values outside are clamped to the range."""
    if hi <= lo:
        hi = lo + 1.0
    n_int = n_splines - order
    step = (hi - lo) / n_int
    knots = lo + step * np.arange(-order, n_int + order + 1)
    x = np.clip(x, lo, hi - 1e-12 * (hi - lo))
    B = ((x[:, None] >= knots[None, :-1]) & (x[:, None] < knots[None, 1:])).astype(float)
    for k in range(1, order + 1):
        left = (x[:, None] - knots[None, :-(k + 1)]) / (knots[k:-1] - knots[:-(k + 1)])[None, :]
        right = (knots[None, k + 1:] - x[:, None]) / (knots[k + 1:] - knots[1:-k])[None, :]
        B = left * B[:, :-1] + right * B[:, 1:]
    return B


#: Partial sums added by one task of the Gram matrix reduction.
FAN_IN = 16


class GAMModel:
    def __init__(self, beta, ranges, n_splines, order, features_col, prediction_col="prediction"):
        self.beta, self.ranges, self.n_splines, self.order = beta, ranges, n_splines, order
        self.features_col, self.prediction_col = features_col, prediction_col

    def design(self, X: np.ndarray) -> np.ndarray:
        cols = [np.ones((len(X), 1))]
        for j, (lo, hi) in enumerate(self.ranges):
            cols.append(bspline_basis(X[:, j], lo, hi, self.n_splines, self.order))
        return np.hstack(cols)

    def transform(self, df: DataFrame) -> DataFrame:
        beta, design, fc, pc = self.beta, self.design, self.features_col, self.prediction_col
        arr = df.withColumn("_x", vector_to_array(F.col(fc)))
        schema = T.StructType(arr.schema.fields + [T.StructField(pc, T.DoubleType())])

        def predict(batches):
            for pdf in batches:
                X = np.vstack(pdf["_x"].to_numpy()) if len(pdf) else np.zeros((0, len(self.ranges)))
                pdf = pdf.copy()
                pdf[pc] = design(X) @ beta if len(pdf) else []
                yield pdf
        return arr.mapInPandas(predict, schema).drop("_x")


class GAM:
    """Sum of one penalised spline per feature plus an intercept.

    XᵀX and Xᵀy of the spline design are summed per partition in one pass and
    added up a tree of ``FAN_IN`` partials a task; the (1 + d·n_splines)-square
    penalised system is solved on the driver."""

    def __init__(self, lam: float = 0.5, n_splines: int = 20, order: int = 3,
                 features_col: str = "features", label_col: str = "label", ridge: float = 1e-8):
        self.lam, self.n_splines, self.order = lam, n_splines, order
        self.features_col, self.label_col, self.ridge = features_col, label_col, ridge

    def fit(self, df: DataFrame) -> GAMModel:
        arr = df.select(vector_to_array(F.col(self.features_col)).alias("_x"),
                        F.col(self.label_col).cast("double").alias("_y"))
        d = len(arr.first()["_x"])
        ends = arr.select(*[f(F.col("_x")[j]) for f in (F.min, F.max) for j in range(d)]).first()
        ranges = [(float(ends[j]), float(ends[d + j])) for j in range(d)]
        proto = GAMModel(None, ranges, self.n_splines, self.order, self.features_col)
        p = 1 + d * self.n_splines

        def partial(batches):
            G, b = np.zeros((p, p)), np.zeros(p)
            for pdf in batches:
                if len(pdf):
                    X = proto.design(np.vstack(pdf["_x"].to_numpy()))
                    G += X.T @ X
                    b += X.T @ pdf["_y"].to_numpy()
            yield pd.DataFrame({"k": [TaskContext.get().partitionId()], "g": [np.append(G[upper], b).tobytes()]})

        def add(key, pdf):
            return pd.DataFrame({"k": [key[0]], "g": [sum(np.frombuffer(g) for g in pdf["g"]).tobytes()]})

        # Partial sums (upper triangle of XᵀX, then Xᵀy) meet FAN_IN at a time: no task or the driver holds more.
        upper, schema = np.triu_indices(p), "k long, g binary"
        parts, left = arr.mapInPandas(partial, schema), arr.rdd.getNumPartitions()
        while left > 1:
            parts = parts.select(F.floor(F.col("k") / FAN_IN).alias("k"), "g").groupBy("k").applyInPandas(add, schema)
            left = -(-left // FAN_IN)
        total = np.frombuffer(parts.first()["g"])
        G, bvec = np.zeros((p, p)), total[-p:]
        G[upper] = total[:-p]
        G = G + np.triu(G, 1).T
        D = np.diff(np.eye(self.n_splines), n=2, axis=0)
        P = np.zeros((p, p))
        for j in range(d):
            s = 1 + j * self.n_splines
            P[s:s + self.n_splines, s:s + self.n_splines] = D.T @ D
        beta = np.linalg.solve(G + self.lam * P + self.ridge * np.eye(p), bvec)
        return GAMModel(beta, ranges, self.n_splines, self.order, self.features_col)
