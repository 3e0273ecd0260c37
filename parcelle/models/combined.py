"""Two-part price model: a physical model and a contextual (location) model,
combined by a fixed weight or stacked under an elastic net; the weight
search; Shapley group impact.

Feature blocks stay columns of the same row (``x_phys``, ``x_ctx``, and
``x_all`` = both), so nothing is ever aligned by position.
"""

from __future__ import annotations

from dataclasses import dataclass, field
import json
from functools import reduce

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelle.functions.columns import hash_uniform
from parcelle.models.treeshap import parts_of, tree_shapley
from parcelle.operators.encode import BlockEncoder
from parcelle.schemas import CATEGORICAL_PHYSICAL, NUMERIC_CONTEXTUAL, NUMERIC_PHYSICAL


# ---------------------------------------------------------------------------
# Encoding of the two blocks
# ---------------------------------------------------------------------------
@dataclass
class TwoBlockEncoderModel:
    phys: object
    ctx: object

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.ctx.transform(self.phys.transform(df))
        return VectorAssembler(inputCols=["x_phys", "x_ctx"], outputCol="x_all").transform(out)

    def widths(self):
        return len(self.phys.feature_names()), len(self.ctx.feature_names())


def fit_two_block_encoder(train: DataFrame, categories: dict | None = None) -> TwoBlockEncoderModel:
    """Mode imputer + one-hot + robust scaler for the physical block, mode
    imputer + robust scaler for the contextual block, fitted once on train."""
    phys = BlockEncoder(CATEGORICAL_PHYSICAL, NUMERIC_PHYSICAL, categories, "x_phys").fit(train)
    ctx = BlockEncoder((), NUMERIC_CONTEXTUAL, None, "x_ctx").fit(train)
    return TwoBlockEncoderModel(phys, ctx)


# ---------------------------------------------------------------------------
# Combined model
# ---------------------------------------------------------------------------
class CombinedModel:
    def __init__(self, phys_model, ctx_model, weight, final=None, stacking=False,
                 phys_col="x_phys", ctx_col="x_ctx"):
        self.phys_model, self.ctx_model, self.weight = phys_model, ctx_model, weight
        self.final, self.stacking = final, stacking
        self.phys_col, self.ctx_col = phys_col, ctx_col

    def base_predictions(self, df: DataFrame) -> DataFrame:
        out = _predict(self.phys_model, df, self.phys_col, "p_phys")
        return _predict(self.ctx_model, out, self.ctx_col, "p_ctx")

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.base_predictions(df)
        if not self.stacking:
            w = self.weight
            return out.withColumn("prediction", F.lit(w) * F.col("p_phys") + F.lit(1 - w) * F.col("p_ctx"))
        meta = VectorAssembler(inputCols=["p_phys", "p_ctx", "x_all"], outputCol="x_meta").transform(out)
        return _predict(self.final, meta, "x_meta", "prediction")


def _predict(model, df: DataFrame, features_col: str, out_col: str) -> DataFrame:
    """Run any fitted model on ``features_col`` into ``out_col``."""
    if hasattr(model, "setFeaturesCol"):
        m = model.copy()
        m.setFeaturesCol(features_col)
        m.setPredictionCol(out_col)
        return m.transform(df)
    prev_f, prev_p = model.features_col, model.prediction_col
    model.features_col, model.prediction_col = features_col, out_col
    try:
        return model.transform(df)
    finally:
        model.features_col, model.prediction_col = prev_f, prev_p


def _fit(est_factory, df, features_col, label_col):
    est = est_factory()
    est.features_col, est.label_col = features_col, label_col
    return est.fit(df)


def fit_parallel(jobs, label_col: str, parallelism: int = 8) -> list:
    """Fit independent (factory, df, features_col) jobs from driver threads, as
    ``CrossValidator(parallelism=n)`` does: each fit is a sequence of small
    Spark jobs, so running several at once keeps the executors busy."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max(1, min(parallelism, len(jobs)))) as ex:
        return list(ex.map(lambda j: _fit(j[0], j[1], j[2], label_col), jobs))


@dataclass
class Combined:
    """``stacking=False``: prediction = w·phys + (1−w)·ctx, each base model on
    its own block.  ``stacking=True``: both base models see all features
    (``routing="all"``; ``"group"`` sends each its own block), their
    out-of-fold predictions (``n_folds`` hash folds) plus the features feed an
    elastic net without intercept, and the bases are refitted on all rows."""
    phys_factory: object
    ctx_factory: object
    final_factory: object = None
    weight: float = 0.5
    stacking: bool = False
    routing: str = "all"
    n_folds: int = 5
    label_col: str = "label"
    key_cols: tuple = ("id_mutation",)
    parallelism: int = 8

    def fit(self, df: DataFrame) -> CombinedModel:
        if not self.stacking:
            pm = _fit(self.phys_factory, df, "x_phys", self.label_col)
            cm = _fit(self.ctx_factory, df, "x_ctx", self.label_col)
            return CombinedModel(pm, cm, self.weight)
        pcol, ccol = ("x_all", "x_all") if self.routing == "all" else ("x_phys", "x_ctx")
        folded = df.withColumn("_fold", F.floor(hash_uniform(*self.key_cols, seed="stack")
                                                * F.lit(self.n_folds)).cast("int")).checkpoint()
        jobs = []
        for k in range(self.n_folds):
            tr = folded.filter(F.col("_fold") != k)
            jobs += [(self.phys_factory, tr, pcol), (self.ctx_factory, tr, ccol)]
        jobs += [(self.phys_factory, folded, pcol), (self.ctx_factory, folded, ccol)]
        fitted = fit_parallel(jobs, self.label_col, self.parallelism)
        oof = []
        for k in range(self.n_folds):
            te = folded.filter(F.col("_fold") == k)
            pm, cm = fitted[2 * k], fitted[2 * k + 1]
            oof.append(_predict(cm, _predict(pm, te, pcol, "p_phys"), ccol, "p_ctx"))
        stacked = reduce(DataFrame.unionByName, oof).checkpoint()
        meta = VectorAssembler(inputCols=["p_phys", "p_ctx", "x_all"], outputCol="x_meta").transform(stacked)
        final = _fit(self.final_factory, meta, "x_meta", self.label_col)
        pm, cm = fitted[-2], fitted[-1]
        return CombinedModel(pm, cm, self.weight, final, True, pcol, ccol)


# ---------------------------------------------------------------------------
# Weight search (the weight axis needs no refit)
# ---------------------------------------------------------------------------
def weight_sweep(oof: DataFrame, weights, label_col: str = "label") -> DataFrame:
    """MSE of w·p_phys + (1−w)·p_ctx for every weight, in one aggregate over
    out-of-fold base predictions."""
    y = F.col(label_col)
    aggs = [F.avg(F.pow(y - (F.lit(w) * F.col("p_phys") + F.lit(1 - w) * F.col("p_ctx")), 2)).alias(f"w{i}")
            for i, w in enumerate(weights)]
    row = oof.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(float(w)).alias("weight"), F.col(f"w{i}").alias("mse"))
                      for i, w in enumerate(weights)])
    return row.select(F.explode(pairs).alias("_p")).select("_p.weight", "_p.mse")


def oof_base_predictions(df: DataFrame, phys_factory, ctx_factory, n_folds: int = 3,
                         label_col: str = "label", key_cols=("id_mutation",)) -> DataFrame:
    folded = df.withColumn("_fold", F.floor(hash_uniform(*key_cols, seed="cv")
                                            * F.lit(n_folds)).cast("int")).checkpoint()
    jobs = []
    for k in range(n_folds):
        tr = folded.filter(F.col("_fold") != k)
        jobs += [(phys_factory, tr, "x_phys"), (ctx_factory, tr, "x_ctx")]
    fitted = fit_parallel(jobs, label_col)
    parts = []
    for k in range(n_folds):
        te = folded.filter(F.col("_fold") == k)
        pm, cm = fitted[2 * k], fitted[2 * k + 1]
        parts.append(_predict(cm, _predict(pm, te, "x_phys", "p_phys"), "x_ctx", "p_ctx"))
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------------------
# Shapley values: closed form for linear parts, exact for trees, permutation sampling for others
# ---------------------------------------------------------------------------
def additive_parts(model, n_phys: int, d: int):
    """prediction = constant + w·x_all + Σ aᵢ·partᵢ: the linear models' summed
    coefficients w, and the other parts as (aᵢ, model, features column).  A
    model that does not split is one part with no features column of its own."""
    w = np.zeros(d)
    if not isinstance(model, CombinedModel) or (model.stacking and not hasattr(model.final, "coefficients")):
        return w, [(1.0, model, None)]
    if model.stacking:
        c = model.final.coefficients.toArray()
        shares, w = c[:2], c[2:].copy()
    else:
        shares = (model.weight, 1 - model.weight)
    spans = {"x_all": slice(0, d), "x_phys": slice(0, n_phys), "x_ctx": slice(n_phys, d)}
    others = []
    for a, part, col in zip(shares, (model.phys_model, model.ctx_model), (model.phys_col, model.ctx_col)):
        if hasattr(part, "coefficients"):
            w[spans[col]] += a * part.coefficients.toArray()
        elif a:
            others.append((float(a), part, col))
    return w, others


def linear_shapley(w, rows: DataFrame, means, id_cols) -> DataFrame:
    """(id, feature index, φ) of w·x: φ = w·(x − mean of the background), exact, one pass, no shuffle."""
    bound = F.array(*[F.struct(F.lit(float(a)).alias("w"), F.lit(float(m)).alias("m")) for a, m in zip(w, means)])
    phi = F.zip_with(vector_to_array(F.col("x_all")), bound, lambda v, c: c["w"] * (v - c["m"]))
    return rows.select(*id_cols, F.posexplode(phi).alias("feature", "phi"))


def shapley_values(model, sample: DataFrame, background: list, n_phys: int,
                   n_permutations: int = 8, seed: int = 42, id_col: str = "_sid", means=None) -> DataFrame:
    """(row id, feature index, φ) against the ``background`` rows.

    Linear parts have a closed form, against ``means`` (of any number of rows; None: of the
    background).  Tree parts have exact values (``treeshap``).  The rest is permutation sampling
    (Štrumbelj & Kononenko, 2014): each ``sample`` row (bounded by the caller:
    a top-k sample) meets the permutations and the background (a bounded list)
    as literal arrays.  Sampled rows sit in one partition after a top-k, so the
    (row, background) pairs are spread before the steps multiply them; the
    lag window runs on that same partitioning."""
    d = len(background[0])
    w, others = additive_parts(model, n_phys, d)
    known = np.asarray(background, dtype=float)
    linear = linear_shapley(w, sample, known.mean(axis=0) if means is None else means, [id_col])
    spans, rest = {"x_all": slice(0, d), "x_phys": slice(0, n_phys), "x_ctx": slice(n_phys, d)}, []
    for a, part, col in others:
        if (trees := parts_of(part) if col else None) is None:
            rest.append((a, part, col))
        else:
            linear = linear.unionByName(tree_shapley([(a * v, t) for v, t in trees], sample, known[:, spans[col]], [id_col], col, spans[col].start))
    others = rest
    if not others:
        return linear.groupBy(id_col, "feature").agg(F.sum("phi").alias("phi"))
    rng = np.random.default_rng(seed)
    perms = [rng.permutation(d).tolist() for _ in range(n_permutations)]
    # One entry per (permutation, step j): the first j features of the permutation come from x,
    # and step j adds ``feature``.  Steps and background go in as one JSON literal each.
    steps = []
    for pi, perm in enumerate(perms):
        for j in range(d + 1):
            given = set(perm[:j])
            steps.append({"pi": pi, "j": j, "feature": perm[j - 1] if j else -1,
                          "mask": [f in given for f in range(d)]})
    steps_lit = F.from_json(F.lit(json.dumps(steps)),
                            "array<struct<pi:int,j:int,feature:int,mask:array<boolean>>>")
    bg_lit = F.from_json(F.lit(json.dumps([[float(v) for v in b] for b in background])),
                         "array<array<double>>")
    spread = max(sample.sparkSession.sparkContext.defaultParallelism,
                 int(sample.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pts = (sample.select(F.col(id_col), vector_to_array(F.col("x_all")).alias("_x"), F.posexplode(bg_lit).alias("_bi", "_bg"))
           .repartition(spread, id_col, "_bi")
           .select("*", F.explode(steps_lit).alias("_s")))
    mixed = F.zip_with(F.zip_with("_x", "_bg", lambda x, b: F.struct(x.alias("x"), b.alias("b"))), F.col("_s.mask"),
                       lambda v, m: F.when(m, v["x"]).otherwise(v["b"]))
    pts = pts.select(id_col, "_bi", F.col("_s.pi").alias("_pi"), F.col("_s.j").alias("_j"),
                     F.col("_s.feature").alias("feature"), mixed.alias("_v"))
    scored = pts.select("*", array_to_vector("_v").alias("x_all"), array_to_vector(F.slice("_v", 1, n_phys)).alias("x_phys"),
                        array_to_vector(F.slice("_v", n_phys + 1, d - n_phys)).alias("x_ctx")).drop("_v")
    total = F.lit(0.0)
    for i, (a, part, col) in enumerate(others):
        scored = part.transform(scored).withColumnRenamed("prediction", f"_q{i}") if col is None else _predict(part, scored, col, f"_q{i}")
        total = total + F.lit(a) * F.col(f"_q{i}")
    window = Window.partitionBy(id_col, "_pi", "_bi").orderBy("_j")
    scored = scored.select(id_col, "_pi", "_bi", "_j", "feature", total.alias("_p"))
    contrib = (scored.withColumn("_delta", F.col("_p") - F.lag("_p").over(window))
               .filter(F.col("_j") > 0).groupBy(id_col, "feature").agg(F.avg("_delta").alias("phi")))
    return linear.unionByName(contrib).groupBy(id_col, "feature").agg(F.sum("phi").alias("phi"))


def stacked_shapley(model: CombinedModel, *args, **kwargs) -> DataFrame:
    """``shapley_values`` of a stacked model; the block impact is defined for stacking only."""
    if not model.stacking:
        raise ValueError("block impact needs a stacked model")
    return shapley_values(model, *args, **kwargs)


def group_impact(phi: DataFrame, n_phys: int) -> dict:
    """Share (%) of mean |φ| carried by the physical and contextual blocks."""
    per = phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("m"))
    r = per.agg(F.sum(F.when(F.col("feature") < n_phys, F.col("m")).otherwise(0)).alias("p"),
                F.sum(F.when(F.col("feature") >= n_phys, F.col("m")).otherwise(0)).alias("c")).first()
    tot = (r["p"] or 0) + (r["c"] or 0)
    return {"physical_model_impact": 100.0 * r["p"] / tot if tot else float("nan"),
            "contextual_model_impact": 100.0 * r["c"] / tot if tot else float("nan")}
