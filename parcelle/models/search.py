"""Grid search of the two-part model without a fit per grid point.

Each block's candidates are fitted once per fold: boosted trees in common passes, with every
smaller tree count read off as a prefix; splines one fit per setting.  The out-of-fold predictions
of all candidates stand side by side in the rows, and one aggregate of their products (one Gram
matrix per fold) gives the squared error of every (physical, contextual, weight) point in closed
form.  1,620 points of boosted trees thus need 2 x 9 models per fold and no further pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelle.functions.columns import hash_uniform
from parcelle.models.combined import CombinedModel, _predict, fit_parallel
from parcelle.models.histtrees import HistBoost, fit_many, fold_specs, staged_predictions
from parcelle.models.regressors import GAM

#: The weight axis and the two grids of the job.
WEIGHTS = [0.1, 0.3, 0.5, 0.7, 0.9]
TREE_GRID = {
    "physical": {"n_estimators": [100, 200], "max_depth": [6, 8, 10], "learning_rate": [0.1, 0.3, 0.5]},
    "contextual": {"n_estimators": [100, 200], "max_depth": [4, 6, 8], "learning_rate": [0.1, 0.3, 0.5]},
}
GAM_GRID = {
    "physical": {"n_splines": [10, 20, 30], "lam": [0.1, 1, 10], "spline_order": [2, 3]},
    "contextual": {"n_splines": [10, 20, 30], "lam": [0.1, 1, 10], "spline_order": [2, 3]},
}


def points(grid: dict) -> list[dict]:
    """All combinations of a grid, in the order of its keys and values."""
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def _tree_oof(rows: DataFrame, grid: dict, fixed: dict, features_col: str, label_col: str, n_folds: int) -> tuple[list[dict], object]:
    """The candidates of a boosted block, and the array column of their out-of-fold predictions."""
    stages = sorted(grid.get("n_estimators", [fixed.get("n_estimators", 100)]))
    shapes = points({k: v for k, v in grid.items() if k != "n_estimators"})
    models = fit_many(rows, fold_specs(shapes, n_folds, fixed | {"n_estimators": stages[-1]}), features_col, label_col, "_fold")
    by_fold = [staged_predictions([(models[s * n_folds + k], stages) for s in range(len(shapes))], features_col) for k in range(n_folds)]
    column = reduce(lambda acc, k: acc.when(F.col("_fold") == k, by_fold[k]), range(1, n_folds), F.when(F.col("_fold") == 0, by_fold[0]))
    return [p | {"n_estimators": n} for p in shapes for n in stages], column


def _gam(p: dict) -> GAM:
    names = {"spline_order": "order"}
    return GAM(**{names.get(k, k): v for k, v in p.items()})


def _gam_oof(rows: DataFrame, grid: dict, fixed: dict, features_col: str, label_col: str, n_folds: int, out: str) -> tuple[list[dict], DataFrame]:
    shapes = [fixed | p for p in points(grid)]
    jobs = [(lambda p=p: _gam(p), rows.filter(F.col("_fold") != k), features_col) for p in shapes for k in range(n_folds)]
    models = fit_parallel(jobs, label_col)
    parts = []
    for k in range(n_folds):
        part = rows.filter(F.col("_fold") == k)
        for s in range(len(shapes)):
            part = _predict(models[s * n_folds + k], part, features_col, f"{out}{s}")
        parts.append(part.withColumn(out, F.array(*[F.col(f"{out}{s}") for s in range(len(shapes))])).drop(*[f"{out}{s}" for s in range(len(shapes))]))
    return points(grid), reduce(DataFrame.unionByName, parts)


def _grams(rows: DataFrame, label_col: str, sizes: tuple[int, int], n_folds: int) -> dict[int, tuple[int, np.ndarray]]:
    """By fold: rows and the matrix of products of (label, physical candidates, contextual candidates)."""
    d = 1 + sum(sizes)
    upper = np.triu_indices(d)
    src = rows.select("_fold", F.concat(F.array(F.col(label_col).cast("double")), "_p", "_c").alias("_v"))

    def partial(batches):
        total, n = np.zeros((n_folds, d, d)), np.zeros(n_folds)
        for b in batches:
            if len(b):
                v, fold = b.column(1).flatten().to_numpy().reshape(len(b), d), b.column(0).to_numpy()
                for k in np.unique(fold):
                    total[k] += v[fold == k].T @ v[fold == k]
                    n[k] += (fold == k).sum()
        for k in np.flatnonzero(n):
            values = np.append(total[k][upper], n[k])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), k, np.int32)), pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)],
                                             names=["fold", "at", "v"])

    cells = src.mapInArrow(partial, "fold int, at int, v double").groupBy("fold", "at").agg(F.sum("v").alias("v")).toPandas()  # folds x candidates squared
    out = {}
    for k, g in cells.groupby("fold"):
        v = g.sort_values("at").v.to_numpy()
        m = np.zeros((d, d))
        m[upper] = v[:-1]
        out[int(k)] = (int(v[-1]), m + np.triu(m, 1).T)
    return out


@dataclass
class SearchResult:
    """``scores``: one row per grid point, best first; ``best_params``; ``best_model`` fitted on all rows (None with refit=False)."""

    scores: DataFrame
    best_params: dict
    best_model: CombinedModel | None


def grid_search(df: DataFrame, grid: dict | None = None, weights=None, fixed: dict | None = None, gam: bool = False, n_folds: int = 3,
                label_col: str = "label", key_cols=("id_mutation",), fold: object = None, refit: bool = True) -> SearchResult:
    """Search ``grid`` (per block, parameter -> values) and ``weights`` by the mean over folds of the squared error.

    Folds are hashes of the key, or the column ``fold`` (0 to n_folds - 1).  Equal errors: the earlier grid point."""
    grid, weights, fixed = grid or (GAM_GRID if gam else TREE_GRID), list(weights or ([0.5] if gam else WEIGHTS)), fixed or {}
    number = fold if fold is not None else F.floor(hash_uniform(*key_cols, seed="cv") * F.lit(n_folds))
    rows = df.select("x_phys", "x_ctx", label_col, number.cast("int").alias("_fold")).checkpoint()
    if gam:
        phys, rows = _gam_oof(rows, grid["physical"], fixed.get("physical", {}), "x_phys", label_col, n_folds, "_p")
        ctx, rows = _gam_oof(rows, grid["contextual"], fixed.get("contextual", {}), "x_ctx", label_col, n_folds, "_c")
    else:
        phys, p = _tree_oof(rows, grid["physical"], fixed.get("physical", {}), "x_phys", label_col, n_folds)
        ctx, c = _tree_oof(rows, grid["contextual"], fixed.get("contextual", {}), "x_ctx", label_col, n_folds)
        rows = rows.withColumn("_p", p).withColumn("_c", c)
    errors = np.zeros((len(weights), len(phys), len(ctx)))
    grams = _grams(rows, label_col, (len(phys), len(ctx)), n_folds)
    a, b = slice(1, 1 + len(phys)), slice(1 + len(phys), None)
    for n, m in grams.values():
        for i, w in enumerate(weights):
            errors[i] += (m[0, 0] - 2 * w * m[0, a][:, None] - 2 * (1 - w) * m[0, b][None] + w * w * np.diag(m)[a][:, None]
                          + (1 - w) ** 2 * np.diag(m)[b][None] + 2 * w * (1 - w) * m[a, b]) / (n * len(grams))
    table = [{"point": k, "physical_weight": float(w), **{f"physical_{x}": float(v) for x, v in p.items()},
              **{f"contextual_{x}": float(v) for x, v in c.items()}, "mse": float(e)}
             for k, ((w, p, c), e) in enumerate(zip(product(weights, phys, ctx), errors.ravel()))]
    best = min(table, key=lambda r: (r["mse"], r["point"]))
    k = best["point"]
    w, p, c = weights[k // (len(phys) * len(ctx))], phys[k // len(ctx) % len(phys)], ctx[k % len(ctx)]
    scores = df.sparkSession.createDataFrame(pd.DataFrame(table))
    scores = scores.withColumn("rank", F.row_number().over(Window.orderBy("mse", "point")))  # one row per grid point
    params = {"physical_weight": w, "physical_params": fixed.get("physical", {}) | p, "contextual_params": fixed.get("contextual", {}) | c}
    model = None
    if refit:
        def estimator(q, col):
            e = _gam(q) if gam else HistBoost(q)
            e.features_col, e.label_col = col, label_col
            return e.fit(df)
        model = CombinedModel(estimator(params["physical_params"], "x_phys"), estimator(params["contextual_params"], "x_ctx"), w)
    return SearchResult(scores, params, model)
