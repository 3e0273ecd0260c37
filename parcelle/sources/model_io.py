"""Save and load fitted models.

MLlib sub-models (elastic net, trees) use their own writers;
custom ones (boosted trees, a row per tree; GAM coefficients, the combination weight and columns) are
small parquet tables next to them, written by Spark to the same storage.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
from pyspark.sql import SparkSession

from parcelle.models.combined import CombinedModel
from parcelle.models.histtrees import HistModel
from parcelle.models.regressors import BatchBoostModel, GAMModel
from parcelle.models.treeshap import Tree

_MLLIB = {"LinearRegressionModel": LinearRegressionModel, "GBTRegressionModel": GBTRegressionModel}
TREE_COLUMNS = ("feature", "threshold", "left", "right", "value")
TREE_SCHEMA = "tree int, feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>"


def _save_part(spark: SparkSession, model, path: str) -> dict:
    kind = type(model).__name__
    if kind in _MLLIB:
        model.write().overwrite().save(path)
        return {"kind": kind}
    if isinstance(model, GAMModel):
        meta = {"beta": model.beta.tolist(), "ranges": model.ranges, "n_splines": model.n_splines,
                "order": model.order, "features_col": model.features_col}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").parquet(path)
        return {"kind": "GAMModel"}
    if isinstance(model, HistModel):
        trees = [{"tree": i, **{c: getattr(t, c).tolist() for c in TREE_COLUMNS}} for i, t in enumerate(model.trees)]
        spark.createDataFrame(trees, TREE_SCHEMA).write.mode("overwrite").parquet(path)
        return {"kind": "HistModel", "base": model.base, "features_col": model.features_col, "prediction_col": model.prediction_col}
    if isinstance(model, BatchBoostModel):
        if model.ensemble is not None:
            model.ensemble.write().overwrite().save(path)
        return {"kind": "BatchBoostModel", "base": model.base, "trees": model.ensemble is not None,
                "features_col": model.features_col, "prediction_col": model.prediction_col}
    raise TypeError(f"cannot save {kind}")


def _load_part(spark: SparkSession, info: dict, path: str):
    if info["kind"] in _MLLIB:
        return _MLLIB[info["kind"]].load(path)
    if info["kind"] == "BatchBoostModel":
        trees = GBTRegressionModel.load(path) if info["trees"] else None
        return BatchBoostModel(info["base"], trees, info["features_col"], info["prediction_col"])
    if info["kind"] == "HistModel":
        rows = spark.read.schema(TREE_SCHEMA).parquet(path).orderBy("tree").collect()  # one row per tree
        trees = [Tree(*(np.array(r[c], dtype=int if c in ("feature", "left", "right") else float) for c in TREE_COLUMNS)) for r in rows]
        return HistModel(info["base"], trees, info["features_col"], info["prediction_col"])
    meta = json.loads(spark.read.parquet(path).first()["meta"])
    return GAMModel(np.array(meta["beta"]), [tuple(r) for r in meta["ranges"]], meta["n_splines"],
                    meta["order"], meta["features_col"])


def save_combined(spark: SparkSession, model: CombinedModel, path: str) -> None:
    path = path.rstrip("/")
    info = {"weight": model.weight, "stacking": model.stacking, "phys_col": model.phys_col,
            "ctx_col": model.ctx_col,
            "phys": _save_part(spark, model.phys_model, f"{path}/physical"),
            "ctx": _save_part(spark, model.ctx_model, f"{path}/contextual")}
    if model.stacking:
        info["final"] = _save_part(spark, model.final, f"{path}/final")
    spark.createDataFrame([(json.dumps(info),)], "meta string").write.mode("overwrite").parquet(f"{path}/meta")


def load_combined(spark: SparkSession, path: str) -> CombinedModel:
    path = path.rstrip("/")
    info = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
    phys = _load_part(spark, info["phys"], f"{path}/physical")
    ctx = _load_part(spark, info["ctx"], f"{path}/contextual")
    final = _load_part(spark, info["final"], f"{path}/final") if info["stacking"] else None
    return CombinedModel(phys, ctx, info["weight"], final, info["stacking"], info["phys_col"], info["ctx_col"])
