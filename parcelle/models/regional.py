"""One model per region, all regions in the same passes.

A job trains every region by itself.  Here the region is a grouping column from the encoder to the
metrics, and no pass is repeated per region:

* encoder: modes (ties: the smallest) and the categories met, from one count table, quartiles of the filled columns from
  one :func:`wide_quantiles`, all by region;
* fit: n, sums and cross products of (1, features, label) by region in one pass, added up a tree of partials, so that a
  region holding a third of the rows is summed where they lie; the elastic net

      1/(2n) |y - Xw - b|^2 + alpha l1_ratio |w|_1 + alpha (1 - l1_ratio)/2 |w|^2

  needs no more than these sums and is solved in the task that holds a region's total (coordinate descent; least
  squares of smallest norm where alpha is 0);
* artefact: one row per region with encoder, coefficients, intercept and feature means.  Saved and loaded, it scores raw rows.

A one-hot column stands for every category of any region, so vectors have one width; a category not met in a region's
training rows has weight 0 there.  Rows with a null label or region are not learnt; rows of a region without a model get a
null prediction.  A column without any value in a region counts as 0 there.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.operators.encode import wide_quantiles
from parcelle.operators.evaluate import group_share
from parcelle.operators.sizing import maybe_broadcast

#: Partial sums of one region that one task adds.
FAN_IN = 256


def _counts(df: DataFrame, region: str, categorical: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """(region, feature, text, value, n): every non-null value of every column with its count."""
    none_text, none_number = F.lit(None).cast("string"), F.lit(None).cast("double")
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("text"), none_number.alias("value")) for c in categorical]
    pairs += [F.struct(F.lit(c).alias("feature"), none_text.alias("text"), F.col(c).cast("double").alias("value")) for c in numeric]
    long = df.select(F.col(region).alias("_region"), F.explode(F.array(*pairs)).alias("p")).select("_region", "p.*")
    return (long.filter("text is not null or (value is not null and not isnan(value))")
            .groupBy("_region", "feature", "text", "value").agg(F.count(F.lit(1)).alias("n")))


def fit_encoder(df: DataFrame, region: str, categorical: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """One row per region: maps by column of mode_text, mode_number, categories, median, iqr."""
    df = df.filter(F.col(region).isNotNull())
    counts = _counts(df, region, categorical, numeric).checkpoint()
    per = counts.groupBy("_region", "feature").agg(
        F.min_by("text", F.struct(-F.col("n"), F.col("text"))).alias("text"), F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"),
        F.array_sort(F.collect_set("text")).alias("met"))  # as many texts as the column has categories
    is_text = F.col("feature").isin(list(categorical))

    def as_map(keep: Column, value: str) -> Column:
        return F.map_from_entries(F.collect_list(F.when(keep, F.struct("feature", value))))

    modes = per.groupBy("_region").agg(as_map(is_text, "text").alias("mode_text"), as_map(~is_text, "value").alias("mode_number"),
                                       as_map(is_text, "met").alias("categories")).checkpoint()
    named = df.select(F.col(region).alias("_region"), *[F.col(c).cast("double").alias(c) for c in numeric])
    filled = (named.join(maybe_broadcast(modes.select("_region", "mode_number")), "_region")
              .select("_region", *[F.coalesce(F.nanvl(F.col(c), F.lit(None).cast("double")), F.col("mode_number")[c], F.lit(0.0)).alias(c) for c in numeric]))
    q = wide_quantiles(filled, ["_region"], list(numeric))
    at = {p: F.max(F.when(F.col("p") == p, F.col("value"))) for p in (0.25, 0.5, 0.75)}
    spread = q.groupBy("_region", "feature").agg(at[0.5].alias("median"), (at[0.75] - at[0.25]).alias("iqr"))
    everything = F.lit(True)
    scales = spread.groupBy("_region").agg(as_map(everything, "median").alias("median"), as_map(everything, "iqr").alias("iqr"))
    return modes.join(scales, "_region", "left").checkpoint()


def _features(categorical: Sequence[str], numeric: Sequence[str], levels: dict) -> Column:
    """The encoded vector of a raw row that stands beside its region's encoder."""
    hot = [F.coalesce((F.coalesce(F.col(c).cast("string"), F.col("mode_text")[c]) == F.lit(v)) & F.array_contains(F.col("categories")[c], v), F.lit(False)).cast("double")
           for c in categorical for v in levels[c]]
    scaled = []
    for c in numeric:
        x = F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.col("mode_number")[c], F.lit(0.0))
        iqr = F.col("iqr")[c]
        scaled.append((x - F.coalesce(F.col("median")[c], F.lit(0.0))) / F.when((iqr == 0) | iqr.isNull(), F.lit(1.0)).otherwise(iqr))
    return F.array(*hot, *scaled)


def _moments(rows: DataFrame, width: int) -> DataFrame:
    """(_region, m): the (width + 2)^2 cross products of (1, x, label) by region, added up a tree of partials."""
    schema, side = "_region string, _part int, m array<double>", width + 2

    def partial(batches):
        sums: dict = {}
        for pdf in batches:
            for region, at in pdf.groupby("_region", sort=False).indices.items():
                z = np.column_stack([np.ones(len(at)), np.stack(pdf["x"].to_numpy()[at]).reshape(len(at), width), pdf["label"].to_numpy(float)[at]])
                sums[region] = sums.get(region, 0) + z.T @ z
        yield pd.DataFrame({"_region": list(sums), "_part": TaskContext.get().partitionId(), "m": [s.ravel().tolist() for s in sums.values()]})

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.asarray(m) for m in pdf["m"]], axis=0)
        return pd.DataFrame({"_region": [pdf["_region"].iloc[0]], "_part": [int(pdf["_part"].iloc[0]) // FAN_IN], "m": [total.reshape(side * side).tolist()]})

    sums = rows.mapInPandas(partial, schema).checkpoint()
    while True:
        sums = sums.groupBy("_region", F.floor(F.col("_part") / FAN_IN).alias("_to")).applyInPandas(added, schema).checkpoint()
        if (sums.agg(F.max("_part")).first()[0] or 0) == 0:
            return sums.select("_region", "m")


def solve(c: np.ndarray, b: np.ndarray, alpha: float, l1_ratio: float, max_iter: int, tol: float) -> np.ndarray:
    """Weights of the elastic net from the covariances of the features and with the label."""
    if alpha == 0:
        return np.linalg.lstsq(c, b, rcond=None)[0]
    w, l1, l2 = np.zeros(len(b)), alpha * l1_ratio, alpha * (1 - l1_ratio)
    for _ in range(max_iter):
        change = 0.0
        for j in range(len(b)):
            rest = b[j] - c[j] @ w + c[j, j] * w[j]
            new = np.sign(rest) * max(abs(rest) - l1, 0.0) / (c[j, j] + l2) if c[j, j] + l2 > 0 else 0.0
            change, w[j] = max(change, abs(new - w[j])), new
        if change <= tol * max(np.abs(w).max(initial=0.0), 1e-300):
            break
    return w


@dataclass
class RegionalElasticNet:
    categorical: Sequence[str]
    numeric: Sequence[str]
    label: str
    region: str = "region"
    alpha: float = 0.5
    l1_ratio: float = 0.5
    max_iter: int = 1000
    tol: float = 1e-10
    fit_intercept: bool = True

    def fit(self, df: DataFrame) -> RegionalModel:
        known = df.filter(F.col(self.region).isNotNull() & F.col(self.label).isNotNull() & ~F.isnan(F.col(self.label).cast("double")))
        encoder = fit_encoder(known, self.region, self.categorical, self.numeric)
        # distinct categories over the regions: as many as the columns have
        met = encoder.select(F.explode("categories").alias("c", "vs")).select("c", F.explode("vs").alias("v")).distinct().orderBy("c", "v").collect()
        levels = {c: [r["v"] for r in met if r["c"] == c] for c in self.categorical}
        beside = known.withColumnRenamed(self.region, "_region").join(maybe_broadcast(encoder), "_region")
        rows = beside.select(F.col("_region").cast("string").alias("_region"), _features(self.categorical, self.numeric, levels).alias("x"),
                             F.col(self.label).cast("double").alias("label"))
        width = sum(len(v) for v in levels.values()) + len(self.numeric)
        alpha, l1_ratio, max_iter, tol, centred = self.alpha, self.l1_ratio, self.max_iter, self.tol, self.fit_intercept

        def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
            m = np.asarray(pdf["m"].iloc[0]).reshape(width + 2, width + 2)
            n = m[0, 0]
            mean = m[0] / n
            cov = m / n - (np.outer(mean, mean) if centred else 0.0)
            w = solve(cov[1:-1, 1:-1], cov[1:-1, -1], alpha, l1_ratio, max_iter, tol)
            return pd.DataFrame({"_region": pdf["_region"], "n": [int(n)], "intercept": [float(mean[-1] - mean[1:-1] @ w) if centred else 0.0],
                                 "weights": [w.tolist()], "means": [mean[1:-1].tolist()]})

        weights = _moments(rows, width).groupBy("_region").applyInPandas(
            fitted, "_region string, n long, intercept double, weights array<double>, means array<double>")
        table = encoder.withColumn("_region", F.col("_region").cast("string")).join(weights, "_region").withColumns({
            "categorical": F.array(*[F.lit(c) for c in self.categorical]).cast("array<string>"),
            "numeric": F.array(*[F.lit(c) for c in self.numeric]).cast("array<string>"),
            "levels": F.array(*[F.array(*[F.lit(v) for v in levels[c]]) for c in self.categorical]).cast("array<array<string>>"),
            "region_col": F.lit(self.region), "label_col": F.lit(self.label)})
        return RegionalModel(table.checkpoint())


class RegionalModel:
    """``table``: one row per region (see :meth:`RegionalElasticNet.fit`)."""

    def __init__(self, table: DataFrame):
        self.table = table
        head = table.select("region_col", "label_col", "categorical", "numeric", "levels").first()
        if head is None:
            raise ValueError("no rows with a region and a label to learn from")
        self.region, self.label, self.categorical, self.numeric = head[0], head[1], list(head[2]), list(head[3])
        self.levels = dict(zip(self.categorical, [list(v) for v in head[4]]))

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> RegionalModel:
        return RegionalModel(spark.read.parquet(path))

    def feature_names(self) -> list[str]:
        return [f"{c}={v}" for c in self.categorical for v in self.levels[c]] + self.numeric

    def _beside(self, df: DataFrame) -> DataFrame:
        """Raw rows as _row with their region's artefact and the encoded vector _x; rows of other regions have nulls."""
        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(self.region).cast("string").alias("_of"),
                         *[F.col(c) for c in (*self.categorical, *self.numeric)])
        model = maybe_broadcast(self.table.select("_region", "mode_text", "mode_number", "categories", "median", "iqr", "intercept", "weights", "means"))
        return rows.join(model, F.col("_of") == F.col("_region"), "left").withColumn("_x", _features(self.categorical, self.numeric, self.levels))

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """``df`` (raw columns) with ``output``."""
        dot = F.aggregate(F.zip_with("_x", "weights", lambda x, w: x * w), F.lit(0.0), lambda a, b: a + b)
        return self._beside(df).select("_row.*", (F.col("intercept") + dot).alias(output))

    def impact(self, df: DataFrame, groups: dict) -> DataFrame:
        """Shares of the feature groups in the mean |Shapley value| of ``df`` by region: (region, group, impact, share_pct).

        The Shapley value of a linear model is weight x (value - training mean).  One aggregate, one row per region."""
        names = self.feature_names()
        phi = [F.avg(F.abs(F.col("weights")[i] * (F.col("_x")[i] - F.col("means")[i]))) for i in range(len(names))]
        per = self._beside(df).filter(F.col("_region").isNotNull()).groupBy("_region").agg(F.array(*phi).alias("phi"))
        long = per.select(F.col("_region").alias(self.region), F.posexplode("phi").alias("i", "phi"))
        group = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(i), F.lit(groups[n.split("=")[0]]))])
        return group_share(long.select(self.region, F.col("i").alias("feature"), "phi", group[F.col("i")].alias("group")), by=[self.region])
