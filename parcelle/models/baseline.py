"""Group-mean regressor: the reference point every fitted model must beat.

Prediction = mean target of the training rows sharing the group key (falls
back to the global training mean for an unseen group).  Exact in SQL, so the
evaluation operators built on it are checked against DuckDB.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.operators.sizing import maybe_broadcast


@dataclass
class GroupMeanModel:
    keys: list
    means: DataFrame
    overall: float
    output: str = "prediction"

    def transform(self, df: DataFrame) -> DataFrame:
        # ``means`` has one row per group key value and is broadcast after a
        # size check at fit time: the scored side is not shuffled for a
        # category-sized table (a shuffle join remains beyond the limit).
        return (df.join(self.means, self.keys, "left")
                .withColumn(self.output, F.coalesce(F.col("_gm"), F.lit(self.overall)))
                .drop("_gm"))


class GroupMeanRegressor:
    def __init__(self, keys, label: str):
        self.keys, self.label = list(keys), label

    def fit(self, df: DataFrame) -> GroupMeanModel:
        # One pass over the data: per-group sums and counts, materialised in
        # the shared checkpoint folder; the global mean and the table's row
        # count then come from that small table, not from the data again.
        stats = (df.groupBy(*self.keys)
                 .agg(F.sum(self.label).alias("_s"), F.count(self.label).alias("_n"))
                 .checkpoint())
        tot = stats.agg(F.sum("_s"), F.sum("_n"), F.count(F.lit(1))).first()
        overall = tot[0] / tot[1] if tot[1] else None
        means = stats.select(*self.keys, F.when(F.col("_n") > 0, F.col("_s") / F.col("_n")).alias("_gm"))
        return GroupMeanModel(self.keys, maybe_broadcast(means, rows=tot[2]), overall)
