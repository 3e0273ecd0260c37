"""Deterministic splits, folds, batches and samples.

Everything is a function of a hash of the row key, never of ``rand()`` or
row position: a recomputed partition (executor loss, AQE re-plan, a
different ``spark.sql.shuffle.partitions``) gets exactly the same labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.functions.columns import hash_uniform


def hash_split(df: DataFrame, key_cols, train_fraction: float = 0.8, seed: str = "",
               col: str = "split") -> DataFrame:
    """Label rows 'train' (uniform < fraction) or 'test' (the rest)."""
    u = hash_uniform(*key_cols, seed=seed)
    return df.withColumn(col, F.when(u < F.lit(train_fraction), "train").otherwise("test"))


def kfold(df: DataFrame, key_cols, k: int = 3, seed: str = "fold", col: str = "fold") -> DataFrame:
    """Fold id in [0, k) from a seeded hash of the key."""
    return df.withColumn(col, F.floor(hash_uniform(*key_cols, seed=seed) * F.lit(k)).cast("int"))


def hash_batches(df: DataFrame, key_cols, batch_size: int, n_rows: int | None = None,
                 seed: str = "batch", col: str = "batch_id") -> DataFrame:
    """About ``batch_size`` rows per batch, ceil(n / batch_size) batches."""
    n = df.count() if n_rows is None else n_rows
    n_batches = max(1, -(-n // batch_size))
    return df.withColumn(col, F.floor(hash_uniform(*key_cols, seed=seed) * F.lit(n_batches)).cast("int"))


def global_row_index(df: DataFrame, order_cols, col: str = "row_index") -> DataFrame:
    """0-based position in the total order of ``order_cols`` (which must be
    unique), without a single-partition window.

    Range-partition and sort on the order, read each partition's row count
    (one small row per partition to the driver), and add the prefix offset of
    the partition to the row's position inside it.  The sorted table is
    checkpointed first so both passes see the same partitioning.
    """
    spark = df.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (df.repartitionByRange(n_parts, *order_cols)
               .sortWithinPartitions(*order_cols)
               .withColumn("_pid", F.spark_partition_id())
               .withColumn("_mid", F.monotonically_increasing_id())
               .checkpoint())
    stats = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("n"), F.min("_mid").alias("m0")).collect()
    offsets, run = [], 0
    for r in sorted(stats, key=lambda r: r["_pid"]):
        offsets.append((r["_pid"], run, r["m0"]))
        run += r["n"]
    off = spark.createDataFrame(offsets, "_pid int, _off long, _m0 long")
    return (ordered.join(F.broadcast(off), "_pid")
            .withColumn(col, F.col("_off") + F.col("_mid") - F.col("_m0"))
            .drop("_pid", "_mid", "_off", "_m0"))


def exact_batches(df: DataFrame, order_cols, batch_size: int, col: str = "batch_id") -> DataFrame:
    """Contiguous batches [i·B, (i+1)·B) of the total order."""
    idx = global_row_index(df, order_cols, "_ri")
    return idx.withColumn(col, F.floor(F.col("_ri") / F.lit(batch_size)).cast("int")).drop("_ri")


def hash_sample(df: DataFrame, key_cols, fraction: float, seed: str = "sample") -> DataFrame:
    """Deterministic row-fraction sample (the hash form of ``sample(frac)``)."""
    return df.filter(hash_uniform(*key_cols, seed=seed) < F.lit(fraction))


def sample_k(df: DataFrame, key_cols, k: int, seed: str = "pick", tie_cols=()) -> DataFrame:
    """k rows without replacement (all rows when fewer): the k smallest seeded
    hashes — a top-k, so Spark keeps only k rows per partition before merging."""
    u = hash_uniform(*key_cols, seed=seed)
    return (df.withColumn("_u", u).orderBy("_u", *key_cols, *tie_cols).limit(k).drop("_u"))
