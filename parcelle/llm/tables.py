"""Small helpers shared by the operators: row identity, written tables, input size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.operators.sizing import maybe_broadcast
from parcelle.session import checkpoint_dir, scratch_path

#: Of one written or broadcast side whose size is counted first.
BROADCAST_BYTES = 16 << 20
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: lineage is cut, a lost executor
    costs nothing already written, and the next join knows the table's real size.  The shuffle
    files of the write are dropped with it: nothing reads them again."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Identity of a row as two non-null longs, so that null ids, one id on different texts
    and plain repeats are told apart: whole repeats of a row share it, nothing else does."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("_id"),
            F.xxhash64(F.col(text_col), F.col(id_col).isNull()).alias("_h")]


def shuffle_width(spark: SparkSession, rows: int, per_part: int, least: int = 12) -> int:
    """Partitions for ``rows`` rows of a known count."""
    return max(least, -(-rows // per_part))


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """_id, _h (row key) and the whole row as _row: own columns cannot clash with those of ``docs``."""
    return docs.select(*row_key(id_col, text_col), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("_row").getField(c).alias(c) for c in columns])


def without(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose key is not in ``gone`` (_id, _h), with their own columns.

    The keys are broadcast while their counted size allows it, so that the texts are not shuffled."""
    gone = saved(gone.select("_id", "_h").distinct(), "gone")
    return unpacked(packed(docs, id_col, text_col).join(maybe_broadcast(gone), ["_id", "_h"], "left_anti"), docs.columns)
