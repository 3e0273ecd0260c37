"""Size checks behind every explicit broadcast.

A side is broadcast only after its row count (one cheap aggregate) times an
upper bound of its row width is under ``parcelle.broadcastLimitBytes``
(default 64 MiB).  Otherwise the join stays a shuffle join and AQE may still
convert or split it at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_LIMIT = 64 * 1024 * 1024


def _width(dt: T.DataType) -> int:
    if isinstance(dt, (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)):
        return 8
    if isinstance(dt, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(dt, (T.ShortType, T.ByteType, T.BooleanType)):
        return 2
    if isinstance(dt, T.StringType):
        return 48
    if isinstance(dt, T.StructType):
        return sum(_width(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return 16 * _width(dt.elementType)
    return 64


def row_width(df: DataFrame) -> int:
    return 16 + sum(_width(f.dataType) + 8 for f in df.schema.fields)


def broadcast_limit(spark) -> int:
    return int(spark.conf.get("parcelle.broadcastLimitBytes", str(DEFAULT_LIMIT)))


def fits_broadcast(df: DataFrame, rows: int | None = None, factor: int = 1) -> bool:
    """True when ``rows × factor × row_width`` is under the broadcast limit."""
    if rows is None:
        rows = df.count()
    return rows * factor * row_width(df) <= broadcast_limit(df.sparkSession)


def maybe_broadcast(df: DataFrame, rows: int | None = None, factor: int = 1) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, rows, factor) else df


def only_counted_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """As ``maybe_broadcast`` for a side of ``rows`` rows made by ``explode``, which Spark's own size estimate
    leaves out: beyond the limit the join is sorted, so that it is not broadcast on that estimate either."""
    return F.broadcast(df) if fits_broadcast(df, rows) else df.hint("merge")
