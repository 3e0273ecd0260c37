"""Resumable enrichment: process only the keys a saved partial result lacks.

The original saves partial results every N rows and, on restart, skips the
rows whose key is already saved.  As a Spark job: a null-safe left-anti join
of the input keys against the saved table, the enrichment on the rest, and
the union — each run is idempotent and the final table equals a full run.

:func:`enrich_in_chunks` saves as it goes.  The rows still to do are written once, dealt into chunks by
a hash of their key; each chunk is enriched, written to a folder of its own and then entered in a commit table (one
small file a row, which appears whole or not at all).  A job that is killed loses the chunk it was in:
the next call reads the commits, overwrites what that chunk left behind and goes on from there.
Keys that came after the rows were dealt out are a further run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A run's entry for its dealt-out rows, in the place of a chunk's number.
DEALT = -1
COMMITS = "run int, chunk int, rows long"


def remaining(todo: DataFrame, done: DataFrame, keys) -> DataFrame:
    """Rows of ``todo`` whose key (compared null-safely) is not in ``done``."""
    keys = list(keys)
    d = done.select(*[F.col(k).alias(f"_d_{k}") for k in keys]).distinct()
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_d_{k}")) for k in keys])
    return todo.join(d, cond, "left_anti")


def resume(todo: DataFrame, done: DataFrame, keys, enrich) -> DataFrame:
    """``done`` ∪ ``enrich(remaining(todo, done))``."""
    rest = enrich(remaining(todo, done, keys))
    return done.unionByName(rest.select(*done.columns))


def commits(spark: SparkSession, path: str) -> dict:
    """{(run, chunk): rows} entered so far: as many entries as chunks were run."""
    try:
        return {(r["run"], r["chunk"]): r["rows"] for r in spark.read.schema(COMMITS).parquet(f"{path}/commits").collect()}
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise


def _enter(spark: SparkSession, path: str, run: int, chunk: int, rows: int) -> None:
    spark.createDataFrame([(run, chunk, rows)], COMMITS).coalesce(1).write.mode("append").parquet(f"{path}/commits")


def _counted(df: DataFrame, path: str, *by: str) -> int:
    """Write ``df`` over ``path`` and count its rows on the way."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").partitionBy(*by).parquet(path)
    return seen.get["n"]


def enrich_in_chunks(todo: DataFrame, keys, enrich, path: str, chunks: int = 64) -> DataFrame:
    """``enrich(todo)`` for an ``enrich`` that treats rows of different keys apart, saved chunk by chunk below ``path``.

    Rows of one key stay in one chunk (null keys are a key).  The result holds, once, every row enriched by this
    and earlier calls on ``path``; keys saved before are not enriched again (``enrich`` keeps the key columns; a key without a
    result is tried again).  ``chunks`` bounds the loop, not the rows."""
    spark, keys, path = todo.sparkSession, list(keys), path.rstrip("/")
    known = commits(spark, path)
    opened = [r for r, c in known if c == DEALT]
    for run in sorted(opened):
        _finish(spark, enrich, path, run, chunks, known, todo)
    done = saved(spark, path)
    rest = todo if done is None else remaining(todo, done, keys)
    run = max(opened, default=-1) + 1
    dealt = rest.withColumn("_chunk", F.pmod(F.xxhash64(*keys), F.lit(chunks)).cast("int"))
    # A chunk is written by as many tasks as its size asks for.
    n = _counted(dealt.hint("rebalance", F.col("_chunk")), f"{path}/todo/run={run}", "_chunk")
    if n or done is None:
        _enter(spark, path, run, DEALT, n)
        _finish(spark, enrich, path, run, chunks, commits(spark, path), todo)
    return saved(spark, path)


def _finish(spark: SparkSession, enrich, path: str, run: int, chunks: int, known: dict, todo: DataFrame) -> None:
    """Enrich and enter the chunks of ``run`` that have no entry; a run without rows enters one empty chunk, for its columns."""
    dealt = spark.read.schema(T.StructType([*todo.schema.fields, T.StructField("_chunk", T.IntegerType())])).parquet(f"{path}/todo/run={run}")
    with_rows = sorted(r["_chunk"] for r in dealt.select("_chunk").distinct().collect())  # at most ``chunks``
    for chunk in with_rows or [0]:
        if (run, chunk) not in known:
            rows = _counted(enrich(dealt.filter(F.col("_chunk") == chunk).drop("_chunk")), f"{path}/data/run={run}/chunk={chunk}")
            _enter(spark, path, run, chunk, rows)


def saved(spark: SparkSession, path: str) -> DataFrame | None:
    """Everything entered so far (None: nothing): folders without an entry are left out."""
    path = path.rstrip("/")
    folders = [f"{path}/data/run={r}/chunk={c}" for r, c in sorted(commits(spark, path)) if c != DEALT]
    return spark.read.parquet(*folders) if folders else None
