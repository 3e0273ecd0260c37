"""Incremental landing of transaction files with Structured Streaming.

The original landing step fetches a yearly/departmental file only when it is
not already on disk.  Here the folder of landed files is a streaming file
source: with a checkpoint and ``trigger(availableNow=True)`` each file is
ingested exactly once — a re-run picks up only files that arrived since — and
the batch lands in a parquet table partitioned by (year, departement).
Executor loss is covered by the checkpoint: an unfinished batch is replayed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle.operators.regions import department_code
from parcelle.schemas import TRANSACTION_COLUMNS


def raw_csv_schema(extra_columns=()) -> T.StructType:
    """All-string schema by header name (streaming sources need a schema).
    The file's column order must match; extra source columns can be named."""
    names = [n for n, _ in TRANSACTION_COLUMNS] + list(extra_columns)
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


YEAR_PATTERN = r"/([0-9]{4})/[^/]+$"
DEP_PATTERN = r"/([^/]+)\.csv(\.gz)?$"


def landing_stream(spark: SparkSession, landing_dir: str, schema: T.StructType | None = None,
                   max_files_per_trigger: int | None = None, year_pattern: str = YEAR_PATTERN,
                   dep_pattern: str = DEP_PATTERN) -> DataFrame:
    """Streaming DataFrame over ``<landing_dir>/<year>/<dep>.csv.gz`` files
    (other layouts: give the path patterns for year and department)."""
    # enforceSchema=false: each file's header is checked against the schema's
    # names, so a file with another column order fails instead of shifting.
    r = (spark.readStream.schema(schema or raw_csv_schema()).option("header", True)
         .option("enforceSchema", False)
         .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv.gz"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = r.csv(landing_dir)
    path = F.col("_metadata.file_path")
    typed = [F.expr(f"try_cast(`{n}` as {t.simpleString()})").alias(n) for n, t in TRANSACTION_COLUMNS]
    return raw.select(*typed,
                      F.regexp_extract(path, year_pattern, 1).cast("int").alias("year"),
                      department_code(F.regexp_extract(path, dep_pattern, 1)).alias("departement"),
                      path.alias("file_path"))


def ingest_available(spark: SparkSession, landing_dir: str, table_path: str, checkpoint: str,
                     schema: T.StructType | None = None, **patterns) -> int:
    """Ingest every landed file not yet ingested; returns rows added."""
    q = (landing_stream(spark, landing_dir, schema, **patterns).writeStream
         .format("parquet").option("path", table_path).option("checkpointLocation", checkpoint)
         .partitionBy("year", "departement").trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(p.get("numInputRows", 0) for p in q.recentProgress)


def read_landed(spark: SparkSession, table_path: str) -> DataFrame:
    """The ingested table with its stored types (``departement`` stays a
    string: partition discovery would read "01" as the integer 1)."""
    schema = T.StructType([T.StructField(n, t) for n, t in TRANSACTION_COLUMNS]
                          + [T.StructField("file_path", T.StringType()),
                             T.StructField("year", T.IntegerType()),
                             T.StructField("departement", T.StringType())])
    return spark.read.schema(schema).parquet(table_path)
