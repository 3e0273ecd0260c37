"""Landing of transaction files as they come: any columns in any order, each file once, with a manifest.

The folder of files is a file stream by path (``availableNow``).  Each micro-batch looks into its own new files only:
their headers are read, files that do not read to their end are put aside, and the others are read
header by header at full width, projected by name and typed.  Rows land in ``<table>/batch=<id>``, which a replayed
batch overwrites; last, the batch's manifest (path, header, error, rows) is written.  The manifest is the
commit log: rows of a batch without one are not read.  Plans that scan the table need no look into the files again.

A file without any used column gives rows of nulls; an empty file has an empty header and no rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle.operators.regions import department_code
from parcelle.operators.sizing import maybe_broadcast
from parcelle.schemas import TRANSACTION_COLUMNS
from parcelle.sources.transactions import _inspect, _typed
from parcelle.streaming.landing import DEP_PATTERN, YEAR_PATTERN

MANIFEST = "path string, header string, error string, rows long, batch long"
LANDED = T.StructType([T.StructField(n, t) for n, t in TRANSACTION_COLUMNS] + [
    T.StructField("year", T.IntegerType()), T.StructField("departement", T.StringType()),
    T.StructField("row_seq", T.LongType()), T.StructField("file_path", T.StringType())])


def _by_header(spark: SparkSession, files: list) -> DataFrame:
    """The rows of ``files`` (path, header), one read per header, with file_path and row_seq."""
    groups: dict[str, list[str]] = {}
    for path, header in files:
        groups.setdefault(header, []).append(path)
    out = spark.createDataFrame([], LANDED).drop("year", "departement", "row_seq")
    for paths in groups.values():
        part = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(paths)
        out = out.unionByName(_typed(part.withColumn("file_path", F.col("_metadata.file_path"))))
    return out.withColumn("row_seq", F.monotonically_increasing_id())


def ingest_files(spark: SparkSession, landing_dir: str, table_path: str, checkpoint: str, year_pattern: str = YEAR_PATTERN,
                 dep_pattern: str = DEP_PATTERN, max_files_per_trigger: int = 1000) -> int:
    """Land every file not landed yet; returns the rows added.  The manifest is kept below ``<table>_manifest``."""
    table_path = table_path.rstrip("/")
    added = []

    def land(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        seen = batch.select("path", "content").mapInArrow(_inspect, "path string, header string, error string").checkpoint()
        good = [(r["path"], r["header"]) for r in seen.filter("error is null and header != ''").collect()]  # a trigger's files
        folder = f"{table_path}/batch={batch_id}"
        rows = _by_header(s, good).withColumns({
            "year": F.regexp_extract("file_path", year_pattern, 1).cast("int"),
            "departement": department_code(F.regexp_extract("file_path", dep_pattern, 1))})
        # Dealt out anew: a scan task packs files by compressed size, and the write sorts all rows of its task.
        rows.select(*LANDED.names).hint("rebalance", "year", "departement").write.mode("overwrite").option("maxRecordsPerFile", 5_000_000).partitionBy("year", "departement").parquet(folder)
        counts = s.read.schema(LANDED).parquet(folder).groupBy("file_path").agg(F.count(F.lit(1)).alias("rows"))
        # Both name files of one trigger; their paths differ in the slashes behind the scheme.
        plain = [F.regexp_replace(c, "^file:/+", "/") for c in ("path", "file_path")]
        entry = (seen.withColumn("_p", plain[0]).join(counts.select(plain[1].alias("_p"), "rows"), "_p", "left")
                 .select("path", "header", "error", F.coalesce("rows", F.lit(0)).cast("long").alias("rows")))
        entry.coalesce(1).write.mode("overwrite").parquet(f"{table_path}_manifest/batch={batch_id}")
        added.append(batch_id)

    stream = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv*")
              .option("maxFilesPerTrigger", max_files_per_trigger).load(landing_dir))
    stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    if not added:
        return 0
    return manifest(spark, table_path).filter(F.col("batch").isin(added)).agg(F.sum("rows")).first()[0] or 0


def manifest(spark: SparkSession, table_path: str) -> DataFrame:
    """(path, header, error, rows, batch) of every file looked at."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{table_path.rstrip('/')}_manifest")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], MANIFEST)
        raise


def read_files_landed(spark: SparkSession, table_path: str) -> DataFrame:
    """The landed rows; (``file_path``, ``row_seq``) is the files' own order."""
    done = manifest(spark, table_path).select("batch").distinct()
    try:
        rows = spark.read.schema(T.StructType([*LANDED.fields, T.StructField("batch", T.LongType())])).parquet(table_path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], LANDED)
        raise
    return rows.join(maybe_broadcast(done), "batch", "left_semi").select(*LANDED.names)
