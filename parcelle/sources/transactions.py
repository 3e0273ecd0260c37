"""Transaction files: ``<base>/<year>/<departement>.csv.gz`` and the parquet
layout we rewrite them to.

Spark applies the header of one file to all files of a CSV read by position, so
files are first grouped by their own header (one distributed pass, which also
inflates every file and so finds truncated ones) and each group is read by
itself at full width; then the 15 used columns are projected by name and typed
with ``try_cast``: a bad cell becomes null, the row stays.  A file that cannot
be read to its end is left out whole and reported by ``bad_transaction_files``.
Year and department come from the file path.  gz files are not splittable; the
recommended layout is a one-off rewrite to parquet partitioned by
(year, departement), where filters prune directories natively.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle.operators.regions import department_code
from parcelle.schemas import TRANSACTION_COLUMNS


def _typed(df: DataFrame) -> DataFrame:
    cols = []
    for name, dtype in TRANSACTION_COLUMNS:
        if name in df.columns:
            cols.append(F.expr(f"try_cast(`{name}` as {dtype.simpleString()})").alias(name))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    extra = [c for c in ("year", "departement", "row_seq", "file_path") if c in df.columns]
    return df.select(*cols, *extra)


# Where year and department sit in a file path, per layout: the yearly
# download's ``<year>/<dep>.csv.gz`` files, or the directories Spark's
# partitioned writer makes (``year=<year>/departement=<dep>/part-*``).
LAYOUTS = {
    "files": ("{base}/{y}/{d}.csv.gz", r"/([0-9]{4})/[^/]+$", r"/([^/]+)\.csv(\.gz)?$"),
    "partitioned": ("{base}/year={y}/departement={d}/*.csv.gz", r"/year=([0-9]{4})/",
                    r"/departement=([^/]+)/"),
}


def transaction_paths(base: str, years=(), departements=(), layout: str = "files") -> str:
    """One glob over the chosen years × departments (empty list = all);
    combinations without a file simply match nothing."""
    base = base.rstrip("/")
    ys = [str(y) for y in years]
    ds = [str(d) if len(str(d)) >= 2 else f"{int(d):02d}" for d in departements]
    y = "{" + ",".join(ys) + "}" if ys else "*"
    d = "{" + ",".join(ds) + "}" if ds else "*"
    return LAYOUTS[layout][0].format(base=base, y=y, d=d)


def _inspect(batches):
    """path, header, error of every file: the whole file is inflated, a megabyte at a time."""
    import zlib

    import pyarrow as pa
    for b in batches:
        out = []
        for path, content in zip(b.column(0).to_pylist(), b.column(1)):
            data, head, error = memoryview(content.as_buffer()), bytearray(), None
            try:
                if not path.endswith(".gz"):
                    head += bytes(data[:1 << 20])
                while path.endswith(".gz") and len(data):
                    z = zlib.decompressobj(31)
                    while not z.eof and len(data):
                        got = z.decompress(data, 1 << 20)
                        data = memoryview(z.unconsumed_tail)
                        if b"\n" not in head:
                            head += got
                    if not z.eof:
                        raise EOFError("the file ends before its gzip stream does")
                    data = memoryview(z.unused_data)
            except (zlib.error, EOFError) as e:
                error = str(e)
            out.append((path, bytes(head.split(b"\n", 1)[0]).decode("utf-8", "replace").strip("\r\ufeff"), error))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.string()) for i in range(3)], names=["path", "header", "error"])


def inspect_transaction_files(spark: SparkSession, base: str, years=(), departements=(), layout: str = "files") -> DataFrame:
    """(path, header, error) of every file found; error is null for a file that reads to its end."""
    from pyspark.errors import AnalysisException
    try:
        files = spark.read.format("binaryFile").load(transaction_paths(base, years, departements, layout))
    except AnalysisException:  # no file at all
        return spark.createDataFrame([], "path string, header string, error string")
    return files.select("path", "content").mapInArrow(_inspect, "path string, header string, error string")


def bad_transaction_files(spark: SparkSession, base: str, years=(), departements=(), layout: str = "files") -> DataFrame:
    """(path, error) of the files that the scan leaves out."""
    return inspect_transaction_files(spark, base, years, departements, layout).filter("error IS NOT NULL").select("path", "error")


def read_transactions(spark: SparkSession, base: str, years=(), departements=(),
                      fraction: float | None = None, seed: int = 42,
                      layout: str = "files") -> DataFrame:
    """Scan the yearly/departmental CSV files (empty list = all).

    Missing files are skipped, files that cannot be read to their end are left
    out whole, like the per-file ``try/except`` of the original loader.
    (``file_path``, ``row_seq``) gives the file order that the roll-up's
    "first" needs.
    """
    from parcelle.schemas import TRANSACTION_SCHEMA
    _, year_re, dep_re = LAYOUTS[layout]
    groups: dict[str, list[str]] = {}
    for r in inspect_transaction_files(spark, base, years, departements, layout).filter("error IS NULL").toLocalIterator():  # a row per file
        groups.setdefault(r["header"], []).append(r["path"])
    raw = None
    for paths in groups.values():  # as many reads as there are different headers
        part = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(paths)
        part = _typed(part.withColumn("file_path", F.col("_metadata.file_path")))
        raw = part if raw is None else raw.unionByName(part)
    if raw is None:  # no file at all: an empty table, as the original loader
        empty = spark.createDataFrame([], TRANSACTION_SCHEMA)
        return empty.withColumns({"year": F.lit(None).cast("int"),
                                  "departement": F.lit(None).cast("string"),
                                  "row_seq": F.lit(None).cast("long"),
                                  "file_path": F.lit(None).cast("string")})
    raw = raw.withColumns({
        "year": F.regexp_extract("file_path", year_re, 1).cast("int"),
        "departement": department_code(F.regexp_extract("file_path", dep_re, 1)),
        # a gz file is one split, so the id grows along the file order
        "row_seq": F.monotonically_increasing_id(),
    })
    out = _typed(raw)
    if fraction is not None:
        # by content: another partitioning picks the same rows
        own = F.xxhash64(F.lit(seed), *[name for name, _ in TRANSACTION_COLUMNS], "year", "departement")
        out = out.filter(F.shiftrightunsigned(own, 11).cast("double") < F.lit(fraction * float(2 ** 53)))
    return out


def missing_transaction_files(spark: SparkSession, base: str, years, departements,
                              layout: str = "files") -> list[tuple[int, str]]:
    """(year, departement) pairs that were asked for but have no file — the
    ones the scan skips.  Read from the file listing only (no data pass)."""
    import re
    from pyspark.errors import AnalysisException
    ds = [str(d) if len(str(d)) >= 2 else f"{int(d):02d}" for d in departements]
    _, year_re, dep_re = LAYOUTS[layout]
    try:
        files = spark.read.format("binaryFile").load(
            transaction_paths(base, years, ds, layout)).inputFiles()
    except AnalysisException:
        files = []
    found = set()
    for f in files:
        y, d = re.search(year_re, f), re.search(dep_re, f)
        if y and d:
            found.add((int(y.group(1)), d.group(1)))
    return [(int(y), d) for y in years for d in ds if (int(y), d) not in found]


def write_transactions_parquet(df: DataFrame, path: str) -> None:
    """One-off rewrite to parquet partitioned by (year, departement).

    A scan task packs gz files by their compressed size, and a partitioned
    write sorts all rows of its task, so the rows are first dealt out anew: the
    rebalance hint lets AQE split a hot department over several tasks of the
    advisory size and merge small ones.  ``maxRecordsPerFile`` bounds the output file size."""
    (df.hint("rebalance", "year", "departement").write.mode("overwrite").option("maxRecordsPerFile", 5_000_000)
     .partitionBy("year", "departement").parquet(path))


def write_transactions_csv(df: DataFrame, path: str) -> None:
    """Land sale lines as gzip CSV with a header, one directory per
    (year, departement) — the ``partitioned`` layout of ``read_transactions``.
    The rebalance hint lets AQE split a hot department over several tasks
    and merge small ones, instead of one task per key."""
    (df.hint("rebalance", "year", "departement").write.mode("overwrite")
     .option("header", True).option("compression", "gzip")
     .partitionBy("year", "departement").csv(path))


def stored_schema():
    """Schema of the rewritten table: source types, then the partition
    columns.  Given on read, it keeps ``departement`` a string ("01", "2A"):
    partition discovery would otherwise infer "01" as the integer 1."""
    from parcelle.schemas import TRANSACTION_SCHEMA
    return (T.StructType(list(TRANSACTION_SCHEMA.fields))
            .add("year", T.IntegerType()).add("departement", T.StringType()))


def read_transactions_parquet(spark: SparkSession, path: str, years=(), departements=()) -> DataFrame:
    """Scan the (year, departement)-partitioned parquet table; the filters are
    on partition columns, so only the chosen directories are listed and read."""
    df = spark.read.schema(stored_schema()).parquet(path)
    if years:
        df = df.filter(F.col("year").isin([int(y) for y in years]))
    if departements:
        ds = [str(d) if len(str(d)) >= 2 else f"{int(d):02d}" for d in departements]
        df = df.filter(F.col("departement").isin(ds))
    return df
