"""Population grid, POI points and database tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from parcelle.schemas import POI_COUNT_COLUMNS

GRID_SCHEMA = T.StructType(
    [T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType()),
     T.StructField("densite", T.DoubleType())]
    + [T.StructField(c, T.LongType()) for c in POI_COUNT_COLUMNS])

POI_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("poi_id", T.LongType()), ("lon", T.DoubleType()), ("lat", T.DoubleType()),
    ("amenity", T.StringType()), ("shop", T.StringType()), ("leisure", T.StringType()),
    ("public_transport", T.StringType()), ("tourism", T.StringType()), ("name", T.StringType())]])


def read_grid(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Enriched grid CSV (header).  A fixed schema is preferred to inference:
    inference costs a full extra pass over the file."""
    r = spark.read.option("header", True)
    if infer:
        return r.option("inferSchema", True).csv(path)
    df = r.csv(path)
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in GRID_SCHEMA.fields
                       if f.name in df.columns])


def read_raster(spark: SparkSession, path: str) -> DataFrame:
    """Population raster X, Y, Z → lon, lat, densite."""
    df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    return df.withColumnsRenamed({"X": "lon", "Y": "lat", "Z": "densite"})


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower: int, upper: int, num_partitions: int, properties: dict | None = None) -> DataFrame:
    """Parallel JDBC scan split on a numeric column (needs the driver's jar on
    the classpath; not exercised here — no database is available)."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=num_partitions,
                           properties=properties or {})
