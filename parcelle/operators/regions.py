"""Region dimension and the region lookup join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.schemas import REGIONS


def region_dimension(spark: SparkSession, regions: dict | None = None) -> DataFrame:
    """(region, departement): one row per department (96 rows for the fixed map)."""
    regions = regions or REGIONS
    rows = [(r, d) for r, deps in regions.items() for d in deps]
    return spark.createDataFrame(rows, "region string, departement string")


def department_code(c) -> F.Column:
    """Two-character department code: integers are left-padded ("1" → "01")."""
    s = F.trim(F.col(c).cast("string")) if isinstance(c, str) else F.trim(c.cast("string"))
    return F.when(s.rlike("^[0-9]$"), F.lpad(s, 2, "0")).otherwise(s)


def with_region(df: DataFrame, dep_col: str = "departement",
                regions: dict | None = None) -> DataFrame:
    """Inner join on the department: departments outside the map drop out.

    The dimension is a fixed, bounded list (≈100 rows), so it is broadcast:
    the fact side is never shuffled for this lookup.
    """
    dim = region_dimension(df.sparkSession, regions)
    return df.join(F.broadcast(dim), df[dep_col] == dim["departement"], "inner").drop(dim["departement"])
