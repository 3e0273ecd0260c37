"""Row cleaning (one pushed-down filter) and null handling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.functions.columns import null_safe_sum
from parcelle.schemas import SURFACE_COLUMNS


def total_surface(df: DataFrame):
    """Built + land + five carrez lots, each null read as 0."""
    return null_safe_sum(SURFACE_COLUMNS)


def clean(df: DataFrame, nombre_lots_max: float = 5, valeur_min: float = 0.0,
          valeur_max: float = 1e9, surface_min: float = 0.0,
          surface_max: float = 1e9) -> DataFrame:
    """Keep a sale line iff price and coordinates are present, lots ≤ max and
    price and total surface lie in their inclusive bounds.

    A null ``nombre_lots`` makes ``<=`` null, so the row is dropped — the same
    three-valued rule the original filter has.  Expressed as one ``filter`` so
    Catalyst pushes the simple conjuncts into the parquet/CSV scan.
    """
    surf = total_surface(df)
    v = F.col("valeur_fonciere")
    return df.filter(
        v.isNotNull()
        & F.col("longitude").isNotNull()
        & F.col("latitude").isNotNull()
        & (F.col("nombre_lots") <= F.lit(nombre_lots_max))
        & (v >= F.lit(valeur_min)) & (v <= F.lit(valeur_max))
        & (surf >= F.lit(surface_min)) & (surf <= F.lit(surface_max))
    )


def drop_incomplete(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows with a null in any (or the given) column."""
    return df.dropna(how="any", subset=subset)
