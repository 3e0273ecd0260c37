"""Calendar features, the mutation roll-up and price per square metre.

The roll-up is one ``groupBy(...).agg(...)``: Spark runs it as a partial
(map-side) hash aggregate followed by a final one, so a sale with very many
lines is combined before the shuffle.  Nothing is collected per group except
``collect_set(type_local)``, whose size is bounded by the handful of property
types, not by the group size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelle.schemas import LOT_COLUMNS


def calendar_features(df: DataFrame, date_col: str = "date_mutation",
                      period_scaled: bool = False) -> DataFrame:
    """``sin_month``/``cos_month`` of month/12 (no 2π factor: kept as the
    original computes it; ``period_scaled=True`` gives 2π·m/12) and ``year``."""
    m = F.month(date_col) / F.lit(12.0)
    if period_scaled:
        m = m * F.lit(2.0 * 3.141592653589793)
    return df.withColumns({
        "sin_month": F.sin(m),
        "cos_month": F.cos(m),
        "year": F.year(date_col),
    })


def fill_surfaces(df: DataFrame) -> DataFrame:
    cols = LOT_COLUMNS + ["surface_reelle_bati", "surface_terrain"]
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0).cast(df.schema[c].dataType))
                           for c in cols})


def sorted_distinct_join(c: str, null_policy: str = "any") -> Column:
    """', '.join(sorted(unique(values))); a group with a null gives 'Unknown'.

    ``null_policy="all"`` gives 'Unknown' only when every value is null.
    """
    joined = F.array_join(F.array_sort(F.collect_set(c)), ", ")
    if null_policy == "any":
        has_null = F.count(c) < F.count(F.lit(1))
    elif null_policy == "all":
        has_null = F.count(c) == F.lit(0)
    else:
        raise ValueError("null_policy must be 'any' or 'all'")
    return F.when(has_null, F.lit("Unknown")).otherwise(joined)


def rollup_mutations(df: DataFrame, order_cols=("seq1", "seq2", "seq3"),
                     partition_cols=(), null_policy: str = "any") -> DataFrame:
    """Roll sale lines up into sales keyed by (id_mutation, valeur_fonciere).

    ``order_cols`` is the file order used for "first" (year, month features,
    coordinates): ``min_by`` over an explicit sequence is deterministic after
    a shuffle, unlike ``first()``.  ``partition_cols`` (e.g. region and file
    year) scope the key like the original per-region, per-year loads.
    """
    df = fill_surfaces(calendar_features(df))
    order = F.struct(*[F.col(c) for c in order_cols])
    first = F.min_by(F.struct("year", "sin_month", "cos_month", "longitude", "latitude"),
                     order).alias("_first")
    aggs = [
        F.sum("surface_reelle_bati").alias("surface_reelle_bati"),
        first,
        sorted_distinct_join("type_local", null_policy).alias("type_local"),
        F.max("nombre_lots").alias("nombre_lots"),
        *[F.avg(c).alias(c) for c in LOT_COLUMNS],
        F.coalesce(F.sum("nombre_pieces_principales"), F.lit(0.0)).alias("nombre_pieces_principales"),
        F.sum("surface_terrain").alias("surface_terrain"),
    ]
    keys = [*partition_cols, "id_mutation", "valeur_fonciere"]
    out = df.groupBy(*keys).agg(*aggs)
    return out.select(*keys, "surface_reelle_bati",
                      *[F.col(f"_first.{c}").alias(c) for c in ("year", "sin_month", "cos_month")],
                      "type_local", "nombre_lots", *LOT_COLUMNS,
                      "nombre_pieces_principales", "surface_terrain",
                      F.col("_first.longitude").alias("longitude"),
                      F.col("_first.latitude").alias("latitude"))


def price_per_m2(df: DataFrame) -> DataFrame:
    """``total_surface_carrez`` and ``prix_m2`` (first positive divisor of
    carrez → land → built; null when none is positive)."""
    total = sum((F.col(c).cast("double") for c in LOT_COLUMNS[1:]),
                F.col(LOT_COLUMNS[0]).cast("double"))
    df = df.withColumn("total_surface_carrez", total)
    v = F.col("valeur_fonciere")
    prix = (F.when(F.col("total_surface_carrez") > 0, v / F.col("total_surface_carrez"))
            .when(F.col("surface_terrain") > 0, v / F.col("surface_terrain"))
            .when(F.col("surface_reelle_bati") > 0, v / F.col("surface_reelle_bati")))
    return df.withColumn("prix_m2", prix)


def price_band(df: DataFrame, lo: float = 0.0, hi: float = 1e6) -> DataFrame:
    """``lo < prix_m2 <= hi`` (strict lower bound, inclusive upper bound)."""
    return df.filter((F.col("prix_m2") > F.lit(lo)) & (F.col("prix_m2") <= F.lit(hi)))


def create_features(df: DataFrame, prix_min: float = 0.0, prix_max: float = 1e6,
                    order_cols=("seq1", "seq2", "seq3"), partition_cols=(),
                    null_policy: str = "any") -> DataFrame:
    """Roll-up + carrez total + price per m² + band filter."""
    out = rollup_mutations(df, order_cols, partition_cols, null_policy)
    return price_band(price_per_m2(out), prix_min, prix_max)
