"""Distance joins: POI counts around grid cells, exact kNN with inverse-distance
weights.

Neither join is a nested loop.  The radius joins hash both sides into square
(or cubic) cells of side r, replicate the smaller side to its 3×3 (3×3×3)
neighbour cells, equi-join on the cell id and keep the exact predicate as a
post-filter — Catalyst plans a hash join instead of a
``BroadcastNestedLoopJoin``.  POIs are pre-aggregated by exact coordinates
before the join, grid keys by multiplicity, so dense city cells shrink before
any shuffle.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle.functions.columns import MERCATOR_RADIUS, haversine, mercator_x, mercator_y, unit_xyz
from parcelle.operators.sizing import maybe_broadcast, only_counted_broadcast
from parcelle.schemas import (
    CULTURAL_VALUES, EDUCATION_VALUES, ENTERTAINMENT_VALUES, EXCLUSIVE_CULTURAL,
    EXCLUSIVE_ENTERTAINMENT, EXCLUSIVE_HEALTHCARE, EXCLUSIVE_OUTPUT_COLUMNS,
    EXCLUSIVE_RESTAURANTS, EXCLUSIVE_SCHOOLS, EXCLUSIVE_SHOPS, FOOD_VALUES,
    GRID_MEASURES, HEALTH_VALUES, PARK_LEISURE_VALUES, POI_COUNT_COLUMNS,
    SHOPPING_AMENITY_VALUES, TRANSPORT_VALUES,
)

def _off2() -> Column:
    """The 3×3 neighbour offsets as an array literal (exploded per row)."""
    return F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy"))
                     for i in (-1, 0, 1) for j in (-1, 0, 1)])


def _off3() -> Column:
    return F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy"), F.lit(k).alias("dz"))
                     for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)])


# ---------------------------------------------------------------------------
# POI tag classification
# ---------------------------------------------------------------------------
def category_flags() -> dict[str, Column]:
    """Eight independent (multi-label) categories of a POI row."""
    a = F.col("amenity")
    return {
        "transport_pois": F.col("public_transport").isin(TRANSPORT_VALUES),
        "education_pois": a.isin(EDUCATION_VALUES),
        "health_pois": a.isin(HEALTH_VALUES),
        "food_pois": a.isin(FOOD_VALUES),
        "shopping_pois": a.isin(SHOPPING_AMENITY_VALUES) | F.col("shop").isNotNull(),
        "park_pois": F.col("leisure").isin(PARK_LEISURE_VALUES),
        "entertainment_pois": a.isin(ENTERTAINMENT_VALUES),
        "cultural_pois": a.isin(CULTURAL_VALUES),
    }


def relevant_poi(flags: dict[str, Column]) -> Column:
    """A POI in at least one category (null-safe: unknown counts as no)."""
    return reduce(lambda x, y: x | y, [F.coalesce(f, F.lit(False)) for f in flags.values()])


def exclusive_category() -> Column:
    """First matching category in priority order; everything else 'amenities'.
    'transports' is never produced (kept at zero as in the original)."""
    a, leisure, tourism = F.col("amenity"), F.col("leisure"), F.col("tourism")
    return (F.when(a.isin(EXCLUSIVE_SCHOOLS), "schools")
            .when(a.isin(EXCLUSIVE_HEALTHCARE), "healthcare")
            .when(a.isin(EXCLUSIVE_RESTAURANTS), "restaurants")
            .when(a.isin(EXCLUSIVE_SHOPS), "shops")
            .when(leisure == "park", "parks")
            .when(a.isin(EXCLUSIVE_ENTERTAINMENT), "entertainment")
            .when(a.isin(EXCLUSIVE_CULTURAL) | (tourism == "museum"), "cultural_places")
            .otherwise("amenities"))


# ---------------------------------------------------------------------------
# Planar radius join in Mercator metres
# ---------------------------------------------------------------------------
def _poi_points(poi: DataFrame, named_only: bool) -> tuple[DataFrame, list[str]]:
    flags = category_flags()
    p = poi
    if named_only:
        p = p.filter(F.col("name").isNotNull())
    p = p.filter(relevant_poi(flags))
    p = p.select(mercator_x("lon").alias("px"), mercator_y("lat").alias("py"),
                 *[F.coalesce(f, F.lit(False)).cast("long").alias(n) for n, f in flags.items()])
    # Collapse POIs sharing exact coordinates before the shuffle.
    p = p.groupBy("px", "py").agg(*[F.sum(n).alias(n) for n in flags])
    return p, list(flags)


def _planar_pairs(cells: DataFrame, pts: DataFrame, radius: float) -> DataFrame:
    """Pairs (cell row, point row) with planar distance ≤ radius.

    ``cells`` carries ``cx_m, cy_m`` (metres), ``pts`` carries ``px, py``.
    The cell side is replicated to its 9 neighbour cells; a size-checked
    broadcast avoids shuffling the (larger) POI side.
    """
    r = float(radius)
    c = (cells.withColumn("_o", F.explode(_off2()))
         .withColumn("kx", F.floor(F.col("cx_m") / r) + F.col("_o.dx"))
         .withColumn("ky", F.floor(F.col("cy_m") / r) + F.col("_o.dy"))
         .drop("_o"))
    p = pts.withColumn("kx", F.floor(F.col("px") / r)).withColumn("ky", F.floor(F.col("py") / r))
    c = only_counted_broadcast(c, cells.count() * 9)
    dx = F.col("px") - F.col("cx_m")
    dy = F.col("py") - F.col("cy_m")
    return (p.join(c, ["kx", "ky"])
            .filter(dx * dx + dy * dy <= F.lit(r * r)))


def radius_poi_counts(grid: DataFrame, poi: DataFrame, radius: float = 500.0,
                      keys=("lat", "lon", "densite"), named_only: bool = False,
                      min_density: float | None = None) -> DataFrame:
    """Grid keys with the number of POIs of each category within ``radius``
    Mercator metres (inclusive); cells without hits keep zero counts.

    Rows of ``grid`` sharing a key merge and their counts add up, as a
    ``GROUP BY`` over a left join does.  With ``min_density`` only cells with
    ``densite >= min_density`` are enriched; the others keep zeros.
    """
    keys = list(keys)
    # Grid keys are grouped under one exact text key (null-safe, -0.0 folded
    # into 0.0, as GROUP BY compares them).  Unlike float keys, which are
    # normalised anew at each operator, the text key lets the join back of
    # the counts reuse both aggregates' partitioning: no further exchange.
    g = grid.groupBy(_text_key(grid, keys).alias("_gk")).agg(
        F.count(F.lit(1)).alias("_mult"), *[F.first(k).alias(k) for k in keys])
    todo = g if min_density is None else g.filter(F.col("densite") >= F.lit(min_density))
    cells = todo.select("_gk", "_mult", mercator_x("lon").alias("cx_m"),
                        mercator_y("lat").alias("cy_m"))
    pts, names = _poi_points(poi, named_only)
    pairs = _planar_pairs(cells, pts, radius)
    counts = (pairs.groupBy("_gk")
              .agg(*[F.sum(F.col(n) * F.col("_mult")).alias(n) for n in names]))
    return g.join(counts, "_gk", "left").select(
        *keys, *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in names])


def _text_key(df: DataFrame, cols) -> Column:
    """Exact, null-safe text form of a numeric key tuple."""
    parts = []
    for c in cols:
        x = F.col(c)
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            x = x + F.lit(0.0).cast(df.schema[c].dataType)
        parts.append(F.coalesce(x.cast("string"), F.lit("null")))
    return F.concat_ws("|", *parts)


def radius_poi_counts_per_row(grid: DataFrame, poi: DataFrame, radius: float = 500.0,
                              id_col: str = "grid_id", named_only: bool = True) -> DataFrame:
    """One output row per grid row (kept row-aligned by ``id_col``), counting
    named POIs only — the per-point query variant, as one set-based join."""
    base = grid.select(id_col, "lat", "lon", "densite")
    cells = base.select(id_col, F.lit(1).cast("long").alias("_mult"),
                        mercator_x("lon").alias("cx_m"), mercator_y("lat").alias("cy_m"))
    pts, names = _poi_points(poi, named_only)
    counts = _planar_pairs(cells, pts, radius).groupBy(id_col).agg(
        *[F.sum(n).alias(n) for n in names])
    return base.join(counts, id_col, "left").select(
        id_col, "lat", "lon", "densite",
        *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in names])


def poi_counts_around(poi: DataFrame, lon: float, lat: float, radius: float = 500.0,
                      named_only: bool = False) -> DataFrame:
    """POIs of each category within ``radius`` Mercator metres of one point:
    a global aggregate, so exactly one row even when nothing is in range.

    The Mercator square around the point is turned back into a degree box
    (widened by 1e-9°) and applied first — on a parquet POI table it is pushed
    into the scan; the exact distance test follows."""
    r = float(radius)
    dlon = math.degrees(r / MERCATOR_RADIUS) + 1e-9
    y0 = MERCATOR_RADIUS * math.log(math.tan(math.pi / 4 + math.radians(lat) / 2))

    def lat_of(y):
        return math.degrees(2 * math.atan(math.exp(y / MERCATOR_RADIUS)) - math.pi / 2)

    p = poi.filter(F.col("lon").between(lon - dlon, lon + dlon)
                   & F.col("lat").between(lat_of(y0 - r) - 1e-9, lat_of(y0 + r) + 1e-9))
    if named_only:
        p = p.filter(F.col("name").isNotNull())
    dx = mercator_x("lon") - mercator_x(F.lit(float(lon)))
    dy = mercator_y("lat") - mercator_y(F.lit(float(lat)))
    within = dx * dx + dy * dy <= F.lit(r * r)
    return p.agg(*[F.count_if(within & F.coalesce(f, F.lit(False))).alias(n)
                   for n, f in category_flags().items()])


# ---------------------------------------------------------------------------
# Great-circle radius join (exclusive categories, amenity-tagged POIs)
# ---------------------------------------------------------------------------
def radius_exclusive_counts(grid: DataFrame, poi: DataFrame, radius: float = 500.0,
                            id_col: str = "grid_id", min_density: float = 200.0) -> DataFrame:
    """Per grid row, amenity-tagged POIs within ``radius`` metres on the
    sphere, each counted once in its first matching category.

    Cells of side r on 3-D sphere coordinates: a chord is never longer than
    its arc, so every pair within arc r lies in neighbouring cubes (27).
    Rows below ``min_density`` are not searched and keep zeros.
    """
    r = float(radius)
    base = grid.select(id_col, "lat", "lon", "densite")
    gx, gy, gz = unit_xyz("lon", "lat")
    searched = base.filter(F.col("densite") >= F.lit(min_density))
    cells = (searched
             .select(id_col, F.col("lon").alias("glon"), F.col("lat").alias("glat"),
                     gx.alias("gx"), gy.alias("gy"), gz.alias("gz"))
             .withColumn("_o", F.explode(_off3()))
             .withColumn("kx", F.floor(F.col("gx") / r) + F.col("_o.dx"))
             .withColumn("ky", F.floor(F.col("gy") / r) + F.col("_o.dy"))
             .withColumn("kz", F.floor(F.col("gz") / r) + F.col("_o.dz"))
             .drop("_o", "gx", "gy", "gz"))
    px, py, pz = unit_xyz("lon", "lat")
    pts = (poi.filter(F.col("amenity").isNotNull())
           .select("lon", "lat", exclusive_category().alias("cat"))
           .groupBy("lon", "lat", "cat").agg(F.count(F.lit(1)).alias("n"))
           .withColumn("kx", F.floor(px / r)).withColumn("ky", F.floor(py / r))
           .withColumn("kz", F.floor(pz / r)))
    cells = only_counted_broadcast(cells, searched.count() * 27)
    pairs = (pts.join(cells, ["kx", "ky", "kz"])
             .filter(haversine("glon", "glat", "lon", "lat") <= F.lit(r)))
    counts = (pairs.groupBy(id_col)
              .agg(*[F.sum(F.when(F.col("cat") == c, F.col("n")).otherwise(0)).alias(c)
                     for c in EXCLUSIVE_OUTPUT_COLUMNS]))
    return base.join(counts, id_col, "left").select(
        id_col, "lat", "lon", "densite",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in EXCLUSIVE_OUTPUT_COLUMNS])


# ---------------------------------------------------------------------------
# Exact k-nearest neighbours with inverse-distance weights
# ---------------------------------------------------------------------------
def _point_key(x, y) -> Column:
    """Exact text key of a point (null when a coordinate is null)."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    return F.concat((x + F.lit(0.0)).cast("string"), F.lit("|"), (y + F.lit(0.0)).cast("string"))


def knn_idw(points: DataFrame, grid: DataFrame, k: int = 4, measures=GRID_MEASURES,
            point_cols=("longitude", "latitude"), grid_cols=("lon", "lat"),
            grid_id: str = "grid_id", zero_distance: float = 1e-10,
            max_levels: int = 64) -> DataFrame:
    """Attach ``<measure>_weighted`` = Σ w·v / Σ w over the k nearest grid rows
    (Euclidean, in raw degrees), w = 1/d with d = 0 read as ``zero_distance``.
    Ties in distance are broken by ``grid_id``.

    Exact without a cross join: distinct query points are hashed into square
    cells of side δ, joined to the 3×3 block of grid cells, and the k best
    kept with ``row_number`` (a window group-limit in Catalyst).  A point is
    *certified* when its k-th distance is below the distance from the point to
    the edge of its 3×3 block (nothing outside can be closer) or the block
    covers the whole grid.  Uncertified points — sparse borders — go round
    again with δ doubled; each round is checkpointed.
    """
    spark = points.sparkSession
    px, py = point_cols
    gxc, gyc = grid_cols
    measures = list(measures)
    st = grid.agg(F.count(F.lit(1)).alias("n"), F.min(gxc).alias("x0"), F.max(gxc).alias("x1"),
                  F.min(gyc).alias("y0"), F.max(gyc).alias("y1")).first()
    n = st["n"]
    if n < k:
        raise ValueError(f"grid has {n} rows, fewer than k={k}")
    span_x = max(st["x1"] - st["x0"], 1e-9)
    span_y = max(st["y1"] - st["y0"], 1e-9)
    delta0 = math.sqrt(k * span_x * span_y / n)

    # Points are keyed by the exact text of their coordinates (a double's
    # string form reads back to the same double; +0.0 folds -0.0 into 0.0).
    # A string key keeps one hash partitioning from the distinct through the
    # top-k window: double keys are float-normalised by the window and would
    # force a second exchange.
    q = (points.select(F.col(px).cast("double").alias("_qx"), F.col(py).cast("double").alias("_qy"))
         .filter(F.col("_qx").isNotNull() & F.col("_qy").isNotNull())
         .select(_point_key("_qx", "_qy").alias("_pk"), "_qx", "_qy")
         .dropDuplicates(["_pk"]))
    g = grid.select(F.col(grid_id).alias("_gid"), F.col(gxc).cast("double").alias("_gx"),
                    F.col(gyc).cast("double").alias("_gy"), *measures)

    pending = q
    done, n_done = [], 0
    for level in range(max_levels):
        delta = delta0 * (2.0 ** level)
        cells = maybe_broadcast(
            g.withColumn("kx", F.floor(F.col("_gx") / delta))
             .withColumn("ky", F.floor(F.col("_gy") / delta)), rows=n)
        qc = (pending.withColumn("cx", F.floor(F.col("_qx") / delta))
              .withColumn("cy", F.floor(F.col("_qy") / delta))
              .withColumn("_o", F.explode(_off2()))
              .withColumn("kx", F.col("cx") + F.col("_o.dx"))
              .withColumn("ky", F.col("cy") + F.col("_o.dy"))
              .drop("_o"))
        dx = F.col("_qx") - F.col("_gx")
        dy = F.col("_qy") - F.col("_gy")
        # Left join: a point whose 3×3 block is empty still reaches ``agg``
        # (with fewer than k neighbours) and goes round again.
        cand = qc.join(cells, ["kx", "ky"], "left").withColumn("_d2", dx * dx + dy * dy)
        w = Window.partitionBy("_pk").orderBy(F.asc_nulls_last("_d2"), "_gid")
        top = cand.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
        top = top.withColumn("_w", F.lit(1.0) / F.when(F.col("_d2") == 0, F.lit(zero_distance))
                             .otherwise(F.sqrt("_d2")))
        # Per-point sums as window aggregates over the same partitioning as the
        # top-k window (no further exchange), then one row per point.
        wp = Window.partitionBy("_pk")
        agg = (top.select("_pk", "_qx", "_qy", "_rn",
                          F.count("_gid").over(wp).alias("_nk"), F.max("_d2").over(wp).alias("_kth"),
                          *[(F.sum(F.col("_w") * F.col(m)).over(wp) / F.sum("_w").over(wp))
                            .alias(f"{m}_weighted") for m in measures])
               .filter(F.col("_rn") == 1).drop("_rn"))
        agg = (agg.withColumn("cx", F.floor(F.col("_qx") / delta))
               .withColumn("cy", F.floor(F.col("_qy") / delta)))
        margin = F.least(F.col("_qx") - (F.col("cx") - 1) * delta,
                         (F.col("cx") + 2) * delta - F.col("_qx"),
                         F.col("_qy") - (F.col("cy") - 1) * delta,
                         (F.col("cy") + 2) * delta - F.col("_qy"))
        covers = ((F.col("cx") - 1 <= math.floor(st["x0"] / delta))
                  & (F.col("cx") + 1 >= math.floor(st["x1"] / delta))
                  & (F.col("cy") - 1 <= math.floor(st["y0"] / delta))
                  & (F.col("cy") + 1 >= math.floor(st["y1"] / delta)))
        ok = (F.col("_nk") == k) & ((F.col("_kth") < margin * margin) | covers)
        agg = agg.withColumn("_ok", ok).drop("cx", "cy", "_nk", "_kth").checkpoint()
        tally = {r["_ok"]: r["n"] for r in agg.groupBy("_ok").agg(F.count(F.lit(1)).alias("n")).collect()}
        n_done += tally.get(True, 0)
        done.append(agg.filter("_ok").drop("_ok"))
        pending = agg.filter(~F.col("_ok")).select("_pk", "_qx", "_qy")
        if not tally.get(False, 0):
            break
    else:
        raise RuntimeError("kNN rounds did not settle")
    # One row per distinct point: broadcast when it fits (the sales are then
    # not shuffled for the join back), a shuffle join otherwise.
    res = maybe_broadcast(reduce(DataFrame.unionByName, done), rows=n_done)
    res = res.drop("_qx", "_qy")
    keyed = points.withColumn("_pk", _point_key(F.col(px).cast("double"), F.col(py).cast("double")))
    return keyed.join(res, "_pk", "left").drop("_pk")
