"""Column expressions shared by the operators (all JVM-side, codegen-friendly)."""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES — spherical Mercator (EPSG:3857) radius and the mean Earth radius
# used for great-circle distances.
MERCATOR_RADIUS = 6378137.0
EARTH_RADIUS = 6371000.0


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_safe_sum(cols) -> Column:
    """Σ of columns with null read as 0 (the cleaner's total surface)."""
    return reduce(add, [F.coalesce(col(c), F.lit(0.0)) for c in cols])


def mercator_x(lon) -> Column:
    return F.lit(MERCATOR_RADIUS) * F.radians(col(lon))


def mercator_y(lat) -> Column:
    return F.lit(MERCATOR_RADIUS) * F.log(
        F.tan(F.lit(math.pi / 4.0) + F.radians(col(lat)) / F.lit(2.0)))


def unit_xyz(lon, lat):
    """Point on the sphere of radius ``EARTH_RADIUS`` (metres), as 3 columns."""
    phi, lam = F.radians(col(lat)), F.radians(col(lon))
    r = F.lit(EARTH_RADIUS)
    return r * F.cos(phi) * F.cos(lam), r * F.cos(phi) * F.sin(lam), r * F.sin(phi)


def haversine(lon1, lat1, lon2, lat2) -> Column:
    """Great-circle distance in metres."""
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    dphi = p2 - p1
    dlam = F.radians(col(lon2)) - F.radians(col(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlam / 2), 2)
    return F.lit(2.0 * EARTH_RADIUS) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def hash_uniform(*cols, seed: str = "") -> Column:
    """Deterministic uniform in [0, 1) from the md5 of the key columns.

    ``conv(substr(md5(k),1,8),16,10) / 2^32`` — the same number DuckDB gets from
    ``('0x'||substr(md5(k),1,8))::bigint / 4294967296``; stable under any
    repartitioning, so a split or fold survives re-execution after executor loss.
    """
    key = F.concat_ws("|", *[col(c).cast("string") for c in cols])
    if seed:
        key = F.concat(F.lit(f"{seed}|"), key)
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def duckdb_hash_uniform(expr_sql: str, seed: str = "") -> str:
    """DuckDB text of :func:`hash_uniform` for a single key expression."""
    key = f"'{seed}|' || ({expr_sql})" if seed else f"({expr_sql})"
    return f"(('0x' || substr(md5({key}), 1, 8))::bigint / 4294967296.0)"
