"""Surrogate views over the driver's TPC-H-like tables.

The driver ships no property data, so every operator is exercised on three
deterministic views — ``dvf`` (sale lines), ``grid`` (population cells with
POI counts) and ``poi`` (tagged points) — derived from ``lineitem``,
``orders``, ``part`` and ``customer``.  The same SQL text runs in Spark
(with the tables passed as DataFrames) and in DuckDB (as CTEs over the
pre-registered views), so both engines see identical inputs.
Double literals carry ``e0`` so neither engine falls into decimal arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DVF_SQL = """
select cast(o_orderkey as string) id_mutation, cast(o_orderdate as date) date_mutation,
 case when l_partkey % 11 = 0 then null else p_type end type_local,
 case when l_linenumber % 3 = 0 then null else l_quantity*2e0 end surface_reelle_bati,
 cast(l_linenumber-1 as double) nombre_lots,
 case when l_suppkey % 4 = 0 then l_quantity end lot1_surface_carrez,
 case when l_suppkey % 8 = 0 then l_quantity/2e0 end lot2_surface_carrez,
 case when l_suppkey % 16 = 0 then l_quantity/4e0 end lot3_surface_carrez,
 cast(null as double) lot4_surface_carrez, cast(null as double) lot5_surface_carrez,
 case when l_partkey % 5 = 0 then null else cast(p_size % 8 as double) end nombre_pieces_principales,
 case when l_suppkey % 3 = 0 then l_quantity*10e0 end surface_terrain,
 case when l_partkey % 97 = 0 then null else cast((l_suppkey*37) % 701 as double)/100e0 - 1e0 end longitude,
 cast((l_partkey*53) % 601 as double)/100e0 + 44e0 latitude,
 case when l_orderkey % 101 = 0 then null else o_totalprice end valeur_fonciere,
 lpad(cast(c_nationkey as string), 2, '0') departement,
 l_linenumber seq1, l_partkey seq2, l_suppkey seq3
from {lineitem} join {orders} on l_orderkey=o_orderkey join {part} on l_partkey=p_partkey
 join {customer} on o_custkey=c_custkey
"""

GRID_SQL = """
select c_custkey grid_id, cast((c_custkey*7919) % 701 as double)/100e0 - 1e0 lon,
 cast((c_custkey*104729) % 601 as double)/100e0 + 44e0 lat, abs(c_acctbal) densite,
 c_custkey % 7 transport_pois, c_custkey % 3 education_pois, c_custkey % 4 health_pois,
 c_custkey % 11 food_pois, c_custkey % 13 shopping_pois, c_custkey % 2 park_pois,
 c_custkey % 5 entertainment_pois, c_custkey % 6 cultural_pois
from {customer}
"""

POI_SQL = """
select p_partkey poi_id, cast((p_partkey*6007) % 701 as double)/100e0 - 1e0 lon,
 cast((p_partkey*3571) % 601 as double)/100e0 + 44e0 lat,
 case p_partkey % 12 when 0 then 'school' when 1 then 'pharmacy' when 2 then 'cafe'
  when 3 then 'marketplace' when 4 then 'cinema' when 5 then 'library' when 6 then 'museum'
  when 7 then 'bench' when 8 then 'shop' end amenity,
 case when p_partkey % 9 = 0 then 'bakery' end shop,
 case when p_partkey % 10 = 0 then 'park' end leisure,
 case when p_partkey % 8 = 0 then 'station' end public_transport,
 case when p_partkey % 14 = 0 then 'museum' end tourism,
 case when p_partkey % 5 = 0 then null else p_name end name
from {part}
"""

VIEWS = {"dvf": DVF_SQL, "grid": GRID_SQL, "poi": POI_SQL}
BASE_TABLES = ["lineitem", "orders", "part", "customer"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one surrogate view from the driver tables (lazy; pruned by Catalyst)."""
    text = VIEWS[name]
    needed = {t: table(spark, sf_dir, t) for t in BASE_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **needed)


def dvf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "dvf")


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "grid")


def poi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "poi")


def duckdb_with(*names: str) -> str:
    """``WITH`` prefix defining the named views for the DuckDB oracle."""
    parts = []
    for n in names:
        body = VIEWS[n].format(**{t: t for t in BASE_TABLES})
        body = body.replace("as string)", "as varchar)")
        parts.append(f"{n} AS ({body})")
    return "WITH " + ",\n".join(parts) + "\n"
