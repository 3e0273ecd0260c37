"""DuckDB text for the oracle side of every registered query.

Each string starts from the driver's raw tables (``lineitem`` …) through the
shared fixture views, and spells the operator's semantics out in plain SQL —
theta joins, cross joins with windows, ``quantile_cont`` — the brute-force
forms our Spark operators must agree with.
"""

from __future__ import annotations

from parcelle.functions.columns import MERCATOR_RADIUS, EARTH_RADIUS
from parcelle.schemas import (
    CULTURAL_VALUES, EDUCATION_VALUES, ENTERTAINMENT_VALUES, FOOD_VALUES,
    GRID_MEASURES, HEALTH_VALUES, LOT_COLUMNS, PARK_LEISURE_VALUES,
    SHOPPING_AMENITY_VALUES, TRANSPORT_VALUES, JOB_CLEANER, JOB_PRICE_BAND,
    EXCLUSIVE_SCHOOLS, EXCLUSIVE_HEALTHCARE, EXCLUSIVE_RESTAURANTS,
    EXCLUSIVE_SHOPS, EXCLUSIVE_ENTERTAINMENT, EXCLUSIVE_CULTURAL, EXCLUSIVE_OUTPUT_COLUMNS, REGIONS,
)
from parcelle.sources.fixtures import duckdb_with
from parcelle.sources.links import ANCHOR_PATTERN


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _num(x: float) -> str:
    return repr(float(x)) if not float(x).is_integer() else f"{float(x):.1f}"


SEQ = "(seq1, seq2, seq3)"
SURF_SUM = " + ".join(f"coalesce({c}, 0)" for c in
                      ["surface_reelle_bati", "surface_terrain", *LOT_COLUMNS])


def cleaned_cte(p=JOB_CLEANER) -> str:
    return f"""cleaned AS (
  SELECT * FROM dvf
  WHERE valeur_fonciere IS NOT NULL AND longitude IS NOT NULL AND latitude IS NOT NULL
    AND nombre_lots <= {_num(p['nombre_lots_max'])}
    AND valeur_fonciere >= {_num(p['valeur_min'])} AND valeur_fonciere <= {_num(p['valeur_max'])}
    AND ({SURF_SUM}) >= {_num(p['surface_min'])} AND ({SURF_SUM}) <= {_num(p['surface_max'])}
)"""


ROLLUP_CTE = f"""rolled AS (
  SELECT id_mutation, valeur_fonciere,
    sum(coalesce(surface_reelle_bati, 0)) AS surface_reelle_bati,
    CAST(arg_min_null(year(date_mutation), {SEQ}) AS INTEGER) AS year,
    arg_min_null(sin(month(date_mutation) / 12), {SEQ}) AS sin_month,
    arg_min_null(cos(month(date_mutation) / 12), {SEQ}) AS cos_month,
    CASE WHEN count(type_local) < count(*) THEN 'Unknown'
         ELSE string_agg(DISTINCT type_local, ', ' ORDER BY type_local) END AS type_local,
    max(nombre_lots) AS nombre_lots,
    {", ".join(f"avg(coalesce({c}, 0)) AS {c}" for c in LOT_COLUMNS)},
    coalesce(sum(nombre_pieces_principales), 0) AS nombre_pieces_principales,
    sum(coalesce(surface_terrain, 0)) AS surface_terrain,
    arg_min_null(longitude, {SEQ}) AS longitude,
    arg_min_null(latitude, {SEQ}) AS latitude
  FROM cleaned GROUP BY id_mutation, valeur_fonciere
)"""

TOTAL_CARREZ = " + ".join(f"CAST({c} AS DOUBLE)" for c in LOT_COLUMNS)

FEATURES_CTE = f"""priced AS (
  SELECT *, {TOTAL_CARREZ} AS total_surface_carrez,
    CASE WHEN {TOTAL_CARREZ} > 0 THEN valeur_fonciere / ({TOTAL_CARREZ})
         WHEN surface_terrain > 0 THEN valeur_fonciere / surface_terrain
         WHEN surface_reelle_bati > 0 THEN valeur_fonciere / surface_reelle_bati END AS prix_m2
  FROM rolled
),
features AS (
  SELECT * FROM priced WHERE prix_m2 > {_num(JOB_PRICE_BAND[0])} AND prix_m2 <= {_num(JOB_PRICE_BAND[1])}
)"""

FEATURE_DOUBLES = ["valeur_fonciere", "surface_reelle_bati", "sin_month", "cos_month",
                   "nombre_lots", *LOT_COLUMNS, "nombre_pieces_principales",
                   "surface_terrain", "longitude", "latitude"]


def _r(c: str, d: int = 6, alias: str | None = None) -> str:
    return f"round({c}, {d}) AS {alias or c}"


def features_sql(stage: str = "features") -> str:
    return duckdb_with("dvf") + ", " + cleaned_cte() + ",\n" + ROLLUP_CTE + ",\n" + FEATURES_CTE


CLEAN_ROWS = duckdb_with("dvf") + ", " + cleaned_cte() + f"""
SELECT id_mutation, seq1, seq2, seq3, round({SURF_SUM}, 6) AS surface_totale FROM cleaned
"""

MUTATION_ROLLUP = features_sql() + f"""
SELECT id_mutation, year, type_local, {", ".join(_r(c) for c in FEATURE_DOUBLES)} FROM rolled
"""

PRICE_FEATURES = features_sql() + f"""
SELECT id_mutation, year, type_local, {", ".join(_r(c) for c in FEATURE_DOUBLES)},
  {_r("total_surface_carrez")}, prix_m2 FROM features
"""

PRICE_BY_TYPE_YEAR = features_sql() + """
SELECT type_local, year, count(*) AS n_sales,
  round(avg(prix_m2), 4) AS mean_prix_m2,
  round(quantile_cont(prix_m2, 0.5), 4) AS median_prix_m2
FROM features GROUP BY type_local, year
"""


# ---------------------------------------------------------------------------
# Spatial
# ---------------------------------------------------------------------------
R_MERC = repr(MERCATOR_RADIUS)
FIXTURE_RADIUS = 20000.0
FIXTURE_MIN_DENSITY = 2000.0

RELEVANT = f"""(public_transport IN {_in(TRANSPORT_VALUES)} OR amenity IN {_in(EDUCATION_VALUES + HEALTH_VALUES + FOOD_VALUES + SHOPPING_AMENITY_VALUES + ENTERTAINMENT_VALUES + CULTURAL_VALUES)}
  OR shop IS NOT NULL OR leisure IN {_in(PARK_LEISURE_VALUES)})"""

COUNT_COLUMNS = f"""
  count(CASE WHEN p.public_transport IN {_in(TRANSPORT_VALUES)} THEN 1 END) AS transport_pois,
  count(CASE WHEN p.amenity IN {_in(EDUCATION_VALUES)} THEN 1 END) AS education_pois,
  count(CASE WHEN p.amenity IN {_in(HEALTH_VALUES)} THEN 1 END) AS health_pois,
  count(CASE WHEN p.amenity IN {_in(FOOD_VALUES)} THEN 1 END) AS food_pois,
  count(CASE WHEN p.amenity IN {_in(SHOPPING_AMENITY_VALUES)} OR p.shop IS NOT NULL THEN 1 END) AS shopping_pois,
  count(CASE WHEN p.leisure IN {_in(PARK_LEISURE_VALUES)} THEN 1 END) AS park_pois,
  count(CASE WHEN p.amenity IN {_in(ENTERTAINMENT_VALUES)} THEN 1 END) AS entertainment_pois,
  count(CASE WHEN p.amenity IN {_in(CULTURAL_VALUES)} THEN 1 END) AS cultural_pois"""


def _merc(lon: str, lat: str, x: str, y: str) -> str:
    return (f"{R_MERC} * radians({lon}) AS {x}, "
            f"{R_MERC} * ln(tan(pi() / 4 + radians({lat}) / 2.0)) AS {y}")


def radius_counts_sql(radius: float = FIXTURE_RADIUS) -> str:
    return duckdb_with("grid", "poi") + f""",
gp AS (SELECT lat, lon, densite, {_merc('lon', 'lat', 'cx', 'cy')} FROM grid),
pp AS (SELECT *, {_merc('lon', 'lat', 'px', 'py')} FROM poi WHERE {RELEVANT})
SELECT c.lat, c.lon, c.densite, {COUNT_COLUMNS}
FROM gp c LEFT JOIN pp p
  ON (p.px - c.cx) * (p.px - c.cx) + (p.py - c.cy) * (p.py - c.cy) <= {radius * radius!r}
GROUP BY c.lat, c.lon, c.densite
"""


def radius_counts_named_sql(radius: float = FIXTURE_RADIUS) -> str:
    return duckdb_with("grid", "poi") + f""",
gp AS (SELECT grid_id, lat, lon, densite, {_merc('lon', 'lat', 'cx', 'cy')} FROM grid),
pp AS (SELECT *, {_merc('lon', 'lat', 'px', 'py')} FROM poi WHERE {RELEVANT} AND name IS NOT NULL)
SELECT c.grid_id, c.lat, c.lon, c.densite, {COUNT_COLUMNS}
FROM gp c LEFT JOIN pp p
  ON (p.px - c.cx) * (p.px - c.cx) + (p.py - c.cy) * (p.py - c.cy) <= {radius * radius!r}
GROUP BY c.grid_id, c.lat, c.lon, c.densite
"""


def radius_gated_sql(radius: float = FIXTURE_RADIUS, min_density: float = FIXTURE_MIN_DENSITY) -> str:
    return duckdb_with("grid", "poi") + f""",
gp AS (SELECT lat, lon, densite, {_merc('lon', 'lat', 'cx', 'cy')} FROM grid),
pp AS (SELECT *, {_merc('lon', 'lat', 'px', 'py')} FROM poi WHERE {RELEVANT})
SELECT c.lat, c.lon, c.densite, {COUNT_COLUMNS}
FROM gp c LEFT JOIN pp p
  ON c.densite >= {min_density!r}
 AND (p.px - c.cx) * (p.px - c.cx) + (p.py - c.cy) * (p.py - c.cy) <= {radius * radius!r}
GROUP BY c.lat, c.lon, c.densite
"""


EXCLUSIVE_CASE = f"""CASE WHEN amenity IN {_in(EXCLUSIVE_SCHOOLS)} THEN 'schools'
  WHEN amenity IN {_in(EXCLUSIVE_HEALTHCARE)} THEN 'healthcare'
  WHEN amenity IN {_in(EXCLUSIVE_RESTAURANTS)} THEN 'restaurants'
  WHEN amenity IN {_in(EXCLUSIVE_SHOPS)} THEN 'shops'
  WHEN leisure = 'park' THEN 'parks'
  WHEN amenity IN {_in(EXCLUSIVE_ENTERTAINMENT)} THEN 'entertainment'
  WHEN amenity IN {_in(EXCLUSIVE_CULTURAL)} OR tourism = 'museum' THEN 'cultural_places'
  ELSE 'amenities' END"""


def exclusive_counts_sql(radius: float = FIXTURE_RADIUS, min_density: float = FIXTURE_MIN_DENSITY) -> str:
    hav = ("12742000.0 * asin(sqrt(least(1.0, pow(sin((radians(p.lat) - radians(c.lat)) / 2), 2)"
           " + cos(radians(c.lat)) * cos(radians(p.lat))"
           " * pow(sin((radians(p.lon) - radians(c.lon)) / 2), 2))))")
    cats = ["amenities", "transports", "shops", "schools", "parks", "restaurants",
            "healthcare", "entertainment", "cultural_places"]
    return duckdb_with("grid", "poi") + f""",
pp AS (SELECT lon, lat, {EXCLUSIVE_CASE} AS cat FROM poi WHERE amenity IS NOT NULL),
m AS (SELECT c.grid_id, p.cat FROM grid c JOIN pp p
      ON c.densite >= {min_density!r} AND {hav} <= {radius!r})
SELECT g.grid_id, g.lat, g.lon, g.densite,
  {", ".join(f"count(*) FILTER (WHERE m.cat = '{c}') AS {c}" for c in cats)}
FROM grid g LEFT JOIN m ON g.grid_id = m.grid_id
GROUP BY g.grid_id, g.lat, g.lon, g.densite
"""


def knn_sql(k: int = 4) -> str:
    cols = ", ".join(f"g.{m}" for m in GRID_MEASURES)
    wsum = ", ".join(f"sum(w * {m}) / sum(w) AS {m}_weighted" for m in GRID_MEASURES)
    outs = ", ".join(f"round(nb.{m}_weighted, 6) AS {m}_weighted" for m in GRID_MEASURES)
    return features_sql().replace("WITH dvf AS", "WITH grid AS (" + _grid_body() + "),\ndvf AS", 1) + f""",
pts AS (SELECT DISTINCT longitude, latitude FROM features),
cand AS (SELECT p.longitude, p.latitude, g.grid_id, {cols},
           (p.longitude - g.lon) * (p.longitude - g.lon) + (p.latitude - g.lat) * (p.latitude - g.lat) AS d2
         FROM pts p CROSS JOIN grid g),
top AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY longitude, latitude ORDER BY d2, grid_id) <= {k}),
wt AS (SELECT *, 1.0 / CASE WHEN d2 = 0 THEN 1e-10 ELSE sqrt(d2) END AS w FROM top),
nb AS (SELECT longitude, latitude, {wsum} FROM wt GROUP BY longitude, latitude)
SELECT f.id_mutation, f.valeur_fonciere, {outs}
FROM features f JOIN nb ON f.longitude = nb.longitude AND f.latitude = nb.latitude
"""


def _grid_body() -> str:
    from parcelle.sources.fixtures import GRID_SQL
    return GRID_SQL.format(customer="customer")


# ---------------------------------------------------------------------------
# Regions, splits, encoders, evaluation, links, resume
# ---------------------------------------------------------------------------
def hu(expr: str, seed: str = "") -> str:
    key = f"'{seed}|' || ({expr})" if seed else f"({expr})"
    return f"(('0x' || substr(md5({key}), 1, 8))::bigint / 4294967296.0)"


REGION_VALUES = ", ".join(f"('{r.replace(chr(39), chr(39) * 2)}', '{d}')"
                          for r, deps in REGIONS.items() for d in deps)

REGION_SALES = features_sql() + f""",
dim(region, departement) AS (VALUES {REGION_VALUES}),
deps AS (SELECT DISTINCT id_mutation, departement FROM dvf)
SELECT r.region, f.year, count(*) AS n_sales, round(avg(f.prix_m2), 4) AS mean_prix_m2
FROM features f JOIN deps d ON f.id_mutation = d.id_mutation JOIN dim r ON d.departement = r.departement
GROUP BY r.region, f.year
"""

SPLIT_U = hu("id_mutation")
HASH_SPLIT = features_sql() + f"""
SELECT id_mutation, valeur_fonciere, CASE WHEN {SPLIT_U} < 0.8 THEN 'train' ELSE 'test' END AS split
FROM features
"""

KFOLD = features_sql() + f"""
SELECT id_mutation, valeur_fonciere, CAST(floor({hu('id_mutation', 'fold')} * 3) AS INTEGER) AS fold
FROM features WHERE {SPLIT_U} < 0.8
"""

EXACT_BATCHES = features_sql() + f"""
SELECT id_mutation, valeur_fonciere,
  CAST(floor((row_number() OVER (ORDER BY {hu('id_mutation', 'batch')}, id_mutation, valeur_fonciere) - 1) / 1000) AS INTEGER) AS batch_id
FROM features
"""

SAMPLE_ROWS = features_sql() + f"""
SELECT id_mutation, valeur_fonciere, prix_m2 FROM features
ORDER BY {hu('id_mutation', 'pick')}, id_mutation, valeur_fonciere LIMIT 250
"""

CATEGORY_LIST = features_sql() + """
SELECT DISTINCT type_local FROM features WHERE type_local IS NOT NULL
"""

from parcelle.schemas import NUMERIC_PHYSICAL  # noqa: E402

_UNPIVOT = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM src" for c in NUMERIC_PHYSICAL)

COLUMN_MODES = features_sql() + f""",
src AS (SELECT * FROM features WHERE {SPLIT_U} < 0.8),
lf AS ({_UNPIVOT}),
cnt AS (SELECT feature, value, count(*) AS n FROM lf WHERE value IS NOT NULL GROUP BY feature, value)
SELECT feature, arg_max(value, (n, -value)) AS mode FROM cnt GROUP BY feature
"""

QUARTILES = features_sql() + f""",
src AS (SELECT * FROM features),
lf AS ({_UNPIVOT}),
q AS (SELECT feature, quantile_cont(value, [0.25, 0.5, 0.75]) AS qs FROM lf WHERE value IS NOT NULL GROUP BY feature)
SELECT feature, p, round(qs[i], 6) AS value
FROM q, (VALUES (1, 0.25::DOUBLE), (2, 0.5::DOUBLE), (3, 0.75::DOUBLE)) t(i, p)
"""


def _scaled(c: str) -> str:
    return (f"round((CAST({c} AS DOUBLE) - s.{c}_med) / CASE WHEN s.{c}_iqr = 0 THEN 1.0 "
            f"ELSE s.{c}_iqr END, 6) AS {c}")


ROBUST_SCALED = features_sql() + f""",
tr AS (SELECT * FROM features WHERE {SPLIT_U} < 0.8),
te AS (SELECT * FROM features WHERE {SPLIT_U} >= 0.8),
s AS (SELECT {", ".join(f"quantile_cont({c}, 0.5) AS {c}_med, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS {c}_iqr" for c in NUMERIC_PHYSICAL)} FROM tr)
SELECT te.id_mutation, te.valeur_fonciere, {", ".join(_scaled(c) for c in NUMERIC_PHYSICAL)}
FROM te, s
"""

ONEHOT_TYPE = features_sql() + """,
cats AS (SELECT list(DISTINCT type_local ORDER BY type_local) FILTER (WHERE type_local IS NOT NULL) AS l FROM features)
SELECT f.id_mutation, f.valeur_fonciere,
  array_to_string(list_transform(cats.l, lambda e: CASE WHEN e = f.type_local THEN '1' ELSE '0' END), ',') AS onehot
FROM features f, cats
"""

BASELINE_PRED = features_sql() + f""",
lab AS (SELECT *, CASE WHEN {SPLIT_U} < 0.8 THEN 'train' ELSE 'test' END AS split FROM features),
gm AS (SELECT type_local, avg(prix_m2) AS gm FROM lab WHERE split = 'train' GROUP BY type_local),
om AS (SELECT avg(prix_m2) AS om FROM lab WHERE split = 'train'),
pred AS (SELECT lab.split, lab.prix_m2 AS y, coalesce(gm.gm, om.om) AS prediction
         FROM lab LEFT JOIN gm ON lab.type_local = gm.type_local, om)"""

BASELINE_METRICS = BASELINE_PRED + """,
ybar AS (SELECT split, avg(y) AS yb FROM pred GROUP BY split)
SELECT p.split, count(*) AS n, round(avg((y - prediction) * (y - prediction)), 2) AS mse,
  round(1.0 - sum((y - prediction) * (y - prediction)) / sum((y - yb) * (y - yb)), 8) AS r2
FROM pred p JOIN ybar USING (split) GROUP BY p.split
"""

BINNED_CURVE = BASELINE_PRED + """,
t AS (SELECT * FROM pred WHERE split = 'test'),
st AS (SELECT min(y) AS lo, CAST(ceil((max(y) - min(y)) / 100.0) AS BIGINT) AS nb FROM t),
per AS (SELECT CAST(floor((y - st.lo) / 100.0) AS BIGINT) AS bin, count(*) AS n, avg(prediction) AS mp
        FROM t, st GROUP BY 1),
bins AS (SELECT range AS bin FROM st, range(st.nb))
SELECT b.bin, st.lo + b.bin * 100.0 + 50.0 AS bin_center, coalesce(per.n, 0) AS n,
  round(per.mp, 6) AS mean_prediction
FROM bins b CROSS JOIN st LEFT JOIN per ON b.bin = per.bin
"""

LISTING_LINKS = f"""
WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '{ANCHOR_PATTERN}', 0)) AS a FROM pages),
b AS (SELECT page_id, url, regexp_extract(a, '{ANCHOR_PATTERN}', 1) AS href,
        regexp_replace(regexp_extract(a, '{ANCHOR_PATTERN}', 2), '<[^>]*>', '', 'g') AS link_text FROM a)
SELECT page_id, href, link_text,
  CASE WHEN regexp_full_match(trim(link_text, '/'), '[0-9]+') THEN trim(link_text, '/') END AS year,
  CASE WHEN ends_with(href, '.gz') THEN url || href END AS file_url
FROM b
"""

STAGE_COUNTS = features_sql() + """
SELECT 'lines' AS stage, count(*) AS n_rows FROM dvf
UNION ALL SELECT 'cleaned', count(*) FROM cleaned
UNION ALL SELECT 'mutations', count(*) FROM rolled
UNION ALL SELECT 'priced', count(*) FROM features
"""


MODE_IMPUTED = features_sql() + """,
nm AS (SELECT arg_max(v, (n, -v)) AS m FROM (SELECT nombre_pieces_principales AS v, count(*) AS n FROM cleaned
       WHERE nombre_pieces_principales IS NOT NULL GROUP BY 1)),
tm AS (SELECT arg_min(v, (-n, v)) AS m FROM (SELECT type_local AS v, count(*) AS n FROM cleaned
       WHERE type_local IS NOT NULL GROUP BY 1))
SELECT id_mutation, seq1, seq2, seq3, coalesce(nombre_pieces_principales, nm.m) AS nombre_pieces_principales,
  coalesce(type_local, tm.m) AS type_local
FROM cleaned, nm, tm
"""

HASH_SAMPLE = duckdb_with("dvf") + f"""
SELECT id_mutation, seq1, seq2, seq3 FROM dvf
WHERE {hu("id_mutation || '|' || CAST(seq1 AS VARCHAR) || '|' || CAST(seq2 AS VARCHAR) || '|' || CAST(seq3 AS VARCHAR)", 'sample')} < 0.1
"""

TRUTH_PREDICTION = BASELINE_PRED + """
SELECT split, y, round(prediction, 6) AS prediction FROM pred WHERE split = 'test'
"""

PREDICTION_BOUNDS = BASELINE_PRED + """
SELECT split, min(y) AS min_y, max(y) AS max_y, round(min(prediction), 6) AS min_prediction,
  round(max(prediction), 6) AS max_prediction FROM pred GROUP BY split
"""

WEIGHT_SWEEP_BASELINE = features_sql() + f""",
lab AS (SELECT *, CASE WHEN {SPLIT_U} < 0.8 THEN 'train' ELSE 'test' END AS split FROM features),
gp AS (SELECT type_local, avg(prix_m2) AS p FROM lab WHERE split = 'train' GROUP BY type_local),
gc AS (SELECT year, avg(prix_m2) AS p FROM lab WHERE split = 'train' GROUP BY year),
om AS (SELECT avg(prix_m2) AS om FROM lab WHERE split = 'train'),
pr AS (SELECT lab.prix_m2 AS label, coalesce(gp.p, om.om) AS p_phys, coalesce(gc.p, om.om) AS p_ctx
       FROM lab LEFT JOIN gp ON lab.type_local = gp.type_local LEFT JOIN gc ON lab.year = gc.year, om
       WHERE lab.split = 'test'),
w(weight) AS (VALUES (0.1::DOUBLE), (0.3::DOUBLE), (0.5::DOUBLE), (0.7::DOUBLE), (0.9::DOUBLE))
SELECT w.weight, round(avg(pow(label - (w.weight * p_phys + (1 - w.weight) * p_ctx), 2)), 2) AS mse
FROM pr, w GROUP BY w.weight
"""


# ---------------------------------------------------------------------------
# Transaction CSV scan, partitioned sink + re-scan, metrics per region
# ---------------------------------------------------------------------------
def _typed_line(name: str, dtype: str) -> str:
    return f"CAST({name} AS {dtype}) AS {name}" if dtype in ("FLOAT", "DOUBLE") else name


TRANSACTIONS_SCAN = duckdb_with("dvf") + """
SELECT {cols}, CAST(year(date_mutation) AS INTEGER) AS year, departement FROM dvf
"""

REGION_FEATURES = features_sql() + f""",
dim(region, departement) AS (VALUES {REGION_VALUES}),
deps AS (SELECT DISTINCT id_mutation, departement FROM dvf),
rf AS (SELECT r.region, f.* FROM features f JOIN deps d ON f.id_mutation = d.id_mutation
       JOIN dim r ON d.departement = r.departement)"""

PREPROCESSED_RESCAN = REGION_FEATURES + """
SELECT {cols} FROM rf WHERE {not_null}
"""

REGION_METRICS = REGION_FEATURES + f""",
lab AS (SELECT *, CASE WHEN {SPLIT_U} < 0.8 THEN 'train' ELSE 'test' END AS split FROM rf),
gm AS (SELECT region, type_local, avg(prix_m2) AS gm FROM lab WHERE split = 'train'
       GROUP BY region, type_local),
om AS (SELECT avg(prix_m2) AS om FROM lab WHERE split = 'train'),
pred AS (SELECT lab.region, lab.split, lab.prix_m2 AS y, coalesce(gm.gm, om.om) AS prediction
         FROM lab LEFT JOIN gm ON lab.region = gm.region AND lab.type_local = gm.type_local, om),
ybar AS (SELECT region, split, avg(y) AS yb FROM pred GROUP BY region, split)
SELECT p.region, p.split, count(*) AS n, round(avg((y - prediction) * (y - prediction)), 2) AS mse,
  round(1.0 - sum((y - prediction) * (y - prediction)) / sum((y - yb) * (y - yb)), 8) AS r2
FROM pred p JOIN ybar USING (region, split) GROUP BY p.region, p.split
"""


def poi_around_sql(lon: float, lat: float, radius: float) -> str:
    return duckdb_with("poi") + f""",
c AS (SELECT {_merc(repr(float(lon)), repr(float(lat)), 'cx', 'cy')}),
pp AS (SELECT *, {_merc('lon', 'lat', 'px', 'py')} FROM poi WHERE {RELEVANT})
SELECT {COUNT_COLUMNS}
FROM pp p, c WHERE (p.px - c.cx) * (p.px - c.cx) + (p.py - c.cy) * (p.py - c.cy) <= {radius * radius!r}
"""


SHAP_SHARE_BASELINE = REGION_FEATURES + f""",
lab AS (SELECT *, CASE WHEN {SPLIT_U} < 0.8 THEN 'train' ELSE 'test' END AS split FROM rf),
gp AS (SELECT type_local, avg(prix_m2) AS p FROM lab WHERE split = 'train' GROUP BY type_local),
gc AS (SELECT year, avg(prix_m2) AS p FROM lab WHERE split = 'train' GROUP BY year),
om AS (SELECT avg(prix_m2) AS om FROM lab WHERE split = 'train'),
phi AS (
  SELECT lab.region, 'physical' AS grp, 0.5 * (coalesce(gp.p, om.om) - om.om) AS phi
  FROM lab LEFT JOIN gp ON lab.type_local = gp.type_local, om WHERE lab.split = 'test'
  UNION ALL
  SELECT lab.region, 'contextual' AS grp, 0.5 * (coalesce(gc.p, om.om) - om.om) AS phi
  FROM lab LEFT JOIN gc ON lab.year = gc.year, om WHERE lab.split = 'test'),
per AS (SELECT region, grp, avg(abs(phi)) AS impact FROM phi GROUP BY region, grp)
SELECT region, grp AS "group", round(impact, 6) AS impact,
  round(CASE WHEN sum(impact) OVER (PARTITION BY region) <> 0
        THEN 100.0 * impact / sum(impact) OVER (PARTITION BY region) END, 6) AS share_pct
FROM per
"""


def encoded_blocks_sql(numeric_phys, numeric_ctx) -> str:
    """Two-block encoding of the test split in long form.  The numeric
    columns of the priced table have no nulls (sums are null-safe, the
    cleaner bounds ``nombre_lots``), so the mode imputer is the identity
    here and is left out of the SQL."""
    stats = ", ".join(f"quantile_cont({c}, 0.5) AS {c}_med, "
                      f"quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS {c}_iqr"
                      for c in [*numeric_phys, *numeric_ctx])

    def scaled(c):
        return f"(CAST(te.{c} AS DOUBLE) - s.{c}_med) / CASE WHEN s.{c}_iqr = 0 THEN 1.0 ELSE s.{c}_iqr END"
    parts = ["""SELECT te.id_mutation, te.valeur_fonciere, 'physical' AS block, c.pos,
    CASE WHEN te.type_local = c.cat THEN 1.0 ELSE 0.0 END AS value FROM te, cats c"""]
    parts += [f"SELECT te.id_mutation, te.valeur_fonciere, 'physical', CAST(nc.n + {j} AS INTEGER), {scaled(c)} "
              f"FROM te, s, nc" for j, c in enumerate(numeric_phys)]
    parts += [f"SELECT te.id_mutation, te.valeur_fonciere, 'contextual', {j}, {scaled(c)} FROM te, s"
              for j, c in enumerate(numeric_ctx)]
    union = "\n  UNION ALL ".join(parts)
    return features_sql() + f""",
tr AS (SELECT * FROM features WHERE {SPLIT_U} < 0.8),
te AS (SELECT * FROM features WHERE {SPLIT_U} >= 0.8),
cats AS (SELECT cat, CAST(row_number() OVER (ORDER BY cat) - 1 AS INTEGER) AS pos
         FROM (SELECT DISTINCT type_local AS cat FROM tr WHERE type_local IS NOT NULL)),
nc AS (SELECT CAST(count(*) AS INTEGER) AS n FROM cats),
s AS (SELECT {stats} FROM tr),
long AS (
  {union})
SELECT id_mutation, valeur_fonciere, block, pos, round(value, 6) AS value FROM long
"""


# Models with a closed answer: a = rooms, b = land, y = price per m².
MODEL_ROWS = features_sql() + """, m AS (
  SELECT id_mutation, valeur_fonciere, year, CAST(prix_m2 AS DOUBLE) AS y,
    CAST(nombre_pieces_principales AS DOUBLE) AS a, CAST(surface_terrain AS DOUBLE) AS b FROM features
)"""

WEIGHTED_GROUP_MEANS = MODEL_ROWS + """, g AS (
  SELECT *, avg(y) OVER (PARTITION BY a >= 3) AS p, avg(y) OVER (PARTITION BY b > 0) AS c FROM m
)
SELECT id_mutation, valeur_fonciere, round(p, 4) AS p_phys, round(c, 4) AS p_ctx,
  round(0.3 * p + 0.7 * c, 4) AS prediction FROM g"""

BATCH_BOOST_MEANS = MODEL_ROWS + """, last AS (
  SELECT a >= 3 AS many, avg(y) AS p FROM m WHERE year = (SELECT max(year) FROM m) GROUP BY 1
)
SELECT id_mutation, valeur_fonciere, round(p, 4) AS prediction FROM m JOIN last ON (a >= 3) = many"""

GAM_LINE = MODEL_ROWS + """
SELECT id_mutation, valeur_fonciere, round(2 * a + 3, 3) AS prediction FROM m"""

ELASTIC_NET_LINE = MODEL_ROWS + """, s AS (
  SELECT count(*) AS n, covar_pop(y, a) AS c, var_pop(a) AS v, avg(a) AS ma, avg(y) AS my FROM m
), w AS (SELECT *, sign(c) * greatest(abs(c) - 0.25, 0) / (v + 0.25) AS slope FROM s)
SELECT n, round(slope, 3) AS slope, round(my - slope * ma, 2) AS intercept FROM w"""

LINEAR_SHAPLEY = MODEL_ROWS + """, s AS (
  SELECT regr_slope(y, a) AS sa, regr_slope(y, b) AS sb, avg(a) AS ma, avg(b) AS mb FROM m
)
SELECT id_mutation, valeur_fonciere, 0 AS feature, round(0.3 * sa * (a - ma), 3) AS phi FROM m, s
UNION ALL
SELECT id_mutation, valeur_fonciere, 1 AS feature, round(0.7 * sb * (b - mb), 3) AS phi FROM m, s"""


def boosted_tree_sql(p: dict) -> str:
    """One tree of depth 2 on x = least(rooms, 6), by its definition: every threshold of every node is scored."""
    lam, alpha, gamma, child, rate = (float(p[k]) for k in ("lambda", "alpha", "gamma", "min_child_weight", "learning_rate"))

    def score(g, h):
        return f"power(greatest(abs({g}) - {alpha}, 0), 2) / ({h} + {lam})"

    def split(rows: str, name: str) -> str:
        """The best threshold of each node of ``rows`` (columns node, x, g), if any is good enough."""
        return f"""{name}_v AS (SELECT node, x, sum(g) AS g, count(*) AS h FROM {rows} GROUP BY node, x),
{name}_c AS (SELECT node, x, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY node) AS gt, sum(h) OVER (PARTITION BY node) AS ht
  FROM {name}_v WINDOW w AS (PARTITION BY node ORDER BY x)),
{name} AS (SELECT node, x AS cut FROM (SELECT *, {score('gl', 'hl')} + {score('(gt - gl)', '(ht - hl)')} - {score('gt', 'ht')} AS gain FROM {name}_c
    WHERE hl >= {child} AND ht - hl >= {child})
  WHERE gain > {gamma} QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, x) = 1)"""

    return MODEL_ROWS + f""", r0 AS (SELECT id_mutation, valeur_fonciere, y, least(a, 6e0) AS x, (SELECT avg(y) FROM m) - y AS g, 1 AS node FROM m),
{split('r0', 's1')},
r1 AS (SELECT r0.* EXCLUDE (node), CASE WHEN cut IS NULL THEN r0.node WHEN x <= cut THEN 2 ELSE 3 END AS node FROM r0 LEFT JOIN s1 ON s1.node = r0.node),
{split('r1', 's2')},
r2 AS (SELECT r1.* EXCLUDE (node), CASE WHEN cut IS NULL THEN r1.node WHEN x <= cut THEN 2 * r1.node ELSE 2 * r1.node + 1 END AS node
  FROM r1 LEFT JOIN s2 ON s2.node = r1.node),
leaf AS (SELECT node, -{rate} * sign(sum(g)) * greatest(abs(sum(g)) - {alpha}, 0) / (count(*) + {lam}) AS v FROM r2 GROUP BY node)
SELECT id_mutation, valeur_fonciere, round((SELECT avg(y) FROM m) + v, 4) AS prediction FROM r2 JOIN leaf ON leaf.node = r2.node"""


# Sums (s) and counts (n) of the few-rooms (0) and many-rooms (1) sales of each year; a split needs positive gain.
BATCH_BOOST_SHRUNK = MODEL_ROWS.replace("WITH", "WITH RECURSIVE", 1) + """, z AS (
  SELECT a >= 3 AS many, dense_rank() OVER (ORDER BY year) AS k, y FROM m
), b AS (SELECT k, coalesce(sum(y) FILTER (NOT many), 0) AS s0, count(*) FILTER (NOT many) AS n0,
                coalesce(sum(y) FILTER (many), 0) AS s1, count(*) FILTER (many) AS n1 FROM z GROUP BY k),
f AS (
  SELECT 0 AS k, avg(y) AS f0, avg(y) AS f1 FROM m
  UNION ALL
  SELECT k, f0 + CASE WHEN two THEN g0 / (n0 + 25) ELSE (g0 + g1) / (n0 + n1 + 25) END,
         f1 + CASE WHEN two THEN g1 / (n1 + 25) ELSE (g0 + g1) / (n0 + n1 + 25) END
  FROM (SELECT *, n0 > 0 AND n1 > 0 AND power(g0, 2) / (n0 + 25) + power(g1, 2) / (n1 + 25) - power(g0 + g1, 2) / (n0 + n1 + 25) > 1e-6 AS two
        FROM (SELECT b.k, f0, f1, n0, n1, s0 - n0 * f0 AS g0, s1 - n1 * f1 AS g1 FROM f JOIN b ON b.k = f.k + 1))
)
SELECT id_mutation, valeur_fonciere, round(CASE WHEN a >= 3 THEN f1 ELSE f0 END, 4) AS prediction FROM m JOIN f ON f.k = (SELECT max(k) FROM z)"""

# A boosted stump on a 0/1 column after n rounds at rate r: mean + (1 - (1 - r)^n) (group mean - mean), all of the other folds.
GRID_SEARCH_POINTS = MODEL_ROWS + """, z AS (SELECT y, a >= 3 AS p, b > 0 AS c, year % 3 AS fold FROM m),
k AS (SELECT DISTINCT fold FROM z),
o AS (SELECT k.fold, avg(y) AS m FROM z JOIN k ON z.fold <> k.fold GROUP BY k.fold),
gp AS (SELECT k.fold, p, avg(y) AS g FROM z JOIN k ON z.fold <> k.fold GROUP BY k.fold, p),
gc AS (SELECT k.fold, c, avg(y) AS g FROM z JOIN k ON z.fold <> k.fold GROUP BY k.fold, c),
x AS (SELECT z.fold, y, o.m, gp.g AS gp, gc.g AS gc FROM z JOIN o ON o.fold = z.fold JOIN gp ON gp.fold = z.fold AND gp.p = z.p
      JOIN gc ON gc.fold = z.fold AND gc.c = z.c),
grid AS (SELECT w, n, r, q FROM (VALUES (0.3e0), (0.7e0)) t1(w), (VALUES (1), (2)) t2(n), (VALUES (0.3e0), (0.6e0)) t3(r), (VALUES (0.5e0), (0.9e0)) t4(q)),
e AS (SELECT w, n, r, q, fold, avg(power(y - w * (m + (1 - power(1 - r, n)) * (gp - m)) - (1 - w) * (m + q * (gc - m)), 2)) AS mse
      FROM x, grid GROUP BY ALL),
s AS (SELECT w, n, r, q, avg(mse) AS mse FROM e GROUP BY ALL)
SELECT w AS physical_weight, CAST(n AS DOUBLE) AS physical_n_estimators, r AS physical_learning_rate, q AS contextual_learning_rate,
  round(mse, 2) AS mse, CAST(row_number() OVER (ORDER BY mse) AS INTEGER) AS rank FROM s"""

# Two players: half the step from the mean answer, half the step to the full answer.
TREE_SHAPLEY_GROUPS = MODEL_ROWS + """, z AS (SELECT id_mutation, valeur_fonciere, y, a >= 3 AS p, b > 0 AS c FROM m),
f AS (SELECT p, c, avg(y) AS f, count(*) AS n FROM z GROUP BY p, c),
e AS (SELECT sum(f * n) / sum(n) AS e FROM f),
px AS (SELECT x.p, sum(x.f * s.n) / sum(s.n) AS v FROM f x JOIN (SELECT c, sum(n) AS n FROM f GROUP BY c) s ON s.c = x.c GROUP BY x.p),
cx AS (SELECT x.c, sum(x.f * s.n) / sum(s.n) AS v FROM f x JOIN (SELECT p, sum(n) AS n FROM f GROUP BY p) s ON s.p = x.p GROUP BY x.c),
v AS (SELECT z.id_mutation, z.valeur_fonciere, f.f, px.v AS vp, cx.v AS vc, e FROM z JOIN f ON f.p = z.p AND f.c = z.c JOIN px ON px.p = z.p JOIN cx ON cx.c = z.c, e)
SELECT id_mutation, valeur_fonciere, 0 AS feature, round((vp - e + f - vc) / 2, 3) AS phi FROM v
UNION ALL
SELECT id_mutation, valeur_fonciere, 1 AS feature, round((vc - e + f - vp) / 2, 3) AS phi FROM v"""


def poi_json_counts_sql() -> str:
    """Tags written as JSON and read back by path; a cell of empty responses (100 degrees north of a page 0) has zeros."""
    counts = ", ".join(f"count(*) FILTER (WHERE cat = '{c}') AS {c}" for c in EXCLUSIVE_OUTPUT_COLUMNS)
    return duckdb_with("poi") + f""",
e AS (SELECT CAST(floor(lon) AS BIGINT) AS cell_lon, CAST(floor(lat) AS BIGINT) AS cell_lat, poi_id // 50 AS page,
             json_object('tags', json_object('amenity', amenity, 'leisure', leisure, 'tourism', tourism)) AS j FROM poi),
t AS (SELECT cell_lon, cell_lat, j ->> '$.tags.amenity' AS amenity, j ->> '$.tags.leisure' AS leisure, j ->> '$.tags.tourism' AS tourism FROM e),
c AS (SELECT cell_lon, cell_lat, {EXCLUSIVE_CASE} AS cat FROM t
      UNION ALL SELECT DISTINCT cell_lon, cell_lat + 100, NULL FROM e WHERE page = 0)
SELECT cell_lon, cell_lat, {counts} FROM c GROUP BY cell_lon, cell_lat
"""


ANOMALY_THRESHOLD = REGION_FEATURES + """,
s AS (SELECT region, year, type_local, id_mutation, valeur_fonciere, -abs(prix_m2 - 9000) AS score FROM rf),
t AS (SELECT region, year, type_local, quantile_cont(score, 0.1) AS threshold FROM s GROUP BY ALL)
SELECT s.region, s.year, s.type_local, id_mutation, valeur_fonciere, round(threshold, 6) AS threshold
FROM s JOIN t ON s.region = t.region AND s.year IS NOT DISTINCT FROM t.year AND s.type_local IS NOT DISTINCT FROM t.type_local
WHERE score >= threshold"""

# Least squares on two columns by region, nulls filled with the training rows' most frequent value (ties: the smallest).
REGION_TRAIN = REGION_FEATURES + f""",
lab AS (SELECT region, CASE WHEN {SPLIT_U} < 0.8 THEN 'train' ELSE 'test' END AS split, prix_m2 AS y,
               CAST(surface_terrain AS DOUBLE) AS a, CAST(year AS DOUBLE) AS b FROM rf),
ma AS (SELECT region, arg_min(a, (-n, a)) AS ma FROM (SELECT region, a, count(*) AS n FROM lab WHERE split = 'train' AND a IS NOT NULL GROUP BY ALL) GROUP BY region),
mb AS (SELECT region, arg_min(b, (-n, b)) AS mb FROM (SELECT region, b, count(*) AS n FROM lab WHERE split = 'train' AND b IS NOT NULL GROUP BY ALL) GROUP BY region),
z AS (SELECT lab.region, split, y, coalesce(a, ma, 0) AS a, coalesce(b, mb, 0) AS b FROM lab LEFT JOIN ma USING (region) LEFT JOIN mb USING (region)),
m AS (SELECT region, avg(a) AS a0, avg(b) AS b0, avg(y) AS y0, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS yb
      FROM z WHERE split = 'train' GROUP BY region),
w AS (SELECT region, a0, b0, y0, CASE WHEN bb = 0 THEN ay / nullif(aa, 0) ELSE coalesce((ay * bb - yb * ab) / nullif(aa * bb - ab * ab, 0), 0) END AS wa,
             CASE WHEN aa = 0 THEN yb / nullif(bb, 0) ELSE coalesce((yb * aa - ay * ab) / nullif(aa * bb - ab * ab, 0), 0) END AS wb FROM m),
p AS (SELECT z.region, split, y, y0 + wa * (a - a0) + wb * (b - b0) AS f, abs(wa * (a - a0)) AS pa, abs(wb * (b - b0)) AS pb FROM z JOIN w ON z.region = w.region)"""

REGION_TRAIN_METRICS = REGION_TRAIN + """
SELECT region, split, count(*) AS n, round(avg((y - f) * (y - f)), 2) AS mse, round(1 - sum((y - f) * (y - f)) / (count(y) * var_pop(y)), 6) AS r2
FROM p GROUP BY region, split"""

REGION_TRAIN_IMPACT = REGION_TRAIN + """,
i AS (SELECT region, avg(pa) AS pa, avg(pb) AS pb FROM p WHERE split = 'test' GROUP BY region)
SELECT region, 'physical' AS "group", round(pa, 4) AS impact, round(100 * pa / (pa + pb), 4) AS share_pct FROM i
UNION ALL SELECT region, 'contextual' AS "group", round(pb, 4) AS impact, round(100 * pb / (pa + pb), 4) AS share_pct FROM i"""
