"""Schemas, feature lists, category lists and the region dimension.

Everything under a "FIXED VALUES" comment must equal the values the original
pipeline uses; they are stated plainly, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES — raw transaction schema (15 columns projected at scan)
# ---------------------------------------------------------------------------
TRANSACTION_COLUMNS = [
    ("id_mutation", T.StringType()),
    ("date_mutation", T.DateType()),
    ("type_local", T.StringType()),
    ("surface_reelle_bati", T.FloatType()),
    ("nombre_lots", T.FloatType()),
    ("lot1_surface_carrez", T.FloatType()),
    ("lot2_surface_carrez", T.FloatType()),
    ("lot3_surface_carrez", T.FloatType()),
    ("lot4_surface_carrez", T.FloatType()),
    ("lot5_surface_carrez", T.FloatType()),
    ("nombre_pieces_principales", T.FloatType()),
    ("surface_terrain", T.FloatType()),
    ("longitude", T.FloatType()),
    ("latitude", T.FloatType()),
    ("valeur_fonciere", T.DoubleType()),
]
TRANSACTION_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in TRANSACTION_COLUMNS])

LOT_COLUMNS = [f"lot{i}_surface_carrez" for i in range(1, 6)]
SURFACE_COLUMNS = ["surface_reelle_bati", "surface_terrain"] + LOT_COLUMNS

# ---------------------------------------------------------------------------
# FIXED VALUES — grid (population cell + POI counts) measures, weighted by the kNN join
# ---------------------------------------------------------------------------
POI_COUNT_COLUMNS = [
    "transport_pois", "education_pois", "health_pois", "food_pois",
    "shopping_pois", "park_pois", "entertainment_pois", "cultural_pois",
]
GRID_MEASURES = ["densite"] + POI_COUNT_COLUMNS

# FIXED VALUES — preprocessed table: feature columns and their stored types
PREPROCESSED_FLOAT_COLUMNS = [
    "surface_reelle_bati", "sin_month", "cos_month", "nombre_lots",
    "total_surface_carrez", *LOT_COLUMNS, "nombre_pieces_principales",
    "surface_terrain", "longitude", "latitude",
    *[f"{c}_weighted" for c in GRID_MEASURES],
]

# ---------------------------------------------------------------------------
# FIXED VALUES — feature groups of the price-per-m² combined model
# ---------------------------------------------------------------------------
PHYSICAL_FEATURES = [
    "surface_reelle_bati", "type_local", "nombre_pieces_principales", "nombre_lots",
    "total_surface_carrez", "lot1_surface_carrez", "lot2_surface_carrez",
    "lot3_surface_carrez", "lot4_surface_carrez", "lot5_surface_carrez",
    "surface_terrain",
]
CONTEXTUAL_FEATURES = [
    "year", "sin_month", "cos_month", "longitude", "latitude",
    "densite_weighted", "transport_pois_weighted", "education_pois_weighted",
    "health_pois_weighted", "food_pois_weighted", "shopping_pois_weighted",
    "park_pois_weighted", "entertainment_pois_weighted", "cultural_pois_weighted",
]
CATEGORICAL_PHYSICAL = ["type_local"]
NUMERIC_PHYSICAL = [c for c in PHYSICAL_FEATURES if c != "type_local"]
NUMERIC_CONTEXTUAL = list(CONTEXTUAL_FEATURES)

# FIXED VALUES — all-feature list of the price model (one categorical + 24 numeric)
PRICE_MODEL_CATEGORICAL = ["type_local"]
PRICE_MODEL_NUMERIC = [
    "surface_reelle_bati", "year", "sin_month", "cos_month", "nombre_lots",
    "total_surface_carrez", "lot1_surface_carrez", "lot2_surface_carrez",
    "lot3_surface_carrez", "lot4_surface_carrez", "lot5_surface_carrez",
    "nombre_pieces_principales", "surface_terrain", "longitude", "latitude",
    "densite_weighted", "transport_pois_weighted", "education_pois_weighted",
    "health_pois_weighted", "food_pois_weighted", "shopping_pois_weighted",
    "park_pois_weighted", "entertainment_pois_weighted", "cultural_pois_weighted",
]

# FIXED VALUES — columns the isolation forest looks at
ANOMALY_COLUMNS = [
    "surface_reelle_bati", "nombre_lots", "surface_terrain",
    "nombre_pieces_principales", "total_surface_carrez", "densite_weighted",
]

# ---------------------------------------------------------------------------
# FIXED VALUES — POI tag categories (multi-label, set-based radius count)
# ---------------------------------------------------------------------------
TRANSPORT_VALUES = ["stop_position", "station", "subway", "railway"]
EDUCATION_VALUES = ["school", "college", "prep_school"]
HEALTH_VALUES = ["hospital", "clinic", "pharmacy", "doctors"]
FOOD_VALUES = ["restaurant", "cafe", "bar", "pub", "fast_food"]
SHOPPING_AMENITY_VALUES = ["marketplace"]
PARK_LEISURE_VALUES = ["park"]
ENTERTAINMENT_VALUES = ["cinema", "theatre", "bowling", "nightclub"]
CULTURAL_VALUES = ["library", "community_centre", "arts_centre", "museum"]

# FIXED VALUES — exclusive (first match wins) categories of the web-API variant,
# in priority order; "museum" counts as cultural through the tourism tag there.
EXCLUSIVE_SCHOOLS = ["school", "college", "prep_school"]
EXCLUSIVE_HEALTHCARE = ["hospital", "clinic", "pharmacy", "doctors"]
EXCLUSIVE_RESTAURANTS = ["restaurant", "cafe", "bar", "pub", "fast_food"]
EXCLUSIVE_SHOPS = ["marketplace", "shop"]
EXCLUSIVE_ENTERTAINMENT = ["cinema", "theatre", "bowling", "nightclub"]
EXCLUSIVE_CULTURAL = ["library", "community_centre", "arts_centre"]
EXCLUSIVE_OUTPUT_COLUMNS = [
    "amenities", "transports", "shops", "schools", "parks", "restaurants",
    "healthcare", "entertainment", "cultural_places",
]

# ---------------------------------------------------------------------------
# FIXED VALUES — regions and their departments (13 regions, 96 departments)
# ---------------------------------------------------------------------------
REGIONS = {
    "Auvergne-Rhône-Alpes": ["01", "03", "07", "15", "26", "38", "42", "43", "63", "69", "73", "74"],
    "Bourgogne-Franche-Comté": ["21", "25", "39", "58", "70", "71", "89", "90"],
    "Bretagne": ["22", "29", "35", "56"],
    "Centre-Val de Loire": ["18", "28", "36", "37", "41", "45"],
    "Corse": ["2A", "2B"],
    "Grand Est": ["08", "10", "51", "52", "54", "55", "57", "67", "68", "88"],
    "Hauts-de-France": ["02", "59", "60", "62", "80"],
    "Île-de-France": ["75", "77", "78", "91", "92", "93", "94", "95"],
    "Normandie": ["14", "27", "50", "61", "76"],
    "Nouvelle-Aquitaine": ["16", "17", "19", "23", "24", "33", "40", "47", "64", "79", "86", "87"],
    "Occitanie": ["09", "11", "12", "30", "31", "32", "34", "46", "48", "65", "66", "81", "82"],
    "Pays de la Loire": ["44", "49", "53", "72", "85"],
    "Provence-Alpes-Côte d'Azur": ["04", "05", "06", "13", "83", "84"],
}

# FIXED VALUES — years the jobs process
YEARS = ["2019", "2020", "2021", "2022", "2023", "2024"]

# FIXED VALUES — job parameters
JOB_CLEANER = dict(nombre_lots_max=5, valeur_min=0.75e5, valeur_max=1e9,
                   surface_min=15.0, surface_max=1e9)
JOB_PRICE_BAND = (3e3, 18e3)
JOB_KNN_K = 4
JOB_POI_RADIUS = 500.0
JOB_CONTAMINATION = 0.1
