"""Hand-made rows for each trap listed in FIXTURES §2.2."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelle.operators.cleaning import clean
from parcelle.operators.encode import OneHot, RobustScaler, column_modes, exact_quantiles
from parcelle.operators.evaluate import binned_curve
from parcelle.operators.features import create_features, price_band, price_per_m2, rollup_mutations
from parcelle.schemas import TRANSACTION_SCHEMA

COLS = [f.name for f in TRANSACTION_SCHEMA.fields]


def lines(spark, rows):
    """rows: dicts with overrides; seq1 gives file order."""
    base = {c: None for c in COLS}
    base.update(id_mutation="m1", date_mutation=dt.date(2021, 3, 1), nombre_lots=1.0,
                longitude=2.0, latitude=48.0, valeur_fonciere=200000.0, surface_reelle_bati=50.0)
    out = []
    for i, r in enumerate(rows):
        d = dict(base)
        d.update(r)
        out.append(tuple(d[c] for c in COLS) + (i,))
    schema = T.StructType(TRANSACTION_SCHEMA.fields + [T.StructField("seq1", T.LongType())])
    return spark.createDataFrame(out, schema)


def roll(df):
    return rollup_mutations(df, order_cols=("seq1",))


def test_null_lots_dropped(spark):
    df = lines(spark, [{"nombre_lots": None}, {"id_mutation": "m2"}])
    assert [r.id_mutation for r in clean(df).collect()] == ["m2"]


def test_all_null_rooms_sum_to_zero(spark):
    df = lines(spark, [{"nombre_pieces_principales": None}, {"nombre_pieces_principales": None}])
    assert roll(df).first()["nombre_pieces_principales"] == 0.0


def test_null_type_in_group_is_unknown(spark):
    df = lines(spark, [{"type_local": "Maison"}, {"type_local": None}])
    assert roll(df).first()["type_local"] == "Unknown"


def test_type_join_sorted_distinct(spark):
    df = lines(spark, [{"type_local": t} for t in ("Maison", "Appartement", "Maison")])
    assert roll(df).first()["type_local"] == "Appartement, Maison"


def test_lot_mean_over_zero_filled(spark):
    df = lines(spark, [{"lot1_surface_carrez": 40.0}, {"lot1_surface_carrez": None}])
    assert roll(df).first()["lot1_surface_carrez"] == 20.0


def test_first_follows_file_order(spark):
    df = lines(spark, [{"longitude": 1.5, "date_mutation": dt.date(2020, 1, 5)},
                       {"longitude": 9.0, "date_mutation": dt.date(2021, 6, 1)}])
    r = roll(df).first()
    assert (r.longitude, r.year) == (1.5, 2020)
    assert math.isclose(r.sin_month, math.sin(1 / 12))


def test_divisor_order(spark):
    df = lines(spark, [{"lot1_surface_carrez": 0.0, "surface_terrain": 100.0,
                        "surface_reelle_bati": 50.0, "valeur_fonciere": 1e6}])
    assert price_per_m2(roll(df)).first()["prix_m2"] == 10000.0


def test_no_surface_dropped(spark):
    df = lines(spark, [{"surface_reelle_bati": 0.0}])
    assert create_features(df, order_cols=("seq1",)).count() == 0


def test_band_edges(spark):
    df = spark.createDataFrame([(3000.0,), (18000.0,)], "prix_m2 double")
    assert [r.prix_m2 for r in price_band(df, 3000.0, 18000.0).collect()] == [18000.0]


def test_robust_scaler_zero_iqr_divides_by_one(spark):
    df = spark.createDataFrame([(0.0,)] * 8 + [(50.0,)], "x double")
    m = RobustScaler(["x"]).fit(df)
    assert sorted(r.x for r in m.transform(df).collect())[-1] == 50.0


def test_quantiles_match_numpy(spark):
    import numpy as np
    vals = [float(v) for v in np.random.default_rng(3).integers(0, 40, 301)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r.p: r.value for r in exact_quantiles(df, ["x"], (0.1, 0.25, 0.5, 0.9)).collect()}
    for p, v in got.items():
        assert math.isclose(v, float(np.percentile(vals, p * 100)), abs_tol=1e-9)


def test_unknown_category_all_zero(spark):
    df = spark.createDataFrame([("a",), ("b",)], "t string")
    m = OneHot("t").fit(df)
    out = m.transform(spark.createDataFrame([("zzz",), (None,)], "t string"))
    assert all(sum(r[c] for c in m.columns()) == 0 for r in out.collect())


def test_mode_tie_smallest(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    assert column_modes(df, ["x"]).first()["mode"] == 1.0


def test_bin_edge(spark):
    df = spark.createDataFrame([(0.0, 1.0), (5.0, 2.0), (10.0, 3.0)], "y double, prediction double")
    b = {r.bin: r for r in binned_curve(df, dx=5.0).collect()}
    assert sorted(b) == [0, 1]
    assert b[0].n == 1 and b[1].n == 1 and b[1].bin_center == 7.5


def test_empty_bin_is_null(spark):
    df = spark.createDataFrame([(0.0, 1.0), (12.0, 3.0)], "y double, prediction double")
    b = {r.bin: r for r in binned_curve(df, dx=5.0).collect()}
    assert b[1].mean_prediction is None and b[1].n == 0


def test_block_encoder_fused_fit_equals_step_by_step(spark):
    """One count table per block gives the same modes, categories, medians and
    IQRs as imputer → one-hot → imputer → scaler fitted step by step."""
    from parcelle.operators.encode import BlockEncoder, ModeImputer, OneHot, RobustScaler
    rows = [("b", 1.0, None), ("a", 2.0, 5.0), (None, None, 5.0), ("b", 2.0, 7.0),
            ("c", 9.0, None), ("b", 4.0, 1.0), (None, 2.0, None), ("a", None, 3.0)]
    df = spark.createDataFrame(rows, "t string, x double, y double")
    m = BlockEncoder(["t"], ["x", "y"], None, "v").fit(df)
    ci = ModeImputer(["t"]).fit(df)
    oh = OneHot("t").fit(ci.transform(df))
    ni = ModeImputer(["x", "y"]).fit(df)
    sc = RobustScaler(["x", "y"]).fit(ni.transform(df))
    assert m.cat_imputer.modes == ci.modes and m.onehots[0].categories == oh.categories
    assert m.num_imputer.modes == ni.modes
    assert m.scaler.median == sc.median and m.scaler.iqr == sc.iqr


def test_sized_conf_bounds():
    from parcelle.session import sized_conf
    small, mid, huge = sized_conf(10 ** 6), sized_conf(2 * 1024 ** 4), sized_conf(100 * 1024 ** 4, max_partitions=32768)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert mid["spark.sql.shuffle.partitions"] == str(2 * 1024 ** 4 // (256 * 1024 ** 2))
    assert huge["spark.sql.shuffle.partitions"] == "32768"
    assert sized_conf(100 * 1024 ** 4)["spark.sql.shuffle.partitions"] == str(100 * 1024 ** 4 // (256 * 1024 ** 2))
    assert huge["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 ** 2)


@pytest.mark.parametrize("accuracy", [1, 50, 100_000])
def test_banded_quantiles_equal_numpy(spark, accuracy):
    import numpy as np
    from parcelle.operators.encode import exact_quantiles_long
    rng = np.random.default_rng(11)
    data = {"g1": rng.integers(0, 20, 500).astype(float),      # many ties
            "g2": rng.normal(size=301), "g3": np.array([4.0]), "g4": np.array([2.0, 1.0])}
    rows = [(k, float(v)) for k, vs in data.items() for v in vs] + [("g1", None)]
    df = spark.createDataFrame(rows, "feature string, value double")
    got = {(r.feature, r.p): r.value for r in exact_quantiles_long(df, (0.1, 0.25, 0.5, 0.75), accuracy).collect()}
    for k, vs in data.items():
        for p in (0.1, 0.25, 0.5, 0.75):
            assert got[(k, p)] == pytest.approx(float(np.quantile(vs, p)), abs=1e-12)


def test_banded_quantiles_fall_back_when_band_misses(spark, monkeypatch):
    import numpy as np
    from parcelle.operators import encode
    real = encode.F.percentile_approx
    # a sketch that brackets nothing useful: every bound is the maximum
    monkeypatch.setattr(encode.F, "percentile_approx",
                        lambda c, qs, acc: encode.F.array(*[encode.F.max(c)] * len(qs)))
    vs = np.arange(100.0)
    df = spark.createDataFrame([("x", float(v)) for v in vs], "feature string, value double")
    got = {r.p: r.value for r in encode.exact_quantiles_long(df, (0.25, 0.5)).collect()}
    monkeypatch.setattr(encode.F, "percentile_approx", real)
    assert got == {0.25: np.quantile(vs, 0.25), 0.5: np.quantile(vs, 0.5)}
