"""Spatial joins against brute force, and plan shape."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelle.operators.spatial import knn_idw, radius_poi_counts


def _brute_knn(pts, grid, k):
    out = {}
    for (x, y) in pts:
        d = sorted(((gx - x) ** 2 + (gy - y) ** 2, gid, v) for gid, gx, gy, v in grid)[:k]
        w = [1.0 / (1e-10 if dd == 0 else math.sqrt(dd)) for dd, _, _ in d]
        out[(x, y)] = sum(wi * v for wi, (_, _, v) in zip(w, d)) / sum(w)
    return out


@pytest.mark.parametrize("seed,clustered", [(1, False), (2, True)])
def test_knn_equals_brute_force(spark, seed, clustered):
    rng = np.random.default_rng(seed)
    n = 300
    if clustered:  # dense city + empty space: forces ring growth
        gx = np.concatenate([rng.normal(0, 0.05, n - 20), rng.uniform(-5, 5, 20)])
        gy = np.concatenate([rng.normal(0, 0.05, n - 20), rng.uniform(-5, 5, 20)])
    else:
        gx, gy = rng.uniform(0, 3, n), rng.uniform(0, 3, n)
    grid = [(i, float(gx[i]), float(gy[i]), float(rng.integers(0, 100))) for i in range(n)]
    pts = [(float(x), float(y)) for x, y in zip(rng.uniform(-6, 6, 150), rng.uniform(-6, 6, 150))]
    pts += [(grid[0][1], grid[0][2])]  # exactly on a grid point
    gdf = spark.createDataFrame(grid, "grid_id long, lon double, lat double, densite double")
    pdf = spark.createDataFrame(pts, "longitude double, latitude double")
    got = {(r.longitude, r.latitude): r.densite_weighted
           for r in knn_idw(pdf, gdf, k=4, measures=["densite"]).collect()}
    want = _brute_knn(pts, grid, 4)
    assert set(got) == set(want)
    for key in want:
        assert math.isclose(got[key], want[key], rel_tol=1e-9, abs_tol=1e-9)
    # an inverse-distance mean lies between its k neighbours' min and max
    for (x, y), v in got.items():
        near = sorted(((gx_ - x) ** 2 + (gy_ - y) ** 2, gid, m) for gid, gx_, gy_, m in grid)[:4]
        vals = [m for _, _, m in near]
        assert min(vals) - 1e-9 <= v <= max(vals) + 1e-9


def test_knn_k1_and_too_few(spark):
    gdf = spark.createDataFrame([(1, 0.0, 0.0, 5.0), (2, 1.0, 1.0, 7.0)],
                                "grid_id long, lon double, lat double, densite double")
    pdf = spark.createDataFrame([(0.9, 0.9)], "longitude double, latitude double")
    assert knn_idw(pdf, gdf, k=1, measures=["densite"]).first().densite_weighted == 7.0
    with pytest.raises(ValueError):
        knn_idw(pdf, gdf, k=3, measures=["densite"])


def test_isolated_cell_kept_with_zeros(spark):
    grid = spark.createDataFrame([(1, 10.0, 45.0, 300.0)], "grid_id long, lon double, lat double, densite double")
    poi = spark.createDataFrame(
        [(1, 0.0, 45.0, "cafe", "bakery", None, None, None, "x")],
        "poi_id long, lon double, lat double, amenity string, shop string, leisure string, "
        "public_transport string, tourism string, name string")
    r = radius_poi_counts(grid, poi, 500.0).first()
    assert r.food_pois == 0 and r.shopping_pois == 0


def test_two_categories_counted(spark):
    grid = spark.createDataFrame([(1, 2.0, 45.0, 300.0)], "grid_id long, lon double, lat double, densite double")
    poi = spark.createDataFrame(
        [(1, 2.0001, 45.0, "cafe", "bakery", None, None, None, "x")],
        "poi_id long, lon double, lat double, amenity string, shop string, leisure string, "
        "public_transport string, tourism string, name string")
    r = radius_poi_counts(grid, poi, 500.0).first()
    assert r.food_pois == 1 and r.shopping_pois == 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_radius_join_is_not_nested_loop(spark):
    from parcelle.sources import fixtures as fx
    from conftest import SF_SMALL
    df = radius_poi_counts(fx.grid(spark, SF_SMALL), fx.poi(spark, SF_SMALL), 20000.0)
    df.count()
    plan = _plan(df)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def _executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_relational_operators_stay_jvm_side(spark):
    """Roll-up, cleaning and the radius join run without Python workers, and
    the cleaner's simple conjuncts reach the parquet scan."""
    from conftest import SF_SMALL
    from parcelle.operators.cleaning import clean
    from parcelle.operators.features import create_features
    from parcelle.sources import fixtures as fx
    f = create_features(clean(fx.dvf(spark, SF_SMALL), nombre_lots_max=5), 3000.0, 18000.0)
    plan = _executed(f)
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    scan = f._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_partkey)" in scan or "IsNotNull" in scan
    r = radius_poi_counts(fx.grid(spark, SF_SMALL), fx.poi(spark, SF_SMALL), 20000.0)
    assert "Python" not in _executed(r)


def test_results_independent_of_shuffle_partitions(spark):
    from conftest import SF_SMALL
    from parcelle.plans.queries import q_knn_weighted, q_mutation_rollup
    a = sorted(q_mutation_rollup(spark, SF_SMALL).collect())
    ka = sorted(q_knn_weighted(spark, SF_SMALL).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        b = sorted(q_mutation_rollup(spark, SF_SMALL).collect())
        kb = sorted(q_knn_weighted(spark, SF_SMALL).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b and ka == kb


def test_knn_round_reuses_distinct_partitioning(spark, monkeypatch):
    """The first kNN round shuffles once (the distinct points): the top-k
    window and the per-point sums reuse that partitioning."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic
    plans, orig = [], Classic.checkpoint

    def spy(self, eager=True):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return orig(self, eager)

    rng = np.random.default_rng(3)
    pts = spark.createDataFrame([(float(x), float(y)) for x, y in rng.uniform(0, 1, (300, 2))],
                                "longitude double, latitude double")
    grid = spark.createDataFrame([(i, float(x), float(y), float(i)) for i, (x, y)
                                  in enumerate(rng.uniform(0, 1, (200, 2)))],
                                 "grid_id long, lon double, lat double, densite double")
    monkeypatch.setattr(Classic, "checkpoint", spy)
    knn_idw(pts, grid, k=4, measures=["densite"])
    first = plans[0]
    shuffles = first.count("Exchange hashpartitioning") + first.count("Exchange rangepartitioning")
    assert shuffles == 1, first


def test_knn_point_keys_exact(spark):
    """Coordinates that print long, and -0.0 vs 0.0, join back exactly once."""
    xs = [0.1 + 0.2, 1e-300, 123456789.12345679, -0.0, 0.0, 2.5]
    pts = spark.createDataFrame([(i, x, 0.5) for i, x in enumerate(xs)], "id long, longitude double, latitude double")
    grid = spark.createDataFrame([(i, float(i) / 4, 0.5, float(i)) for i in range(8)],
                                 "grid_id long, lon double, lat double, densite double")
    got = {r.id: r.densite_weighted for r in knn_idw(pts, grid, k=1, measures=["densite"]).collect()}
    assert sorted(got) == list(range(len(xs)))
    assert got[3] == got[4] == 0.0 and got[0] == pytest.approx(1.0) and got[5] == pytest.approx(7.0)


def test_counts_around_point_one_row_even_when_empty(spark):
    from parcelle.operators.spatial import poi_counts_around
    poi = spark.createDataFrame(
        [(2.5, 47.0, "school", None, None, None, None, "a"),
         (2.5001, 47.0, None, "bakery", None, None, None, None)],
        "lon double, lat double, amenity string, shop string, leisure string, "
        "public_transport string, tourism string, name string")
    near = poi_counts_around(poi, 2.5, 47.0, 500.0).collect()
    assert len(near) == 1 and near[0].education_pois == 1 and near[0].shopping_pois == 1
    far = poi_counts_around(poi, -20.0, 10.0, 500.0).collect()
    assert len(far) == 1 and all(v == 0 for v in far[0])
    assert poi_counts_around(poi, 2.5, 47.0, 500.0, named_only=True).first().shopping_pois == 0


def test_radius_join_back_reuses_aggregate_partitioning(spark):
    """Shuffles: the grid-key aggregate (once per use: cells, join back), the
    POI points and the per-key counts.  Joining the zero-count keys back onto
    the grid adds none: both sides are already partitioned by the text key."""
    from parcelle.sources import fixtures as fx
    from conftest import SF_SMALL
    df = radius_poi_counts(fx.grid(spark, SF_SMALL), fx.poi(spark, SF_SMALL), 20000.0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 4, plan
    join = plan[plan.index("SortMergeJoin"):]
    first_two = [ln.strip() for ln in join.splitlines()[1:4]]
    assert not any(ln.startswith(("+- Exchange", ":- Exchange")) for ln in first_two), plan


def test_exploded_cells_are_not_broadcast_on_sparks_estimate(spark):
    from parcelle.operators.spatial import radius_exclusive_counts, radius_poi_counts_per_row
    tags = ("amenity", "shop", "leisure", "public_transport", "tourism", "name")
    grid = spark.createDataFrame([(i, 2.0 + i / 100, 48.0, 900.0) for i in range(50)], "grid_id long, lon double, lat double, densite double")
    poi = spark.createDataFrame([(2.0 + i / 90, 48.0, "school", None, None, None, None, "x") for i in range(50)],
                                "lon double, lat double, " + ", ".join(f"{t} string" for t in tags))
    for query in (radius_exclusive_counts, radius_poi_counts_per_row):
        small = sorted(query(grid, poi, 2000.0).collect())
        spark.conf.set("parcelle.broadcastLimitBytes", "1")
        try:
            out = query(grid, poi, 2000.0)
            assert "SortMergeJoin [kx" in out._jdf.queryExecution().sparkPlan().toString()
            assert sorted(out.collect()) == small and sum(map(sum, [r[4:] for r in small]))
        finally:
            spark.conf.unset("parcelle.broadcastLimitBytes")
