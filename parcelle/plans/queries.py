"""Registered queries: one per operator family, each over the whole fixture
tables of an ``sf_dir``.  ``ORACLES`` holds the DuckDB text of the same
result; queries whose result depends on a fitted model have no oracle and
are checked by properties in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.operators.cleaning import clean, total_surface
from parcelle.operators.features import create_features, rollup_mutations
from parcelle.plans import oracle_sql as O
from parcelle.schemas import JOB_CLEANER, JOB_CONTAMINATION, JOB_PRICE_BAND, LOT_COLUMNS
from parcelle.sources import fixtures as fx

FEATURE_DOUBLES = O.FEATURE_DOUBLES


def rnd(*cols, d: int = 6):
    return [F.round(F.col(c), d).alias(c) for c in cols]


def _cleaned(spark, sf_dir):
    return clean(fx.dvf(spark, sf_dir), **JOB_CLEANER)


def _features(spark, sf_dir):
    return create_features(_cleaned(spark, sf_dir), *JOB_PRICE_BAND)


def q_clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _cleaned(spark, sf_dir)
    return c.select("id_mutation", "seq1", "seq2", "seq3",
                    F.round(total_surface(c), 6).alias("surface_totale"))


def q_mutation_rollup(spark, sf_dir):
    r = rollup_mutations(_cleaned(spark, sf_dir))
    return r.select("id_mutation", "year", "type_local", *rnd(*FEATURE_DOUBLES))


def q_price_features(spark, sf_dir):
    f = _features(spark, sf_dir)
    return f.select("id_mutation", "year", "type_local", *rnd(*FEATURE_DOUBLES),
                    *rnd("total_surface_carrez"), "prix_m2")


def q_price_by_type_year(spark, sf_dir):
    """Flagship: sales count, mean and exact median price per m² by type and year."""
    from parcelle.operators.encode import grouped_quantiles
    f = _features(spark, sf_dir).select("type_local", "year", "prix_m2").checkpoint()
    stats = (f.groupBy("type_local", "year")
             .agg(F.count(F.lit(1)).alias("n_sales"),
                  F.round(F.avg("prix_m2"), 4).alias("mean_prix_m2")))
    med = grouped_quantiles(f, ["type_local", "year"], "prix_m2", [0.5]).select(
        "type_local", "year", F.round("value", 4).alias("median_prix_m2"))
    return stats.join(med, [stats.type_local.eqNullSafe(med.type_local),
                            stats.year.eqNullSafe(med.year)]).select(
        stats.type_local, stats.year, "n_sales", "mean_prix_m2", "median_prix_m2")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_rows": q_clean_rows,
    "mutation_rollup": q_mutation_rollup,
    "price_features": q_price_features,
    "price_by_type_year": q_price_by_type_year,
}

ORACLES: dict[str, str] = {
    "clean_rows": O.CLEAN_ROWS,
    "mutation_rollup": O.MUTATION_ROLLUP,
    "price_features": O.PRICE_FEATURES,
    "price_by_type_year": O.PRICE_BY_TYPE_YEAR,
}


# ---------------------------------------------------------------------------
# Spatial
# ---------------------------------------------------------------------------
from parcelle.operators.spatial import (  # noqa: E402
    knn_idw, radius_exclusive_counts, radius_poi_counts, radius_poi_counts_per_row,
)
from parcelle.schemas import GRID_MEASURES  # noqa: E402

FIXTURE_RADIUS = O.FIXTURE_RADIUS
FIXTURE_MIN_DENSITY = O.FIXTURE_MIN_DENSITY


def q_radius_poi_counts(spark, sf_dir):
    """Grid × POI radius join, 8 multi-label counts per (lat, lon, densite)."""
    return radius_poi_counts(fx.grid(spark, sf_dir), fx.poi(spark, sf_dir), FIXTURE_RADIUS)


def q_radius_named_per_row(spark, sf_dir):
    """Per grid row, named POIs only (the per-point query variant)."""
    return radius_poi_counts_per_row(fx.grid(spark, sf_dir), fx.poi(spark, sf_dir),
                                     FIXTURE_RADIUS, named_only=True)


def q_radius_density_gated(spark, sf_dir):
    """Only cells at or above the density threshold are enriched."""
    return radius_poi_counts(fx.grid(spark, sf_dir), fx.poi(spark, sf_dir), FIXTURE_RADIUS,
                             min_density=FIXTURE_MIN_DENSITY)


def q_radius_exclusive(spark, sf_dir):
    """Great-circle radius, amenity-tagged POIs, first-match categories."""
    return radius_exclusive_counts(fx.grid(spark, sf_dir), fx.poi(spark, sf_dir), FIXTURE_RADIUS,
                                   min_density=FIXTURE_MIN_DENSITY)


def q_knn_weighted(spark, sf_dir):
    """Each priced sale with inverse-distance means of its 4 nearest grid rows."""
    # checkpointed: the kNN reads the sales twice (distinct points, join back)
    f = (_features(spark, sf_dir).select("id_mutation", "valeur_fonciere", "longitude", "latitude")
         .checkpoint())
    out = knn_idw(f, fx.grid(spark, sf_dir), k=4)
    return out.select("id_mutation", "valeur_fonciere",
                      *rnd(*[f"{m}_weighted" for m in GRID_MEASURES]))


QUERIES.update({
    "radius_poi_counts": q_radius_poi_counts,
    "radius_named_per_row": q_radius_named_per_row,
    "radius_density_gated": q_radius_density_gated,
    "radius_exclusive": q_radius_exclusive,
    "knn_weighted": q_knn_weighted,
})
ORACLES.update({
    "radius_poi_counts": O.radius_counts_sql(),
    "radius_named_per_row": O.radius_counts_named_sql(),
    "radius_density_gated": O.radius_gated_sql(),
    "radius_exclusive": O.exclusive_counts_sql(),
    "knn_weighted": O.knn_sql(4),
})


# ---------------------------------------------------------------------------
# Regions, splits, encoders, evaluation, links, resume
# ---------------------------------------------------------------------------
from parcelle.functions.columns import hash_uniform  # noqa: E402
from parcelle.models.baseline import GroupMeanRegressor  # noqa: E402
from parcelle.operators import encode as enc  # noqa: E402
from parcelle.operators import splits as sp  # noqa: E402
from parcelle.operators.evaluate import binned_curve, regression_metrics  # noqa: E402
from parcelle.operators.regions import with_region  # noqa: E402
from parcelle.schemas import NUMERIC_PHYSICAL  # noqa: E402
from parcelle.sources.links import extract_links  # noqa: E402

KEY = ("id_mutation",)
TIE = ("id_mutation", "valeur_fonciere")


def _split_features(spark, sf_dir):
    return sp.hash_split(_features(spark, sf_dir), KEY, 0.8)


def q_region_sales(spark, sf_dir):
    """Department → region lookup (broadcast dimension) before the roll-up,
    which is then scoped by region as in the per-region jobs."""
    c = with_region(_cleaned(spark, sf_dir))
    f = create_features(c, *JOB_PRICE_BAND, partition_cols=("region",))
    return f.groupBy("region", "year").agg(F.count(F.lit(1)).alias("n_sales"),
                                           F.round(F.avg("prix_m2"), 4).alias("mean_prix_m2"))


def q_hash_split(spark, sf_dir):
    return _split_features(spark, sf_dir).select("id_mutation", "valeur_fonciere", "split")


def q_kfold_assign(spark, sf_dir):
    tr = _split_features(spark, sf_dir).filter(F.col("split") == "train")
    return sp.kfold(tr, KEY, 3).select("id_mutation", "valeur_fonciere", "fold")


def q_exact_batches(spark, sf_dir):
    f = _features(spark, sf_dir).withColumn("_u", hash_uniform("id_mutation", seed="batch"))
    return (sp.exact_batches(f, ["_u", "id_mutation", "valeur_fonciere"], 1000)
            .select("id_mutation", "valeur_fonciere", "batch_id"))


def q_sample_rows(spark, sf_dir):
    return sp.sample_k(_features(spark, sf_dir), KEY, 250, seed="pick",
                       tie_cols=("valeur_fonciere",)).select("id_mutation", "valeur_fonciere", "prix_m2")


def q_category_list(spark, sf_dir):
    return enc.category_list(_features(spark, sf_dir), "type_local")


def q_column_modes(spark, sf_dir):
    tr = _split_features(spark, sf_dir).filter(F.col("split") == "train")
    return enc.column_modes(tr, NUMERIC_PHYSICAL)


def q_quartiles(spark, sf_dir):
    # written once: the quantiles read the rows twice, and the roll-up is the dear part
    q = enc.exact_quantiles(_features(spark, sf_dir).select(*NUMERIC_PHYSICAL).checkpoint(), NUMERIC_PHYSICAL)
    return q.select("feature", "p", F.round("value", 6).alias("value"))


def q_robust_scaled(spark, sf_dir):
    s = _split_features(spark, sf_dir).select("split", "id_mutation", "valeur_fonciere", *NUMERIC_PHYSICAL).checkpoint()
    model = enc.RobustScaler(NUMERIC_PHYSICAL).fit(s.filter(F.col("split") == "train"))
    te = model.transform(s.filter(F.col("split") == "test"))
    return te.select("id_mutation", "valeur_fonciere", *rnd(*NUMERIC_PHYSICAL))


def q_onehot_type(spark, sf_dir):
    f = _features(spark, sf_dir)
    m = enc.OneHot("type_local").fit(f)
    out = m.transform(f)
    return out.select("id_mutation", "valeur_fonciere",
                      F.concat_ws(",", *[F.col(c).cast("int").cast("string") for c in m.columns()])
                      .alias("onehot"))


def _baseline_predictions(spark, sf_dir):
    s = _split_features(spark, sf_dir)
    model = GroupMeanRegressor(["type_local"], "prix_m2").fit(s.filter(F.col("split") == "train"))
    return model.transform(s).select("split", F.col("prix_m2").alias("y"), "prediction")


def q_baseline_metrics(spark, sf_dir):
    m = regression_metrics(_baseline_predictions(spark, sf_dir), by=["split"])
    return m.select("split", "n", F.round("mse", 2).alias("mse"), F.round("r2", 8).alias("r2"))


def q_binned_curve(spark, sf_dir):
    t = _baseline_predictions(spark, sf_dir).filter(F.col("split") == "test")
    b = binned_curve(t, "y", "prediction", dx=100.0)
    return b.select("bin", "bin_center", "n", F.round("mean_prediction", 6).alias("mean_prediction"))


def q_listing_links(spark, sf_dir):
    return extract_links(fx.table(spark, sf_dir, "pages"), suffix=".gz")


def q_stage_counts(spark, sf_dir):
    d = fx.dvf(spark, sf_dir)
    c = clean(d, **JOB_CLEANER)
    r = rollup_mutations(c)
    f = create_features(c, *JOB_PRICE_BAND)
    parts = [(n, x) for n, x in (("lines", d), ("cleaned", c), ("mutations", r), ("priced", f))]
    out = None
    for name, x in parts:
        one = x.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("stage"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


QUERIES.update({
    "region_sales": q_region_sales,
    "hash_split": q_hash_split,
    "kfold_assign": q_kfold_assign,
    "exact_batches": q_exact_batches,
    "sample_rows": q_sample_rows,
    "category_list": q_category_list,
    "column_modes": q_column_modes,
    "quartiles": q_quartiles,
    "robust_scaled": q_robust_scaled,
    "onehot_type": q_onehot_type,
    "baseline_metrics": q_baseline_metrics,
    "binned_curve": q_binned_curve,
    "listing_links": q_listing_links,
    "stage_counts": q_stage_counts,
})
ORACLES.update({
    "region_sales": O.REGION_SALES,
    "hash_split": O.HASH_SPLIT,
    "kfold_assign": O.KFOLD,
    "exact_batches": O.EXACT_BATCHES,
    "sample_rows": O.SAMPLE_ROWS,
    "category_list": O.CATEGORY_LIST,
    "column_modes": O.COLUMN_MODES,
    "quartiles": O.QUARTILES,
    "robust_scaled": O.ROBUST_SCALED,
    "onehot_type": O.ONEHOT_TYPE,
    "baseline_metrics": O.BASELINE_METRICS,
    "binned_curve": O.BINNED_CURVE,
    "listing_links": O.LISTING_LINKS,
    "stage_counts": O.STAGE_COUNTS,
})


# ---------------------------------------------------------------------------
# Anomaly filter and the end-to-end preprocessing job (model-dependent:
# checked by properties in tests/, rows-only here)
# ---------------------------------------------------------------------------
from parcelle.operators.anomaly import IsolationForest  # noqa: E402
from parcelle.plans.preprocess import fixture_lines, preprocess  # noqa: E402
from parcelle.schemas import ANOMALY_COLUMNS  # noqa: E402

SEQ_COLS = ("seq1", "seq2", "seq3")


def q_anomaly_scores(spark, sf_dir):
    """Isolation-forest score of every priced sale, one forest per region × year."""
    c = with_region(fixture_lines(_cleaned(spark, sf_dir)))
    f = create_features(c, *JOB_PRICE_BAND, partition_cols=("region", "file_year")).checkpoint()
    k = knn_idw(f, fx.grid(spark, sf_dir)).checkpoint()
    m = IsolationForest(ANOMALY_COLUMNS + ["prix_m2"], ("region", "file_year"),
                        ("id_mutation", "valeur_fonciere")).fit(k)
    return m.score(k).select("region", "file_year", "id_mutation", "valeur_fonciere", "score_samples")


def q_preprocess_pipeline(spark, sf_dir):
    """Whole preprocessing job on the fixture (price-per-m² target)."""
    lines = fixture_lines(fx.dvf(spark, sf_dir))
    return preprocess(lines, fx.grid(spark, sf_dir), target="prix_m2", order_cols=SEQ_COLS)


QUERIES.update({
    "anomaly_scores": q_anomaly_scores,
    "preprocess_pipeline": q_preprocess_pipeline,
})


# ---------------------------------------------------------------------------
# Models (fitted: rows-only checks here, properties in tests/)
# ---------------------------------------------------------------------------
from parcelle.models import combined as cm  # noqa: E402
from parcelle.models.regressors import GAM, BoostedTrees, ElasticNet  # noqa: E402
from parcelle.plans import train as tr  # noqa: E402

_MEMO: dict = {}


def _memo(spark, key, build):
    """Reuse a checkpointed intermediate within one session (several queries
    share the preprocessed table and the fitted job models)."""
    k = (spark.sparkContext.applicationId, *key)
    if k not in _MEMO:
        _MEMO[k] = build()
    return _MEMO[k]


def _preprocessed(spark, sf_dir, target="prix_m2"):
    def build():
        lines = fixture_lines(fx.dvf(spark, sf_dir))
        return preprocess(lines, fx.grid(spark, sf_dir), target=target, order_cols=SEQ_COLS).checkpoint()
    return _memo(spark, ("pre", sf_dir, target), build)


def _encoded(spark, sf_dir):
    return _memo(spark, ("enc", sf_dir), lambda: tr.split_encode(_preprocessed(spark, sf_dir), "prix_m2"))


def _phys():
    p = tr.PHYSICAL_PARAMS
    return ElasticNet(p["alpha"], p["l1_ratio"], p["max_iter"], p["tol"], p["fit_intercept"])


def _ctx():
    return BoostedTrees(tr.CONTEXTUAL_PARAMS, drop_unsupported=True)


def _test_predictions(spark, sf_dir, model, features_col):
    _, data = _encoded(spark, sf_dir)
    te = data.filter(F.col("split") == "test")
    return (cm._predict(model, te, features_col, "prediction")
            .select("id_mutation", F.col("label").alias("y"), "prediction"))


def q_elastic_net_predictions(spark, sf_dir):
    """Physical block, elastic net (α .5, ρ .5): test-split predictions."""
    _, data = _encoded(spark, sf_dir)
    m = cm._fit(_phys, data.filter(F.col("split") == "train"), "x_phys", "label")
    return _test_predictions(spark, sf_dir, m, "x_phys")


def _ctx_model(spark, sf_dir):
    def build():
        _, data = _encoded(spark, sf_dir)
        return cm._fit(_ctx, data.filter(F.col("split") == "train"), "x_ctx", "label")
    return _memo(spark, ("ctx", sf_dir), build)


def q_gbt_predictions(spark, sf_dir):
    """Contextual block, boosted trees (200 × depth 8): test-split predictions."""
    return _test_predictions(spark, sf_dir, _ctx_model(spark, sf_dir), "x_ctx")


def q_gam_predictions(spark, sf_dir):
    """Combined GAM variant: one P-spline GAM per block (λ .5 / .3), weighted 0.5."""
    _, data = _encoded(spark, sf_dir)
    model = cm.Combined(lambda: GAM(lam=0.5), lambda: GAM(lam=0.3)).fit(
        data.filter(F.col("split") == "train"))
    return (model.transform(data.filter(F.col("split") == "test"))
            .select("id_mutation", F.col("label").alias("y"), "prediction"))


def q_combined_weighted(spark, sf_dir):
    """Weighted combination 0.5·physical + 0.5·contextual: test predictions."""
    _, data = _encoded(spark, sf_dir)
    phys = cm._fit(_phys, data.filter(F.col("split") == "train"), "x_phys", "label")
    model = cm.CombinedModel(phys, _ctx_model(spark, sf_dir), 0.5)
    return (model.transform(data.filter(F.col("split") == "test"))
            .select("id_mutation", F.col("label").alias("y"), "p_phys", "p_ctx", "prediction"))


def _stacked(spark, sf_dir):
    def build():
        _, data = _encoded(spark, sf_dir)
        model = cm.Combined(_phys, _ctx, lambda: ElasticNet(1.0, 0.5, 1000, 1e-6, False),
                            stacking=True).fit(data.filter(F.col("split") == "train"))
        pred = (model.transform(data)
                .select("split", "id_mutation", F.col("label").alias("y"), "prediction").checkpoint())
        return model, pred
    return _memo(spark, ("stacked", sf_dir), build)


def q_stacked_metrics(spark, sf_dir):
    """Stacked combined model (job 2): MSE and R² per split."""
    _, pred = _stacked(spark, sf_dir)
    return regression_metrics(pred, by=["split"])


def q_stacked_calibration(spark, sf_dir):
    """Mean prediction per 100-wide bin of the true price per m² (test split)."""
    _, pred = _stacked(spark, sf_dir)
    return binned_curve(pred.filter(F.col("split") == "test"), dx=100.0)


def q_shap_group_impact(spark, sf_dir):
    """Shapley shares of the physical and contextual blocks (250-row sample, its own background)."""
    model, _ = _stacked(spark, sf_dir)
    enc, data = _encoded(spark, sf_dir)
    test = data.filter(F.col("split") == "test")
    n_phys, _ = enc.widths()
    sample = sp.sample_k(test, ["id_mutation"], 250, seed="shap").withColumn("_sid", F.col("id_mutation"))
    phi = tr.block_shapley(model, test, sample, n_phys)
    per = phi.withColumn("group", F.when(F.col("feature") < n_phys, "physical").otherwise("contextual"))
    from parcelle.operators.evaluate import group_share
    return group_share(per.withColumnRenamed("_sid", "row"), feature="feature", phi="phi",
                       groups=None).select("group", "impact", "share_pct")


def q_weight_sweep(spark, sf_dir):
    """3-fold out-of-fold MSE of every combination weight (no refit per weight)."""
    _, data = _encoded(spark, sf_dir)
    oof = cm.oof_base_predictions(data.filter(F.col("split") == "train"), _phys, _ctx, 3)
    return cm.weight_sweep(oof, [0.1, 0.3, 0.5, 0.7, 0.9])


def q_batch_boost_metrics(spark, sf_dir):
    """Job 1: price model, trees added per 100,000-row batch (10 rounds each)."""
    pre = _preprocessed(spark, sf_dir, "valeur_fonciere")
    _, pred, metrics, _ = tr.train_batch_boost_job(pre)
    return metrics


QUERIES.update({
    "elastic_net_predictions": q_elastic_net_predictions,
    "gbt_predictions": q_gbt_predictions,
    "gam_predictions": q_gam_predictions,
    "combined_weighted": q_combined_weighted,
    "stacked_metrics": q_stacked_metrics,
    "stacked_calibration": q_stacked_calibration,
    "shap_group_impact": q_shap_group_impact,
    "weight_sweep": q_weight_sweep,
    "batch_boost_metrics": q_batch_boost_metrics,
})


# ---------------------------------------------------------------------------
# Resume (anti-join) and incremental landing (Structured Streaming)
# ---------------------------------------------------------------------------
from parcelle.operators.resume import enrich_in_chunks, resume  # noqa: E402
from parcelle.session import scratch_path  # noqa: E402
from parcelle.streaming.landing import ingest_available, raw_csv_schema, read_landed  # noqa: E402


def q_radius_resume(spark, sf_dir):
    """Resume the grid enrichment from a saved partial result (the western
    cells, written to the shared checkpoint folder): only the missing keys are
    computed, and the union equals a full run."""
    grid, poi = fx.grid(spark, sf_dir), fx.poi(spark, sf_dir)
    path = scratch_path(spark, "radius-partial")
    radius_poi_counts(grid.filter(F.col("lon") < 2.5), poi, FIXTURE_RADIUS).write.parquet(path)
    done = spark.read.parquet(path)
    keys = ["lat", "lon", "densite"]
    return resume(grid.select("grid_id", *keys), done, keys,
                  lambda rest: radius_poi_counts(rest, poi, FIXTURE_RADIUS))


def q_radius_chunked(spark, sf_dir):
    """Grid enrichment saved chunk by chunk: the western cells first, then the whole grid, of which only the new keys are
    dealt out and computed."""
    poi, keys, path = fx.poi(spark, sf_dir), ["lat", "lon", "densite"], scratch_path(spark, "radius-chunks")
    grid = fx.grid(spark, sf_dir).select("grid_id", *keys)
    for part in (grid.filter(F.col("lon") < 2.5), grid):
        out = enrich_in_chunks(part, keys, lambda rest: radius_poi_counts(rest, poi, FIXTURE_RADIUS), path, chunks=4)
    return out


def q_landing_ingest(spark, sf_dir):
    """Land the sale lines as gzip CSV files per year and department, ingest
    them with a file stream (availableNow), run it again (nothing new), and
    return the ingested table."""
    lines = fx.dvf(spark, sf_dir).withColumn("y", F.year("date_mutation"))
    cols = [n for n, _ in TRANSACTION_COLUMNS]
    land = scratch_path(spark, "landing")
    (lines.select(*[F.col(c).cast("string") for c in cols], "y", "departement")
     .write.option("header", True).option("compression", "gzip")
     .partitionBy("y", "departement").csv(land))
    table, ckpt = scratch_path(spark, "landed"), scratch_path(spark, "landing-ckpt")
    pat = dict(year_pattern=r"/y=([0-9]{4})/", dep_pattern=r"/departement=([^/]+)/")
    ingest_available(spark, land, table, ckpt, raw_csv_schema(), **pat)
    ingest_available(spark, land, table, ckpt, raw_csv_schema(), **pat)
    return read_landed(spark, table).select(*cols, "year", "departement")


from parcelle.schemas import PREPROCESSED_FLOAT_COLUMNS, TRANSACTION_COLUMNS  # noqa: E402

QUERIES.update({
    "radius_resume": q_radius_resume,
    "radius_chunked": q_radius_chunked,
    "landing_ingest": q_landing_ingest,
})
ORACLES.update({
    "radius_resume": O.radius_counts_sql(),
    "radius_chunked": O.radius_counts_sql(),
})


# ---------------------------------------------------------------------------
# Imputer, row sample, evaluation pairs/bounds, weight sweep on exact bases
# ---------------------------------------------------------------------------
from parcelle.operators.evaluate import bounds  # noqa: E402


def q_mode_imputed(spark, sf_dir):
    """Mode imputer (numeric and string) fitted and applied on cleaned lines."""
    c = _cleaned(spark, sf_dir)
    m = enc.ModeImputer(["nombre_pieces_principales", "type_local"]).fit(c)
    return m.transform(c).select("id_mutation", "seq1", "seq2", "seq3",
                                 "nombre_pieces_principales", "type_local")


def q_hash_sample(spark, sf_dir):
    """Deterministic 10 % row sample of the sale lines."""
    d = fx.dvf(spark, sf_dir)
    return sp.hash_sample(d, ["id_mutation", "seq1", "seq2", "seq3"], 0.1, seed="sample") \
        .select("id_mutation", "seq1", "seq2", "seq3")


def q_truth_prediction(spark, sf_dir):
    """Truth / prediction pairs of the test split (scatter data)."""
    p = _baseline_predictions(spark, sf_dir).filter(F.col("split") == "test")
    return p.select("split", "y", F.round("prediction", 6).alias("prediction"))


def q_prediction_bounds(spark, sf_dir):
    b = bounds(_baseline_predictions(spark, sf_dir), ["y", "prediction"], by=["split"])
    return b.select("split", "min_y", "max_y", F.round("min_prediction", 6).alias("min_prediction"),
                    F.round("max_prediction", 6).alias("max_prediction"))


def q_weight_sweep_baseline(spark, sf_dir):
    """Weight axis of the search on two exact base predictors (mean by type,
    mean by year): every weight scored in one aggregate."""
    s = _split_features(spark, sf_dir)
    train = s.filter(F.col("split") == "train")
    p = GroupMeanRegressor(["type_local"], "prix_m2").fit(train)
    c = GroupMeanRegressor(["year"], "prix_m2").fit(train)
    test = s.filter(F.col("split") == "test")
    both = c.transform(p.transform(test).withColumnRenamed("prediction", "p_phys")) \
        .withColumnRenamed("prediction", "p_ctx").withColumnRenamed("prix_m2", "label")
    sw = cm.weight_sweep(both, [0.1, 0.3, 0.5, 0.7, 0.9])
    return sw.select("weight", F.round("mse", 2).alias("mse"))


QUERIES.update({
    "mode_imputed": q_mode_imputed,
    "hash_sample": q_hash_sample,
    "truth_prediction": q_truth_prediction,
    "prediction_bounds": q_prediction_bounds,
    "weight_sweep_baseline": q_weight_sweep_baseline,
})
ORACLES.update({
    "mode_imputed": O.MODE_IMPUTED,
    "hash_sample": O.HASH_SAMPLE,
    "truth_prediction": O.TRUTH_PREDICTION,
    "prediction_bounds": O.PREDICTION_BOUNDS,
    "weight_sweep_baseline": O.WEIGHT_SWEEP_BASELINE,
})


# ---------------------------------------------------------------------------
# Grid and raster CSV scans (the grid is written by Spark, then re-read)
# ---------------------------------------------------------------------------
from parcelle.sources.grid import read_grid, read_raster  # noqa: E402
from parcelle.sources.sinks import write_csv  # noqa: E402


def q_grid_csv_scan(spark, sf_dir):
    """Enriched-grid CSV written with a header and re-read with the fixed grid
    schema (no inference pass)."""
    path = scratch_path(spark, "grid-csv")
    write_csv(fx.grid(spark, sf_dir).drop("grid_id"), path)
    return read_grid(spark, path)


def q_raster_scan(spark, sf_dir):
    """Population raster X, Y, Z read and renamed to lon, lat, densite."""
    path = scratch_path(spark, "raster-csv")
    g = fx.grid(spark, sf_dir)
    write_csv(g.select(F.col("lon").alias("X"), F.col("lat").alias("Y"), F.col("densite").alias("Z")), path)
    return read_raster(spark, path)


QUERIES.update({"grid_csv_scan": q_grid_csv_scan, "raster_scan": q_raster_scan})
ORACLES.update({
    "grid_csv_scan": O.duckdb_with("grid") + "SELECT lon, lat, densite, transport_pois, education_pois, "
    "health_pois, food_pois, shopping_pois, park_pois, entertainment_pois, cultural_pois FROM grid",
    "raster_scan": O.duckdb_with("grid") + "SELECT lon, lat, densite FROM grid",
})


# ---------------------------------------------------------------------------
# Transaction CSV scan (S-1..S-5), partitioned sink + re-scan (S-11, S-12),
# metrics per region and split (V-3)
# ---------------------------------------------------------------------------
from parcelle.sources.sinks import read_preprocessed, write_partitioned  # noqa: E402
from parcelle.sources.transactions import (  # noqa: E402
    read_transactions, read_transactions_parquet, write_transactions_csv, write_transactions_parquet,
)

# Source column order differs from ours and carries columns we do not use:
# the scan must pick columns by header name, never by position.
_LANDED_ORDER = ["valeur_fonciere", "id_mutation", "seq1", "latitude", "longitude",
                 *[n for n, _ in TRANSACTION_COLUMNS
                   if n not in ("valeur_fonciere", "id_mutation", "latitude", "longitude")],
                 "seq2", "seq3"]


def q_transactions_scan(spark, sf_dir):
    """Sale lines landed as gzip CSV per (year, departement), then scanned
    back over every year × department: full-width header read, ``try_cast``
    to the source types, year and department taken from the file path."""
    path = scratch_path(spark, "transactions-csv")
    lines = fx.dvf(spark, sf_dir).withColumn("year", F.year("date_mutation"))
    write_transactions_csv(lines.select(*_LANDED_ORDER, "year", "departement"), path)
    t = read_transactions(spark, path, layout="partitioned")
    return t.select(*[n for n, _ in TRANSACTION_COLUMNS], "year", "departement")


def q_transactions_parquet(spark, sf_dir):
    """The scanned CSV lines rewritten once to parquet partitioned by
    (year, departement), then read back with the stored schema."""
    path = scratch_path(spark, "transactions-parquet")
    write_transactions_parquet(q_transactions_scan(spark, sf_dir), path)
    return read_transactions_parquet(spark, path).select(
        *[n for n, _ in TRANSACTION_COLUMNS], "year", "departement")


_STORED = ["id_mutation", "type_local", *FEATURE_DOUBLES[1:], "total_surface_carrez", "prix_m2"]


def _region_features(spark, sf_dir):
    c = with_region(_cleaned(spark, sf_dir))
    return create_features(c, *JOB_PRICE_BAND, partition_cols=("region",))


def q_preprocessed_rescan(spark, sf_dir):
    """Priced sales written partitioned by (region, year) with dynamic
    overwrite, one region re-written (replaces only its partitions), then
    re-scanned with the stored types and rows with a null dropped."""
    # written twice and probed once: materialise the roll-up a single time
    f = _region_features(spark, sf_dir).select("region", "year", *_STORED).checkpoint()
    path = scratch_path(spark, "preprocessed")
    write_partitioned(f, path, ("region", "year"))
    first = f.agg(F.min("region")).first()[0]
    if first is not None:
        write_partitioned(f.filter(F.col("region") == first), path, ("region", "year"))
    return read_preprocessed(spark, path).select("region", "year", *_STORED)


def q_region_metrics(spark, sf_dir):
    """One metrics row per region and split: a per-region model (mean price
    per m² by region and type) scored on its train and test rows."""
    s = sp.hash_split(_region_features(spark, sf_dir), KEY, 0.8)
    model = GroupMeanRegressor(["region", "type_local"], "prix_m2").fit(
        s.filter(F.col("split") == "train"))
    p = model.transform(s).select("region", "split", F.col("prix_m2").alias("y"), "prediction")
    m = regression_metrics(p, by=["region", "split"])
    return m.select("region", "split", "n", F.round("mse", 2).alias("mse"),
                    F.round("r2", 8).alias("r2"))


def _scan_cols() -> str:
    sql_type = {"string": None, "date": None, "float": "FLOAT", "double": "DOUBLE"}
    return ", ".join(O._typed_line(n, sql_type[t.simpleString()]) for n, t in TRANSACTION_COLUMNS)


def _stored_cols() -> str:
    out = []
    for c in ["region", "year", *_STORED]:
        if c in PREPROCESSED_FLOAT_COLUMNS:
            out.append(f"CAST({c} AS FLOAT) AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


QUERIES.update({
    "transactions_scan": q_transactions_scan,
    "transactions_parquet": q_transactions_parquet,
    "preprocessed_rescan": q_preprocessed_rescan,
    "region_metrics": q_region_metrics,
})
ORACLES.update({
    "transactions_scan": O.TRANSACTIONS_SCAN.format(cols=_scan_cols()),
    "transactions_parquet": O.TRANSACTIONS_SCAN.format(cols=_scan_cols()),
    "landing_ingest": O.TRANSACTIONS_SCAN.format(cols=_scan_cols()),
    "preprocessed_rescan": O.PREPROCESSED_RESCAN.format(
        cols=_stored_cols(),
        not_null=" AND ".join(f"{c} IS NOT NULL" for c in ["region", "year", *_STORED])),
    "region_metrics": O.REGION_METRICS,
})


# ---------------------------------------------------------------------------
# Global conditional count around one point (A-7); attribution shares per
# region on exact Shapley values of an additive model (A-16, V-4)
# ---------------------------------------------------------------------------
from parcelle.operators.evaluate import group_share  # noqa: E402
from parcelle.operators.spatial import poi_counts_around  # noqa: E402

AROUND_POINT = (2.5, 47.0, 50000.0)      # query parameters: lon, lat, radius (Mercator m)


def q_poi_counts_around(spark, sf_dir):
    """POI counts by category within 50 km of one point (one row always)."""
    lon, lat, r = AROUND_POINT
    return poi_counts_around(fx.poi(spark, sf_dir), lon, lat, r)


def q_shap_share_baseline(spark, sf_dir):
    """Per region, the share of mean |φ| carried by the physical (type) and
    contextual (year) parts of 0.5·type mean + 0.5·year mean.  The model is
    additive, so with the training rows as background the Shapley values are
    exact: φ = 0.5·(part prediction − its training mean), and the training
    mean of a group-mean prediction is the overall training mean."""
    s = sp.hash_split(_region_features(spark, sf_dir), KEY, 0.8)
    train = s.filter(F.col("split") == "train")
    p = GroupMeanRegressor(["type_local"], "prix_m2").fit(train)
    c = GroupMeanRegressor(["year"], "prix_m2").fit(train)
    test = s.filter(F.col("split") == "test")
    both = c.transform(p.transform(test).withColumnRenamed("prediction", "p_phys")) \
        .withColumnRenamed("prediction", "p_ctx")
    base = F.lit(p.overall)
    parts = F.array(
        F.struct(F.lit("physical").alias("feature"), (F.lit(0.5) * (F.col("p_phys") - base)).alias("phi")),
        F.struct(F.lit("contextual").alias("feature"), (F.lit(0.5) * (F.col("p_ctx") - base)).alias("phi")))
    attr = both.select("region", F.explode(parts).alias("_a")).select("region", "_a.feature", "_a.phi")
    out = group_share(attr, groups={"physical": "physical", "contextual": "contextual"}, by=["region"])
    return out.select("region", "group", F.round("impact", 6).alias("impact"),
                      F.round("share_pct", 6).alias("share_pct"))


QUERIES.update({
    "poi_counts_around": q_poi_counts_around,
    "shap_share_baseline": q_shap_share_baseline,
})
ORACLES.update({
    "poi_counts_around": O.poi_around_sql(*AROUND_POINT),
    "shap_share_baseline": O.SHAP_SHARE_BASELINE,
})


# ---------------------------------------------------------------------------
# Two-block column transformer (E-4, E-5), blocks as columns of one row
# (J-7), the combined vector sliced back into its blocks (M-10)
# ---------------------------------------------------------------------------
from pyspark.ml.feature import VectorAssembler  # noqa: E402
from pyspark.ml.functions import vector_to_array  # noqa: E402

from parcelle.schemas import CATEGORICAL_PHYSICAL  # noqa: E402

BLOCK_CONTEXT = ["longitude", "latitude"]


def q_encoded_blocks(spark, sf_dir):
    """Physical block (imputer → one-hot type, imputer → robust scaler) and
    contextual block (imputer → robust scaler on the coordinates), fitted on
    the train split, applied to the test split, assembled side by side into
    one vector and sliced back: one row per (sale, block, position)."""
    # the encoders make several passes (modes, categories, quartiles) over
    # the train rows: cut the lineage once instead of re-running the roll-up
    s = _split_features(spark, sf_dir).checkpoint()
    train, test = s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")
    phys = enc.BlockEncoder(CATEGORICAL_PHYSICAL, NUMERIC_PHYSICAL, None, "x_phys").fit(train)
    ctx = enc.BlockEncoder((), BLOCK_CONTEXT, None, "x_ctx").fit(train)
    both = VectorAssembler(inputCols=["x_phys", "x_ctx"], outputCol="x_all").transform(
        ctx.transform(phys.transform(test)))
    n_phys = len(phys.feature_names())
    return (both.select("id_mutation", "valeur_fonciere",
                        F.posexplode(vector_to_array("x_all")).alias("pos", "col"))
            .select("id_mutation", "valeur_fonciere",
                    F.when(F.col("pos") < n_phys, "physical").otherwise("contextual").alias("block"),
                    F.when(F.col("pos") < n_phys, F.col("pos"))
                    .otherwise(F.col("pos") - n_phys).cast("int").alias("pos"),
                    F.round("col", 6).alias("value")))


QUERIES["encoded_blocks"] = q_encoded_blocks
ORACLES["encoded_blocks"] = O.encoded_blocks_sql(NUMERIC_PHYSICAL, BLOCK_CONTEXT)


# ---------------------------------------------------------------------------
# Fitted models with an answer SQL can state (M-1..M-6, M-11), on all priced sales
# ---------------------------------------------------------------------------
from parcelle.models.regressors import BatchBoost  # noqa: E402

ROOMS, LAND = "double(nombre_pieces_principales)", "double(surface_terrain)"
MANY_ROOMS, HAS_LAND = f"double({ROOMS} >= 3)", f"double({LAND} > 0)"


def _vectors(spark, sf_dir, phys, ctx, label="double(prix_m2)"):
    f = _features(spark, sf_dir).select("id_mutation", "valeur_fonciere", "year", F.expr(label).alias("label"),
                                        F.expr(phys).alias("a"), F.expr(ctx).alias("b"))
    for cols, out in ((["a"], "x_phys"), (["b"], "x_ctx"), (["a", "b"], "x_all")):
        f = VectorAssembler(inputCols=cols, outputCol=out).transform(f)
    return f.checkpoint()


def _stump():
    return BoostedTrees({"n_estimators": 1, "learning_rate": 1.0, "max_depth": 1})


def q_weighted_group_means(spark, sf_dir):
    """One-split trees on a 0/1 column predict group means; 0.3·physical + 0.7·contextual (M-2, M-3, M-6)."""
    rows = _vectors(spark, sf_dir, MANY_ROOMS, HAS_LAND)
    out = cm.Combined(_stump, _stump, weight=0.3).fit(rows).transform(rows)
    return out.select("id_mutation", "valeur_fonciere", *rnd("p_phys", "p_ctx", "prediction", d=4))


def q_batch_boost_means(spark, sf_dir):
    """One full-rate split per yearly batch: the last year's group means remain (M-4)."""
    rows = _vectors(spark, sf_dir, MANY_ROOMS, HAS_LAND)
    model = BatchBoost(1, 1.0, 1, 1.0, 1, features_col="x_phys", batch_col="year").fit(rows)
    return model.transform(rows).select("id_mutation", "valeur_fonciere", *rnd("prediction", d=4))


def q_gam_line(spark, sf_dir):
    """A linear target has no second differences to penalise, so the splines return it (M-5)."""
    rows = _vectors(spark, sf_dir, ROOMS, LAND, f"2 * {ROOMS} + 3")
    model = GAM(lam=0.5, features_col="x_phys").fit(rows)
    return model.transform(rows).select("id_mutation", "valeur_fonciere", *rnd("prediction", d=3))


def q_elastic_net_line(spark, sf_dir):
    """One feature: the soft-thresholded covariance over the ridged variance (M-1)."""
    rows = _vectors(spark, sf_dir, ROOMS, LAND)
    m = ElasticNet(0.5, 0.5, 1000, 1e-10, True, features_col="x_phys").fit(rows)
    return rows.agg(F.count(F.lit(1)).alias("n")).select(
        "n", F.round(F.lit(float(m.coefficients[0])), 3).alias("slope"), F.round(F.lit(float(m.intercept)), 2).alias("intercept"))


def q_linear_shapley(spark, sf_dir):
    """Closed-form Shapley values of two weighted straight lines against all sales (M-11)."""
    rows = _vectors(spark, sf_dir, ROOMS, LAND)

    def line():
        return ElasticNet(0.0, 0.0)
    model = cm.Combined(line, line, weight=0.3).fit(rows)
    w, _ = cm.additive_parts(model, 1, 2)
    return (cm.linear_shapley(w, rows, rows.agg(F.avg("a"), F.avg("b")).first(), ["id_mutation", "valeur_fonciere"])
            .select("id_mutation", "valeur_fonciere", "feature", *rnd("phi", d=3)))


QUERIES.update({
    "weighted_group_means": q_weighted_group_means,
    "batch_boost_means": q_batch_boost_means,
    "gam_line": q_gam_line,
    "elastic_net_line": q_elastic_net_line,
    "linear_shapley": q_linear_shapley,
})
ORACLES.update({
    "weighted_group_means": O.WEIGHTED_GROUP_MEANS,
    "batch_boost_means": O.BATCH_BOOST_MEANS,
    "gam_line": O.GAM_LINE,
    "elastic_net_line": O.ELASTIC_NET_LINE,
    "linear_shapley": O.LINEAR_SHAPLEY,
})


# ---------------------------------------------------------------------------
# Regularised boosting, batches, grid search, exact tree Shapley values (M-2, M-4, M-9, M-11)
# ---------------------------------------------------------------------------
from parcelle.models import histtrees, search, treeshap  # noqa: E402

FEW_ROOMS = f"least({ROOMS}, 6e0)"
#: Regularisation of the one-tree query: every term changes its splits or leaves.
TREE_PARAMS = {"n_estimators": 1, "learning_rate": 0.5, "max_depth": 2, "lambda": 40, "alpha": 5000, "gamma": 2e6, "min_child_weight": 30}


def q_boosted_tree_splits(spark, sf_dir):
    """One regularised tree of depth 2 on the rooms: splits and leaves by gain, lambda, alpha, gamma and child weight (M-2)."""
    rows = _vectors(spark, sf_dir, FEW_ROOMS, HAS_LAND)
    model = histtrees.HistBoost(TREE_PARAMS, "x_phys").fit(rows)
    return model.transform(rows).select("id_mutation", "valeur_fonciere", *rnd("prediction", d=4))


def q_batch_boost_shrunk(spark, sf_dir):
    """One split per yearly batch, leaves shrunk by lambda: each year moves both groups' answers on (M-4)."""
    rows = _vectors(spark, sf_dir, MANY_ROOMS, HAS_LAND)
    model = histtrees.fit_batches(rows, histtrees.Boosting(1, 1.0, 1, reg_lambda=25.0), "year", "x_phys")
    return model.transform(rows).select("id_mutation", "valeur_fonciere", *rnd("prediction", d=4))


def q_grid_search_points(spark, sf_dir):
    """All points of a grid of both blocks and the weight: cross-validated error and rank, folds by year (M-9)."""
    rows = _vectors(spark, sf_dir, MANY_ROOMS, HAS_LAND)
    fixed = {"max_depth": 1, "lambda": 0}
    out = search.grid_search(rows, {"physical": {"n_estimators": [1, 2], "learning_rate": [0.3, 0.6]}, "contextual": {"n_estimators": [1], "learning_rate": [0.5, 0.9]}},
                             [0.3, 0.7], {"physical": fixed, "contextual": fixed}, fold=F.col("year") % 3, refit=False)
    return out.scores.select("physical_weight", "physical_n_estimators", "physical_learning_rate", "contextual_learning_rate", *rnd("mse", d=2), "rank")


def q_tree_shapley_groups(spark, sf_dir):
    """Exact Shapley values of a fitted depth-2 tree on two 0/1 columns, against all sales (M-11)."""
    rows = _vectors(spark, sf_dir, MANY_ROOMS, HAS_LAND)
    model = histtrees.HistBoost({"n_estimators": 1, "learning_rate": 1.0, "max_depth": 2, "lambda": 0}, "x_all").fit(rows)
    background, counts = treeshap.distinct_vectors(rows, "x_all")
    phi = treeshap.tree_shapley(treeshap.parts_of(model), rows, background, ["id_mutation", "valeur_fonciere"], "x_all", counts=counts)
    return phi.select("id_mutation", "valeur_fonciere", "feature", *rnd("phi", d=3))


QUERIES.update({
    "boosted_tree_splits": q_boosted_tree_splits,
    "batch_boost_shrunk": q_batch_boost_shrunk,
    "grid_search_points": q_grid_search_points,
    "tree_shapley_groups": q_tree_shapley_groups,
})
ORACLES.update({
    "boosted_tree_splits": O.boosted_tree_sql(TREE_PARAMS),
    "batch_boost_shrunk": O.BATCH_BOOST_SHRUNK,
    "grid_search_points": O.GRID_SEARCH_POINTS,
    "tree_shapley_groups": O.TREE_SHAPLEY_GROUPS,
})


# ---------------------------------------------------------------------------
# Nested POI responses (J-6, map lookup, flattening)
# ---------------------------------------------------------------------------
from parcelle.sources import poi_json  # noqa: E402

RESPONSE_KEYS = "cell_lon bigint, cell_lat bigint, page bigint"


def _poi_responses(spark, sf_dir):
    """The POI view as JSON responses by degree cell, at most 50 consecutive ids each; every seventh point is an
    area (its place in ``center``), and each page 0 stands beside a response without elements."""
    path = scratch_path(spark, "poi-json")
    area = F.col("poi_id") % 7 == 0
    tags = F.map_filter(F.create_map(*[x for t in poi_json.POINT_TAGS for x in (F.lit(t), F.col(t))]), lambda k, v: v.isNotNull())
    element = F.struct(F.when(area, "way").otherwise("node").alias("type"), F.col("poi_id").alias("id"), F.when(~area, F.col("lat")).alias("lat"), F.when(~area, F.col("lon")).alias("lon"),
                       F.when(area, F.struct("lat", "lon")).alias("center"), F.when(F.size(tags) > 0, tags).alias("tags"))
    full = (fx.poi(spark, sf_dir).groupBy(F.floor("lon").alias("cell_lon"), F.floor("lat").alias("cell_lat"), F.floor(F.col("poi_id") / 50).alias("page"))
            .agg(F.collect_list(element).alias("elements")))
    empty = full.filter("page = 0").select("cell_lon", (F.col("cell_lat") + 100).alias("cell_lat"), "page")
    full.unionByName(empty, allowMissingColumns=True).write.json(path)
    return poi_json.read_responses(spark, path, RESPONSE_KEYS)


def q_poi_json_counts(spark, sf_dir):
    """First-match category counts of the elements of JSON responses, per degree cell."""
    return poi_json.exclusive_counts(poi_json.elements_of(_poi_responses(spark, sf_dir)), ["cell_lon", "cell_lat"])


def q_poi_json_points(spark, sf_dir):
    """JSON responses flattened to the point table of the radius joins."""
    return poi_json.poi_points(poi_json.elements_of(_poi_responses(spark, sf_dir)))


QUERIES.update({"poi_json_counts": q_poi_json_counts, "poi_json_points": q_poi_json_points})
ORACLES.update({
    "poi_json_counts": O.poi_json_counts_sql(),
    "poi_json_points": O.duckdb_with("poi") + "SELECT poi_id, lon, lat, amenity, shop, leisure, public_transport, tourism, name FROM poi",
})


# ---------------------------------------------------------------------------
# Thresholds by group (A-12) and one model per region (U-3, M-8, V-3, V-4, S-14)
# ---------------------------------------------------------------------------
from parcelle.operators.anomaly import threshold_filter  # noqa: E402


def q_anomaly_threshold(spark, sf_dir):
    """Sales kept by the contamination quantile of their (region, year, type): the forest's cut on a score that SQL can state."""
    s = (_region_features(spark, sf_dir).select("region", "year", "type_local", *KEY, "valeur_fonciere", (-F.abs(F.col("prix_m2") - 9000)).alias("score_samples"))
         .checkpoint())
    return threshold_filter(s, ["region", "year", "type_local"], JOB_CONTAMINATION).drop("score_samples").withColumn("threshold", F.round("threshold", 6))


def _region_train(spark, sf_dir):
    """Least squares of the price per m² on land and year, by region, saved and scored from the saved table."""
    f = _region_features(spark, sf_dir).select("region", "id_mutation", "prix_m2", "surface_terrain", "year")
    plain = dict(tr.PHYSICAL_PARAMS, alpha=0.0)
    return tr.train_regions_job(f, scratch_path(spark, "regions"), categorical=(), numeric=["surface_terrain", "year"], physical_params=plain)


def q_region_train_metrics(spark, sf_dir):
    """MSE and R² of each region's own model on its train and test rows."""
    m = _region_train(spark, sf_dir)[2]
    return m.select("region", "split", "n", F.round("mse", 2).alias("mse"), F.round("r2", 6).alias("r2"))


def q_region_train_impact(spark, sf_dir):
    """Physical and contextual share in each region's own model, over its test rows."""
    return _region_train(spark, sf_dir)[3].select("region", "group", *rnd("impact", "share_pct", d=4))


QUERIES.update({"anomaly_threshold": q_anomaly_threshold, "region_train_metrics": q_region_train_metrics, "region_train_impact": q_region_train_impact})
ORACLES.update({"anomaly_threshold": O.ANOMALY_THRESHOLD, "region_train_metrics": O.REGION_TRAIN_METRICS, "region_train_impact": O.REGION_TRAIN_IMPACT})


# ---------------------------------------------------------------------------
# Landing of wide files in any column order (S-15, S-4)
# ---------------------------------------------------------------------------
from parcelle.streaming.wide_landing import ingest_files, read_files_landed  # noqa: E402

WIDE_PATHS = dict(year_pattern=r"/y=([0-9]{4})/", dep_pattern=r"/departement=([^/]+)/")


def q_landing_wide(spark, sf_dir):
    """Sale lines landed as CSV files of 21 columns, in two column orders; a second run has nothing to add."""
    lines = fx.dvf(spark, sf_dir).withColumn("y", F.year("date_mutation"))
    used = [F.col(n).cast("string") for n, _ in TRANSACTION_COLUMNS]
    more = [F.lit(f"{i},\"x\"").alias(f"autre{i}") for i in range(6)]
    land, table, seen = scratch_path(spark, "wide"), scratch_path(spark, "wide-landed"), scratch_path(spark, "wide-seen")
    for half, cols in enumerate(([*used, *more], [*more[:3], *used[::-1], *more[3:]])):
        # dealt out as they are: text and constants are made behind the shuffle
        (lines.filter(F.pmod("y", F.lit(2)) == half).select(*[n for n, _ in TRANSACTION_COLUMNS], "y", "departement")
         .hint("rebalance", "y", "departement").select(*cols, "y", "departement").write.option("header", True).option("compression", "gzip")
         .option("escape", '"').partitionBy("y", "departement").csv(f"{land}/{half}"))
    first = ingest_files(spark, land, table, seen, **WIDE_PATHS)
    if again := ingest_files(spark, land, table, seen, **WIDE_PATHS):
        raise RuntimeError(f"{again} rows landed twice, {first} once")
    return read_files_landed(spark, table).select(*[n for n, _ in TRANSACTION_COLUMNS], "year", "departement")


QUERIES["landing_wide"] = q_landing_wide
ORACLES["landing_wide"] = O.TRANSACTIONS_SCAN.format(cols=_scan_cols())


# ---------------------------------------------------------------------------
# Rows after each stage, counted in one run (A-17)
# ---------------------------------------------------------------------------
from parcelle.operators.evaluate import stage_report  # noqa: E402
from parcelle.operators.features import price_band, price_per_m2  # noqa: E402


def q_stage_report(spark, sf_dir):
    """Lines, cleaned lines, sales and priced sales, observed while one job runs through."""
    return stage_report(fx.dvf(spark, sf_dir), [
        ("lines", None), ("cleaned", lambda d: clean(d, **JOB_CLEANER)), ("mutations", rollup_mutations),
        ("priced", lambda r: price_band(price_per_m2(r), *JOB_PRICE_BAND))])


QUERIES["stage_report"] = q_stage_report
ORACLES["stage_report"] = O.STAGE_COUNTS
