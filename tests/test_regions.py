"""Quantiles by group, forests dealt out in slices, one model per region."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelle.models import regional
from parcelle.operators import anomaly, encode


@pytest.fixture
def limit(spark):
    before = spark.conf.get("parcelle.broadcastLimitBytes", None)
    yield lambda n: spark.conf.set("parcelle.broadcastLimitBytes", str(n))
    spark.conf.unset("parcelle.broadcastLimitBytes") if before is None else spark.conf.set("parcelle.broadcastLimitBytes", before)


def groups_of(spark):
    rng = np.random.default_rng(4)
    data = {("a", 1): rng.integers(0, 9, (400, 2)).astype(float), ("a", None): rng.normal(size=(31, 2)), (None, 1): np.array([[5.0, 6.0]]), (None, None): rng.normal(size=(8, 2))}
    rows = [(k, g, float(x), float(y), None) for (k, g), v in data.items() for x, y in v] + [("a", 1, float("nan"), None, None), ("only nulls", 1, None, None, None)]
    return data, spark.createDataFrame(rows, "k string, g int, x double, y double, z double").repartition(5)


@pytest.mark.parametrize("accuracy,bytes_", [(10_000, 1 << 26), (1, 1 << 26), (20, 1)])
def test_quantiles_by_group_equal_numpy(spark, limit, accuracy, bytes_):
    data, df = groups_of(spark)
    limit(bytes_)
    got = {(r.k, r.g, r.feature, r.p): r.value for r in encode.wide_quantiles(df, ["k", "g"], ["x", "y", "z"], (0.1, 0.5, 1.0), accuracy).collect()}
    want = {(k, g, c, p): float(np.quantile(v[:, i], p)) for (k, g), v in data.items() for i, c in enumerate("xy") for p in (0.1, 0.5, 1.0)}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_bands_that_miss_are_searched_by_group(spark, monkeypatch):
    data, df = groups_of(spark)
    monkeypatch.setattr(encode.F, "percentile_approx", lambda c, qs, acc: F.array(*[F.max(c)] * len(qs)))
    got = {(r.k, r.g, r.feature): r.value for r in encode.wide_quantiles(df, ["k", "g"], ["x", "z", "y"], (0.25,)).collect()}
    assert got == {(k, g, c): pytest.approx(float(np.quantile(v[:, i], 0.25)), abs=1e-12) for (k, g), v in data.items() for i, c in enumerate("xy")}


def test_quantiles_of_nothing(spark):
    _, df = groups_of(spark)
    assert encode.wide_quantiles(df.limit(0), ["k"], ["x"]).count() == 0
    assert encode.wide_quantiles(df.limit(0), [], ["x"]).count() == 0 and encode.wide_quantiles(df, [], ["z"]).count() == 0


def test_only_values_in_a_band_become_rows(spark, monkeypatch):
    """The counting pass spreads a row to itself and its in-band values; no group statistic reaches the driver."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic
    collected, orig = [], Classic.collect
    monkeypatch.setattr(Classic, "collect", lambda self: collected.append(len(out := orig(self))) or out)
    df = spark.range(20_000).selectExpr("id % 500 as k", "cast(id as double) as x", "cast(id * 7 % 1000 as double) as y")
    seen, checkpoint = [], Classic.checkpoint
    monkeypatch.setattr(Classic, "checkpoint", lambda self, eager=True: seen.append(out := checkpoint(self, eager)) or out)
    q = encode.wide_quantiles(df, ["k"], ["x", "y"])
    assert max(collected, default=0) <= 1
    counted = seen[1]
    assert counted.filter("_i >= 0").count() <= 3 * 2 * 500 * 2 and counted.filter("_i = -1").count() == 500
    monkeypatch.undo()
    assert q.count() == 3 * 2 * 500


def test_slices_score_like_forests_in_every_task(spark, limit, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, "hot" if i % 3 else f"g{i % 7}", float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(900, 2)))] + [(1000, None, 1.0, 1.0), (1001, "one", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id long, g string, a double, b double").repartition(4)
    model = anomaly.IsolationForest(["a", "b"], ["g"], ["id"], n_trees=20).fit(df)
    near = {r.id: r.score_samples for r in model.score(df).collect()}
    limit(1)
    monkeypatch.setattr(anomaly, "SLICE_ROWS", 50)
    sliced = model.score(df)
    assert "FlatMapCoGroupsInPandas" in sliced._jdf.queryExecution().executedPlan().toString()
    far = {r.id: r.score_samples for r in sliced.collect()}
    assert far.keys() == near.keys() and len(far) == 902 and far[1000] is None and near[1000] is None
    assert all(far[i] == near[i] for i in far if i != 1000)


def test_packed_forest_gives_the_mean_path():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    forest = anomaly.grow_forest(np.vstack([x[:64], x[100:164]]), np.repeat([0, 1], 64), np.random.default_rng(1), 6)

    def walk(row):
        out = []
        for feat, thr, left, right, value in forest.values():
            at = 0
            while feat[at] >= 0:
                at = left[at] if row[feat[at]] <= thr[at] else right[at]
            out.append(value[at])
        return np.mean(out)

    assert np.allclose(anomaly.path_lengths(x, anomaly.packed(forest)), [walk(r) for r in x], rtol=1e-12)


def regions_of(spark, n=600):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(n):
        region = "hot" if i % 3 else ["p", "q"][i % 2]
        t, a, b = ["Flat", "House", None][i % 3 if i % 5 else 2], float(rng.integers(1, 9)), float(rng.normal())
        y = {"hot": 3.0, "p": -2.0, "q": 0.5}[region] * a + 4 * b + (7 if t == "House" else 0) + float(rng.normal(0, .1))
        rows.append((i, region, t, None if i % 11 == 0 else a, b, y))
    rows += [(9001, "p", "Flat", 1.0, 1.0, None), (9002, None, "Flat", 1.0, 1.0, 2.0), (9003, "single", "Barn", 2.0, 2.0, 5.0)]
    return rows, spark.createDataFrame(rows, "id long, region string, t string, a double, b double, y double").withColumn("_x", F.lit("own")).repartition(6)


def by_hand(rows, region, alpha, l1):
    """Encoder and elastic net of one region in plain NumPy: proximal gradient steps on the objective itself."""
    mine = [r for r in rows if r[1] == region and r[5] is not None]
    most = lambda vs: min(set(vs), key=lambda v: (-vs.count(v), v))
    mt, ma = most([r[2] for r in mine if r[2] is not None]), most([r[3] for r in mine if r[3] is not None])
    cats = sorted({r[2] for r in rows if r[1] is not None and r[2] is not None and r[5] is not None})
    raw = np.array([[ma if r[3] is None else r[3], r[4]] for r in mine])
    q1, q2, q3 = np.quantile(raw, [.25, .5, .75], axis=0)
    x = np.hstack([np.array([[float((r[2] or mt) == c) for c in cats] for r in mine]), (raw - q2) / np.where(q3 == q1, 1, q3 - q1)])
    y = np.array([r[5] for r in mine])
    xc, yc = x - x.mean(0), y - y.mean()
    step = 1 / (np.linalg.eigvalsh(xc.T @ xc / len(y)).max() + alpha * (1 - l1) + 1e-12)
    w = np.zeros(x.shape[1])
    for _ in range(20_000):
        v = w - step * (xc.T @ (xc @ w - yc) / len(y) + alpha * (1 - l1) * w)
        w = np.sign(v) * np.maximum(np.abs(v) - step * alpha * l1, 0)
    return {r[0]: y.mean() + (x[i] - x.mean(0)) @ w for i, r in enumerate(mine)}


def test_every_region_has_its_own_elastic_net(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(regional, "FAN_IN", 2)
    rows, df = regions_of(spark)
    model = regional.RegionalElasticNet(["t"], ["a", "b"], "y", alpha=0.2, l1_ratio=0.5).fit(df)
    model.save(str(tmp_path / "m"))
    scored = regional.RegionalModel.load(spark, str(tmp_path / "m")).transform(df)
    assert scored.columns == [*df.columns, "prediction"]
    got = {r.id: r.prediction for r in scored.collect()}
    assert len(got) == len(rows) and got[9002] is None and got[9001] is not None and got[9003] == pytest.approx(5.0)
    for region in ("hot", "p", "q"):
        want = by_hand(rows, region, 0.2, 0.5)
        assert want and all(got[i] == pytest.approx(v, abs=1e-5) for i, v in want.items())


def test_regions_are_learnt_alike_without_broadcast(spark, limit):
    rows, df = regions_of(spark, 200)
    fit = lambda: {r.id: r.prediction for r in regional.RegionalElasticNet(["t"], ["a", "b"], "y").fit(df).transform(df).collect()}
    want = fit()
    limit(1)
    got = fit()
    assert got.keys() == want.keys() and all(got[i] == want[i] or got[i] == pytest.approx(want[i], abs=1e-9) for i in want)


def test_impact_adds_up_and_new_regions_have_none(spark):
    _, df = regions_of(spark, 200)
    model = regional.RegionalElasticNet(["t"], ["a", "b"], "y").fit(df.filter("region != 'q'"))
    out = model.impact(df, {"t": "physical", "a": "physical", "b": "contextual"}).collect()
    assert {r.region for r in out} == {"hot", "p", "single"}
    for region in ("hot", "p"):
        assert sum(r.share_pct for r in out if r.region == region) == pytest.approx(100)
    assert model.transform(df.filter("region = 'q'")).filter("prediction is not null").count() == 0


def test_nothing_to_learn_from(spark):
    _, df = regions_of(spark, 10)
    with pytest.raises(ValueError):
        regional.RegionalElasticNet(["t"], ["a", "b"], "y").fit(df.filter("id < 0"))


def test_stages_are_counted_in_one_run_with_a_sink(spark, tmp_path):
    from parcelle.operators.evaluate import stage_report
    plans = []

    def sink(out):
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        out.write.parquet(str(tmp_path / "out"))

    report = stage_report(spark.range(1000), [("all", None), ("even", lambda d: d.filter("id % 2 = 0")), ("none", lambda d: d.filter("id < 0"))], sink)
    assert [tuple(r) for r in report.collect()] == [("all", 1000), ("even", 500), ("none", 0)]
    assert len(plans) == 1 and plans[0].count("Range (") == 1 and spark.read.parquet(str(tmp_path / "out")).count() == 0
