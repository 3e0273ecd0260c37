"""Splits, forest properties, sources and sinks, re-runs."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from parcelle.operators.anomaly import anomaly_filter
from parcelle.operators.splits import hash_split, kfold
from parcelle.plans.queries import _features


def test_split_is_partition_and_stable(spark):
    f = _features(spark, SF_SMALL)
    a = hash_split(f, ["id_mutation"]).select("id_mutation", "valeur_fonciere", "split")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    b = hash_split(f, ["id_mutation"]).select("id_mutation", "valeur_fonciere", "split")
    rows_a, rows_b = sorted(a.collect()), sorted(b.collect())
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert rows_a == rows_b
    assert len(rows_a) == f.count()
    share = sum(r.split == "train" for r in rows_a) / len(rows_a)
    assert 0.7 < share < 0.9


def test_forest_keeps_share_and_drops_planted_outliers(spark):
    rng = np.random.default_rng(0)
    rows = [("g", f"k{i}", float(x), float(y)) for i, (x, y) in enumerate(rng.normal(0, 1, (2000, 2)))]
    rows += [("g", f"out{i}", 40.0 + i, -40.0) for i in range(5)]
    df = spark.createDataFrame(rows, "grp string, id_mutation string, a double, b double")
    kept = anomaly_filter(df, ["a", "b"], group_cols=("grp",), contamination=0.1)
    ids = {r.id_mutation for r in kept.collect()}
    assert not any(i.startswith("out") for i in ids)
    assert abs(len(ids) / len(rows) - 0.9) < 0.01
    again = {r.id_mutation for r in anomaly_filter(df, ["a", "b"], group_cols=("grp",)).collect()}
    assert again == ids


def test_csv_scan_round_trip(spark):
    from parcelle.sources import fixtures as fx
    from parcelle.sources.transactions import read_transactions
    base = tempfile.mkdtemp(prefix="parcelle-csv-")
    dvf = fx.dvf(spark, SF_SMALL).withColumn("y", F.year("date_mutation"))
    cols = [c for c in dvf.columns if not c.startswith("seq") and c not in ("departement", "y")]
    for (y, dep) in [(1995, "01"), (1996, "02")]:
        part = dvf.filter((F.col("y") == y) & (F.col("departement") == dep)).select(*cols, F.lit("junk").alias("extra"))
        pdf = part.toPandas()
        os.makedirs(f"{base}/{y}", exist_ok=True)
        pdf.to_csv(f"{base}/{y}/{dep}.csv.gz", index=False, compression="gzip")
    t = read_transactions(spark, base, years=[1995, 1996, 1999], departements=["01", 2])
    got = t.groupBy("year", "departement").count().collect()
    assert {(r.year, r.departement) for r in got} == {(1995, "01"), (1996, "02")}
    assert dict(t.dtypes)["surface_reelle_bati"] == "float"
    from parcelle.sources.transactions import missing_transaction_files
    missing = missing_transaction_files(spark, base, [1995, 1996, 1999], ["01", 2])
    assert missing == [(1995, "02"), (1996, "01"), (1999, "01"), (1999, "02")]


def test_partitioned_sink_idempotent(spark):
    from parcelle.sources.sinks import write_partitioned
    path = tempfile.mkdtemp(prefix="parcelle-sink-") + "/out"
    df = spark.createDataFrame([("A", 2020, 1.0), ("B", 2021, 2.0)], "region string, year int, v double")
    write_partitioned(df, path)
    write_partitioned(df.filter("region = 'A'"), path)
    assert spark.read.parquet(path).count() == 2


def test_landing_ingests_each_file_once(spark):
    from parcelle.streaming.landing import ingest_available
    from parcelle.sources import fixtures as fx
    from parcelle.schemas import TRANSACTION_COLUMNS
    base = tempfile.mkdtemp(prefix="parcelle-land-")
    land, table, ckpt = f"{base}/land", f"{base}/table", f"{base}/ckpt"
    dvf = fx.dvf(spark, SF_SMALL).withColumn("y", F.year("date_mutation"))
    cols = [n for n, _ in TRANSACTION_COLUMNS]

    def land_year(y):
        pdf = dvf.filter(F.col("y") == y).filter(F.col("departement") == "01").select(*cols).toPandas()
        os.makedirs(f"{land}/{y}", exist_ok=True)
        pdf.to_csv(f"{land}/{y}/01.csv.gz", index=False, compression="gzip")
        return len(pdf)

    n1 = land_year(1995)
    assert ingest_available(spark, land, table, ckpt) == n1
    assert ingest_available(spark, land, table, ckpt) == 0
    n2 = land_year(1996)
    assert ingest_available(spark, land, table, ckpt) == n2
    got = spark.read.parquet(table)
    assert got.count() == n1 + n2
    assert {r.year for r in got.select("year").distinct().collect()} == {1995, 1996}


def test_landing_rejects_shifted_header(spark):
    from parcelle.streaming.landing import ingest_available
    base = tempfile.mkdtemp(prefix="parcelle-land-bad-")
    os.makedirs(f"{base}/land/1995")
    import pandas as pd
    # same columns, another order: applied by position they would shift silently
    from parcelle.schemas import TRANSACTION_COLUMNS
    names = [n for n, _ in TRANSACTION_COLUMNS][::-1]
    pd.DataFrame([["x"] * len(names)], columns=names).to_csv(
        f"{base}/land/1995/01.csv.gz", index=False, compression="gzip")
    with pytest.raises(Exception):
        ingest_available(spark, f"{base}/land", f"{base}/table", f"{base}/ckpt")


def test_parquet_rewrite_keeps_department_codes(spark):
    from parcelle.sources.transactions import read_transactions_parquet, write_transactions_parquet
    from parcelle.schemas import TRANSACTION_COLUMNS
    path = tempfile.mkdtemp(prefix="parcelle-pq-") + "/t"
    cols = ", ".join(f"cast(null as {t.simpleString()}) as {n}" for n, t in TRANSACTION_COLUMNS[1:])
    df = spark.sql(f"select id as id_mutation, {cols}, 1995 + cast(id % 2 as int) as year, "
                   "case when id < 3 then '01' else '2A' end as departement from range(6)") \
        .withColumn("id_mutation", F.col("id_mutation").cast("string"))
    write_transactions_parquet(df, path)
    t = read_transactions_parquet(spark, path, years=[1995], departements=[1, "2A"])
    assert dict(t.dtypes)["departement"] == "string"
    got = sorted((r.id_mutation, r.departement) for r in t.collect())
    assert got == [("0", "01"), ("2", "01"), ("4", "2A")]


def test_resume_equals_full_run(spark):
    from parcelle.operators.resume import remaining
    todo = spark.createDataFrame([(1, None), (2, 2.0), (3, 3.0)], "k int, v double")
    done = spark.createDataFrame([(1, None), (3, 3.0)], "k int, v double")
    assert [r.k for r in remaining(todo, done, ["k", "v"]).collect()] == [2]


def test_grown_trees_are_valid_isolation_trees():
    """Route each tree's own sample: both children of a split are non-empty,
    the split feature varies in the node, the threshold lies in [min, max),
    and a leaf's value is depth + c(rows reaching it)."""
    from parcelle.operators.anomaly import c_factor, grow_forest
    rng = np.random.default_rng(7)
    X = np.vstack([rng.normal(size=(64, 3)), np.ones((64, 3))])      # tree 1: all constant
    X[:, 2] = np.round(X[:, 2])                                       # ties in one feature
    tree_of_row = np.repeat([0, 1], 64)
    forest = grow_forest(X, tree_of_row, np.random.default_rng(1), max_depth=6)
    assert set(forest) == {0, 1}
    for t, (feat, thr, left, right, value) in forest.items():
        rows = X[tree_of_row == t]
        stack = [(0, np.arange(len(rows)), 0)]
        seen = 0
        while stack:
            nd, idx, depth = stack.pop()
            seen += 1
            if feat[nd] < 0:
                assert value[nd] == pytest.approx(depth + float(c_factor(len(idx))))
                continue
            col = rows[idx, feat[nd]]
            assert col.min() <= thr[nd] < col.max()
            go = col <= thr[nd]
            assert go.any() and (~go).any() and depth < 6
            stack += [(left[nd], idx[go], depth + 1), (right[nd], idx[~go], depth + 1)]
        assert seen == len(feat)
    assert len(forest[1][0]) == 1          # a constant sample is a single leaf


def test_forest_fit_moves_rows_once(spark, monkeypatch):
    """Group sizes are broadcast to the rows, so the sample reaches the growth
    stage with a single exchange (the spread over tasks)."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic
    from parcelle.operators.anomaly import IsolationForest
    plans, orig = [], Classic.checkpoint

    def spy(self, eager=True):
        plans.append(self._jdf.queryExecution().executedPlan().toString())
        return orig(self, eager)

    rng = np.random.default_rng(5)
    rows = [(f"g{i % 3}", f"k{i}", float(x), float(y)) for i, (x, y) in enumerate(rng.normal(0, 1, (900, 2)))]
    df = spark.createDataFrame(rows, "grp string, id_mutation string, a double, b double")
    monkeypatch.setattr(Classic, "checkpoint", spy)
    IsolationForest(["a", "b"], ("grp",), ("id_mutation",), n_trees=10).fit(df)
    grow = plans[-1]
    assert "FlatMapGroupsInPandas" in grow and "BroadcastHashJoin" in grow, grow
    assert grow.count("Exchange hashpartitioning") == 1, grow


def test_missing_files_in_partitioned_layout(spark):
    from parcelle.sources.transactions import missing_transaction_files, write_transactions_csv
    from parcelle.schemas import TRANSACTION_COLUMNS
    base = tempfile.mkdtemp(prefix="parcelle-miss-") + "/t"
    cols = ", ".join(f"cast(null as {t.simpleString()}) as {n}" for n, t in TRANSACTION_COLUMNS[1:])
    df = spark.sql(f"select cast(id as string) as id_mutation, {cols}, 2020 as year, "
                   "'2A' as departement from range(3)")
    write_transactions_csv(df, base)
    assert missing_transaction_files(spark, base, [2020, 2021], ["2A", 5], layout="partitioned") == \
        [(2020, "05"), (2021, "2A"), (2021, "05")]


def test_parquet_rewrite_sorts_tasks_of_the_advisory_size(spark, tmp_path):
    """Many small files packed into one scan task are not one task of the write."""
    from parcelle.sources.transactions import read_transactions_parquet, write_transactions_parquet
    from parcelle.schemas import TRANSACTION_SCHEMA
    rows = spark.range(0, 40000, 1, 1).select(
        *[(F.sha2(F.col("id").cast("string"), 256) if f.name == "id_mutation" else F.lit(None).cast(f.dataType)).alias(f.name) for f in TRANSACTION_SCHEMA.fields],
        (F.lit(2000) + F.col("id") % 40).cast("int").alias("year"), F.lit("2A").alias("departement"))
    was = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "65536")
    try:
        write_transactions_parquet(rows, str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", was)
    t = read_transactions_parquet(spark, str(tmp_path / "t"))
    tasks = {f.rsplit("part-", 1)[1].split("-")[0] for f in t.inputFiles()}
    assert len(tasks) > 1 and t.agg(F.count("id_mutation"), F.countDistinct("id_mutation")).first() == (40000, 40000)
    assert t.select("year").distinct().count() == 40
