"""Pfair mixing: windows, deviation below one block at every prefix, every row once."""

import random

import pytest
from pyspark.sql import functions as F

from parcelle.llm import pfair


@pytest.mark.parametrize("seed", range(12))
def test_every_block_in_its_window_and_deviation_below_one(seed):
    r = random.Random(seed)
    slots = pfair.shares({f"s{i}": r.choice([1, 2, 5, 40, 300]) for i in range(r.choice([1, 2, 3, 20]))}, r.choice([7, 60, 1000]))
    q = sum(slots.values())
    out = pfair.pattern(slots)
    assert sorted(t for *_, t in out) == list(range(q)) and all(rel <= t < d for _, _, rel, d, t in out)
    had = dict.fromkeys(slots, 0)
    for s, _, _, _, t in out:
        had[s] += 1
        assert all(abs(had[x] - (t + 1) * slots[x] / q) < 1 for x in slots)


def docs_of(spark, sizes):
    rows = [(i * 1000 + j, f"t{j}", s) for i, (s, n) in enumerate(sizes.items()) for j in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_rows_interleave_by_weight(spark):
    df = docs_of(spark, {"a": 700, "b": 90, "c": 400, None: 33})
    weights = {"a": 5, "b": 1, "c": 3, None: 1}
    out = pfair.mix(df, weights, block_rows=8).toPandas()
    assert len(out) == 1223 and out.doc_id.is_unique and not out.duplicated(["mix_slot", "mix_place"]).any()
    assert ((out.mix_release <= out.mix_slot) & (out.mix_slot < out.mix_deadline)).all()
    assert out.groupby(["mix_slot"]).mix_source.nunique(dropna=False).max() == 1
    sizes = out.groupby([out.mix_source.fillna("-"), "mix_block"]).size()
    assert (sizes.groupby(level=0).apply(lambda x: (x.iloc[:-1] == 8).all())).all()
    on = out[out.on_target]
    assert on.mix_slot.nunique() == on.mix_slot.max() + 1 and len(on) == 8 * on.mix_slot.nunique()
    for t in (10, 25, on.mix_slot.max() + 1):
        part = on[on.mix_slot < t]
        for s, w in weights.items():
            n = len(part[part.mix_source.isna()] if s is None else part[part.mix_source == s]) / 8
            assert abs(n - t * w / 10) < 1


def test_same_mix_for_any_partitioning(spark):
    df = docs_of(spark, {"a": 300, "b": 50})
    key = ["doc_id", "mix_slot", "mix_place"]
    one, two = (pfair.mix(x, block_rows=4).toPandas()[key].sort_values("doc_id").to_numpy().tolist() for x in (df.coalesce(1), df.repartition(7)))
    assert one == two


def test_hostile_rows(spark):
    rows = [(None, None, None), (1, "", "x"), (1, "", "x"), (2, "z" * 10**6, "y"), (None, "q", "null"), (None, "q", "null")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("_a", F.lit(1)).withColumn("_source", F.lit("c"))
    out = pfair.mix(df)
    assert out.count() == 6 and out.columns[:5] == df.columns
    assert pfair.mix(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        pfair.mix(df, {"x": 1})


def test_deviation_from_the_exact_targets_over_a_long_schedule(spark):
    sizes = {"hot": 6000, **{f"s{i}": 630 for i in range(19)}}
    out = pfair.mix(docs_of(spark, sizes), block_rows=1).select("mix_source", "mix_slot", "on_target").toPandas()
    assert len(out) == sum(sizes.values())
    on = out[out.on_target].sort_values("mix_slot")
    assert len(on) > 10_000
    total = sum(n ** 0.5 for n in sizes.values())
    for s, n in sizes.items():
        had = (on.mix_source == s).to_numpy().cumsum()
        assert abs(had - (on.mix_slot.to_numpy() + 1) * n ** 0.5 / total).max() < 1


def test_a_small_weight_is_not_raised(spark):
    out = pfair.mix(docs_of(spark, {"a": 9000, "b": 4}), {"a": 9999, "b": 1}, block_rows=1).toPandas()
    assert ((out.mix_release <= out.mix_slot) & (out.mix_slot < out.mix_deadline)).all()
    assert (out[out.on_target].mix_source == "b").sum() <= 1 and len(out) == 9004
