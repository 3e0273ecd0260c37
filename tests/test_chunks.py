"""Enrichment saved chunk by chunk: a job that fails in the middle goes on from its last chunk."""

import pytest
from pyspark.sql import functions as F

from parcelle.operators.resume import DEALT, commits, enrich_in_chunks


def todo_of(spark, n=300):
    rows = [(i, None if i % 7 == 0 else i % 40, f"v{i}") for i in range(n)] + [(1, 1, "v1")]
    return spark.createDataFrame(rows, "id long, k long, v string").withColumn("chunk", F.lit("own"))


def total(df):
    """One row per row, with the number of rows of its key: right only if a key's rows stay together."""
    return df.join(df.groupBy("id", "k").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("k", "k2").withColumnRenamed("id", "id2"),
                   (F.col("id") == F.col("id2")) & F.col("k").eqNullSafe(F.col("k2"))).drop("id2", "k2")


def rows_of(df):
    return sorted(map(tuple, df.select("id", "k", "v", "chunk", "n").collect()), key=str)


def test_a_job_that_fails_resumes_at_its_chunk(spark, tmp_path):
    todo, path, calls = todo_of(spark), str(tmp_path / "c"), []

    def failing(df):
        calls.append(df.count())
        if len(calls) == 4:
            bad = total(df).withColumn("n", F.when(F.col("id") >= 0, F.raise_error(F.lit("lost"))).cast("long"))
            (tmp_path / "c/data/run=0/chunk=3").mkdir(parents=True, exist_ok=True)
            return bad
        return total(df)

    with pytest.raises(Exception, match="lost"):
        enrich_in_chunks(todo, ["id", "k"], failing, path, chunks=8)
    entered = commits(spark, path)
    assert sorted(entered) == [(0, DEALT), (0, 0), (0, 1), (0, 2)] and entered[0, DEALT] == 301
    again = []
    out = enrich_in_chunks(todo, ["id", "k"], lambda df: again.append(df.count()) or total(df), path, chunks=8)
    assert len(again) == 5 and sum(again) == 301 - sum(calls[:3])
    assert rows_of(out) == rows_of(total(todo))


def test_only_new_keys_make_a_further_run(spark, tmp_path):
    todo, path = todo_of(spark), str(tmp_path / "c")
    enrich_in_chunks(todo.filter("id < 100"), ["id", "k"], total, path, chunks=3)
    seen = []
    out = enrich_in_chunks(todo, ["id", "k"], lambda df: seen.append(df.agg(F.min("id")).first()[0]) or total(df), path, chunks=3)
    assert min(seen) == 100 and rows_of(out) == rows_of(total(todo))
    before = commits(spark, path)
    same = enrich_in_chunks(todo, ["id", "k"], lambda df: pytest.fail("nothing is left to do"), path, chunks=3)
    assert rows_of(same) == rows_of(out) and commits(spark, path) == before


def test_a_job_killed_while_dealing_deals_again(spark, tmp_path):
    todo, path = todo_of(spark, 50), str(tmp_path / "c")
    todo.limit(5).withColumn("_chunk", F.lit(0)).write.partitionBy("_chunk").parquet(f"{path}/todo/run=0")
    assert rows_of(enrich_in_chunks(todo, ["id", "k"], total, path, chunks=2)) == rows_of(total(todo))


def test_nothing_to_enrich_has_the_columns(spark, tmp_path):
    out = enrich_in_chunks(todo_of(spark).limit(0), ["id", "k"], total, str(tmp_path / "c"))
    assert out.columns == ["id", "k", "v", "chunk", "n"] and out.count() == 0
