"""Connected components of an edge table by alternating large-star and small-star steps
(Kiveris et al., 2014): every step is one aggregate and one join on the node, the edge
count never grows, and the step's edges are written, so a lost executor repeats one step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.tables import saved


def _star(e: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v), u > v."""
    if large:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        out = (e.join(low, "u").filter(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(low.select("u", F.col("m").alias("v"))))
    return out.filter(F.col("u") > F.col("v")).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node with an edge to another; root is the component's smallest node.

    Null ends and self-edges are ignored; repeated and reversed edges count once."""
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct())
    e = saved(e, "cc")
    before = None
    while True:
        e = saved(_star(_star(e, True), False), "cc")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
