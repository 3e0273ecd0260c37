"""Feature encoding: category lists, mode imputer, one-hot, robust scaler.

Fitted statistics (a category list, one mode and three quartiles per column)
are tiny model parameters and live on the driver like any MLlib model's; the
data never do.  Statistics are computed by distributed aggregates:

* modes — the table is unpivoted to (column, value) once, counted with a
  partial aggregate (hot values collapse map-side), and the best value per
  column picked by ``max_by``;
* exact quartiles — :func:`wide_quantiles`, sketches that bracket each rank and
  one counting aggregate, so no task ever holds a whole column or group.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelle.operators.sizing import maybe_broadcast


# ---------------------------------------------------------------------------
# Statistics
# ---------------------------------------------------------------------------
def category_list(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values, alphabetical."""
    return df.select(col).dropna().distinct().orderBy(col)


def _long_form(df: DataFrame, cols) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
                      for c in cols])
    return df.select(F.explode(pairs).alias("_p")).select("_p.feature", "_p.value")


def column_modes(df: DataFrame, cols) -> DataFrame:
    """(feature, mode): most frequent non-null value; ties → smallest value."""
    counts = _long_form(df, cols).dropna().groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("feature").agg(
        F.max_by("value", F.struct(F.col("n"), -F.col("value"))).alias("mode"))


def string_mode(df: DataFrame, col: str) -> DataFrame:
    counts = df.select(col).dropna().groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.min_by(col, F.struct(-F.col("n"), F.col(col))).alias("mode"))


def exact_quantiles(df: DataFrame, cols, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """(feature, p, value) — linear-interpolated quantiles, exactly as NumPy's
    default rule, for every column at once (:func:`wide_quantiles` without keys)."""
    return wide_quantiles(df, [], cols, probs)


def exact_quantiles_long(long_df: DataFrame, probs=(0.25, 0.5, 0.75),
                         accuracy: int = 10_000) -> DataFrame:
    """:func:`wide_quantiles` of a long (feature, value) table: (feature, p, value)."""
    q = wide_quantiles(long_df.select(F.col("feature").alias("_f"), "value"), ["_f"], ["value"], probs, accuracy)
    return q.select(F.col("_f").alias("feature"), "p", "value")


def _same(left: DataFrame, right: DataFrame, keys, how: str = "inner", more=()) -> DataFrame:
    """Join on ``keys`` null-safely and on ``more`` plainly; the keys of ``left`` are kept."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in (*keys, *more)],
                     *[c for c in right.columns if c not in keys and c not in more])
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys] + [F.col(k) == F.col(f"_r_{k}") for k in more]
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in (*keys, *more)])


def wide_quantiles(df: DataFrame, keys, cols, probs=(0.25, 0.5, 0.75), accuracy: int = 10_000) -> DataFrame:
    """(keys…, feature, p, value): exact linear quantiles of every column of
    ``cols`` within every group of ``keys`` (null keys are a group).

    No full sort and no unpivot of the rows: one aggregate keeps, as columns
    of one row per group, a ``percentile_approx`` sketch of each column
    (map-side partials, rank error ≤ n/accuracy), which brackets each target
    rank with a value band.  Joined to the rows, the bands let one more
    aggregate count the rows below each band; only values inside a band (about
    4n/accuracy a target) become rows of their own, and the exact ranks are
    read from that small table.  Groups stay in DataFrames throughout: the
    driver sees their number, nothing of them.  A target whose band misses its
    ranks (the sketch bound should prevent it) is recomputed by the full rank
    search.  Nulls and NaN are left out; a column without values has no row."""
    keys, cols, probs = list(keys), list(cols), [float(p) for p in probs]
    if not keys:
        return wide_quantiles(df.withColumn("_one", F.lit(1)), ["_one"], cols, probs, accuracy).drop("_one")
    eps = 2.0 / accuracy
    qs = sorted({min(1.0, max(0.0, x)) for p in probs for x in (p - eps, p + eps)})
    at = {q: i for i, q in enumerate(qs)}
    names = [f"_v{i}" for i in range(len(cols))]
    vals = [F.col(c).cast("double") for c in cols]
    rows = df.select(*keys, *[F.when(~F.isnan(v), v).alias(n) for v, n in zip(vals, names)])
    sketch = rows.groupBy(*keys).agg(*[x for n in names for x in (
        F.count(n).alias(f"_n{n}"), F.percentile_approx(n, qs, accuracy).alias(f"_q{n}"))]).checkpoint()
    n_groups = sketch.count()
    targets = [(i, j, p) for i in range(len(cols)) for j, p in enumerate(probs)]
    edges = [F.expr(f"_q{names[i]}[{at[min(1.0, max(0.0, p + d))]}] as {e}{i}_{j}")
             for i, j, p in targets for e, d in (("_a", -eps), ("_b", eps))]
    bands = sketch.select(*keys, *edges)
    if n_groups == 1:  # a single row: constants
        banded = rows.withColumns({k: F.lit(v).cast("double") for k, v in bands.drop(*keys).first().asDict().items()})
    else:
        banded = _same(rows, maybe_broadcast(bands, rows=n_groups), keys)
    # a row of its own for every value inside a band, and the row itself (-1) for the counts below the bands
    in_band = [" or ".join(f"({n} >= _a{i}_{j} and {n} <= _b{i}_{j})" for j in range(len(probs))) for i, n in enumerate(names)]
    inside = ", ".join(f"case when {t} then struct({i} as i, {n} as v) end" for i, (n, t) in enumerate(zip(names, in_band)))
    spread = banded.withColumn("_p", F.expr(f"explode(filter(array(struct(-1 as i, cast(null as double) as v), {inside}), x -> x is not null))"))
    counted = spread.groupBy(*keys, F.col("_p.i").alias("_i"), F.col("_p.v").alias("_v")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.expr(f"sum(case when _p.i = -1 and {names[i]} < _a{i}_{j} then 1 else 0 end) as _c{i}_{j}") for i, j, _ in targets]).checkpoint()
    totals = _same(sketch.select(*keys, *[f"_n{n}" for n in names], *edges), counted.filter("_i = -1").drop("_i", "_v", "n"), keys)
    wanted = ", ".join(f"struct({i} as _i, {p!r}D as p, _n{names[i]} as _n, {p!r}D * (_n{names[i]} - 1) as _pos, _a{i}_{j} as a, _b{i}_{j} as b, _c{i}_{j} as below)"
                       for i, j, p in targets)
    feature = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("_i") + 1).alias("feature")
    goal = totals.select(*keys, F.expr(f"explode(array({wanted})) as _t")).select(*keys, "_t.*").filter("_n > 0").select(
        *keys, "_i", feature, "p", "a", "b", "below", F.expr("floor(_pos) as lo"), F.expr("ceil(_pos) as hi"), F.expr("_pos - floor(_pos) as frac"))
    near = _same(counted.filter("_i >= 0").select(*keys, "_i", "_v", "n"),
                 maybe_broadcast(goal, rows=n_groups * len(targets)), keys, more=["_i"])
    w = (Window.partitionBy(*keys, "_i", "p").orderBy("_v")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = (near.filter("_v between a and b").withColumn("_end", F.col("below") + F.sum("n").over(w))
              .withColumn("_start", F.col("_end") - F.col("n")))
    picked = _picked(ranked, [*keys, "_i", "feature", "p", "frac"]).checkpoint()
    want = n_groups * len(targets)
    found = picked.filter(F.col("value").isNotNull())
    if found.count() == want:
        return found.select(*keys, "feature", "p", "value")
    reached = _same(goal.select(*keys, "_i", "p"), found.select(*keys, F.col("_i").alias("_fi"), F.col("p").alias("_fp"))
                    .withColumnRenamed("_fi", "_i").withColumnRenamed("_fp", "p"), keys, "left_anti", more=["_i", "p"])
    missed = reached.select(*keys, "_i").distinct().checkpoint()
    n_missed = missed.count()
    if n_missed == 0:  # columns without a value
        return found.select(*keys, "feature", "p", "value")
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(c).alias("feature"), F.col(n).alias("value"))
                                for i, (c, n) in enumerate(zip(cols, names))]))
    rest = rows.select(*keys, pairs.alias("_p")).select(*keys, "_p.*").filter(F.col("value").isNotNull())
    rest = _same(rest, maybe_broadcast(missed, rows=n_missed), keys, "left_semi", more=["_i"])
    searched = rank_search(rest.groupBy(*keys, "feature", "value").agg(F.count(F.lit(1)).alias("n")), [*keys, "feature"], probs)
    whole = _same(found, missed, keys, "left_anti", more=["_i"])
    return whole.select(*keys, "feature", "p", "value").unionByName(searched)


def _picked(ranked: DataFrame, by) -> DataFrame:
    """(by…, value) from rows that hold the ranks [_start, _end) of the value ``_v``; ``lo``, ``hi``, ``frac`` name the ranks wanted."""
    def holds(rank: str):
        return (F.col(rank) >= F.col("_start")) & (F.col(rank) < F.col("_end"))
    got = ranked.groupBy(*by).agg(F.max(F.when(holds("lo"), F.col("_v"))).alias("_lo"), F.max(F.when(holds("hi"), F.col("_v"))).alias("_hi"))
    return got.withColumn("value", F.col("_lo") + F.col("frac") * (F.col("_hi") - F.col("_lo"))).drop("_lo", "_hi")


def exact_quantiles_counts(dist: DataFrame, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Exact quantiles from a pre-counted (feature, value, n) table with one
    row per distinct non-null (feature, value): (feature, p, value)."""
    return rank_search(dist, ["feature"], probs)


def rank_search(dist: DataFrame, keys, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """(keys…, p, value) from (keys…, value, n), one row per distinct pair:

    1. range-partition + sort the distinct pairs (a hot value is one row, so
       this cannot skew) and take running counts inside each partition;
    2. per-(partition, keys) totals, summed up over the partitions — at most
       one row per group and partition that holds a part of it;
    3. keep only the rows holding the ranks floor(p·(n−1)) and ceil(p·(n−1)),
       interpolate."""
    keys = list(keys)
    n_parts = int(dist.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (dist.repartitionByRange(n_parts, *keys, "value")
              .withColumn("_pid", F.spark_partition_id()))
    w = (Window.partitionBy("_pid", *keys).orderBy("value")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumn("_cum", F.sum("n").over(w)).checkpoint()
    totals = local.groupBy(*keys, "_pid").agg(F.sum("n").alias("t"))
    group = Window.partitionBy(*keys)
    before = F.sum("t").over(group.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    placed = totals.select(*keys, "_pid", F.coalesce(before, F.lit(0)).alias("_off"), F.sum("t").over(group).alias("_n")).checkpoint()
    ranked = (_same(local, maybe_broadcast(placed), keys, more=["_pid"])
              .withColumn("_end", F.col("_off") + F.col("_cum"))      # exclusive end rank
              .withColumn("_start", F.col("_end") - F.col("n"))
              .withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
              .withColumn("_pos", F.col("p") * (F.col("_n") - 1))
              .withColumns({"lo": F.floor("_pos"), "hi": F.ceil("_pos"), "frac": F.col("_pos") - F.floor("_pos"), "_v": F.col("value")}))
    hit = ranked.filter("(lo >= _start and lo < _end) or (hi >= _start and hi < _end)")
    return _picked(hit.drop("value"), [*keys, "p", "frac"]).drop("frac")


# ---------------------------------------------------------------------------
# Fitted transformers
# ---------------------------------------------------------------------------
@dataclass
class ModeImputerModel:
    modes: dict

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                               for c, v in self.modes.items() if v is not None})


class ModeImputer:
    """Fill nulls with the column's most frequent value (smallest on a tie)."""

    def __init__(self, cols):
        self.cols = list(cols)

    def fit(self, df: DataFrame) -> ModeImputerModel:
        types = {f.name: f.dataType.typeName() for f in df.schema.fields}
        num = [c for c in self.cols if types[c] != "string"]
        modes = {}
        if num:
            modes.update({r["feature"]: r["mode"] for r in column_modes(df, num).collect()})
        for c in self.cols:
            if types[c] == "string":
                modes[c] = string_mode(df, c).first()["mode"]
        return ModeImputerModel(modes)


@dataclass
class RobustScalerModel:
    median: dict
    iqr: dict

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: (F.col(c).cast("double") - F.lit(self.median[c]))
            / F.lit(self.iqr[c] if self.iqr[c] != 0 else 1.0)
            for c in self.median})


class RobustScaler:
    """(x − median) / IQR; a zero IQR divides by 1 (MLlib's RobustScaler maps
    such columns to 0, which would erase sparse columns)."""

    def __init__(self, cols):
        self.cols = list(cols)

    def fit(self, df: DataFrame) -> RobustScalerModel:
        q = {(r["feature"], r["p"]): r["value"] for r in exact_quantiles(df, self.cols).collect()}
        med = {c: q.get((c, 0.5), 0.0) for c in self.cols}
        iqr = {c: q.get((c, 0.75), 0.0) - q.get((c, 0.25), 0.0) for c in self.cols}
        return RobustScalerModel(med, iqr)


@dataclass
class OneHotModel:
    col: str
    categories: list = field(default_factory=list)

    def columns(self):
        return [f"{self.col}__{i}" for i in range(len(self.categories))]

    def transform(self, df: DataFrame) -> DataFrame:
        """One 0/1 column per known category; unknown or null → all zeros."""
        return df.withColumns({
            name: F.coalesce(F.col(self.col) == F.lit(cat), F.lit(False)).cast("double")
            for name, cat in zip(self.columns(), self.categories)})


class OneHot:
    def __init__(self, col: str, categories=None):
        self.col, self.categories = col, categories

    def fit(self, df: DataFrame) -> OneHotModel:
        cats = self.categories
        if cats is None:
            cats = [r[0] for r in category_list(df, self.col).collect()]
        return OneHotModel(self.col, list(cats))


@dataclass
class BlockEncoderModel:
    """Imputer → one-hot (categoricals) then imputer → robust scaler
    (numerics), assembled into one vector column."""
    cat_imputer: ModeImputerModel | None
    onehots: list
    num_imputer: ModeImputerModel | None
    scaler: RobustScalerModel | None
    output: str

    def feature_names(self):
        names = [n for oh in self.onehots for n in oh.columns()]
        return names + (list(self.scaler.median) if self.scaler else [])

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        if self.cat_imputer:
            out = self.cat_imputer.transform(out)
        for oh in self.onehots:
            out = oh.transform(out)
        if self.num_imputer:
            out = self.num_imputer.transform(out)
        if self.scaler:
            out = self.scaler.transform(out)
        va = VectorAssembler(inputCols=self.feature_names(), outputCol=self.output,
                             handleInvalid="keep")
        return va.transform(out)


class BlockEncoder:
    def __init__(self, categorical=(), numeric=(), categories: dict | None = None,
                 output: str = "features"):
        self.categorical, self.numeric = list(categorical), list(numeric)
        self.categories, self.output = categories or {}, output

    def fit(self, df: DataFrame) -> BlockEncoderModel:
        """One aggregate per categorical column and one for all numeric
        columns; every fitted statistic comes from those count tables.

        * categorical: (value, n) — bounded by the category count — gives the
          mode (ties → smallest) and, after filling, the category list;
        * numeric: (feature, value, n) with the nulls as value null gives the
          mode, and moving each null count onto its mode gives the counts of
          the imputed data, whose exact quartiles feed the scaler — the same
          statistics as imputer-then-scaler, without a second pass."""
        ci = ohs = None
        if self.categorical:
            modes, ohs = {}, []
            for c in self.categorical:
                counts = [(r[0], r[1]) for r in
                          df.groupBy(c).agg(F.count(F.lit(1)).alias("n")).collect()]
                known = [(v, n) for v, n in counts if v is not None]
                modes[c] = min(known, key=lambda vn: (-vn[1], vn[0]))[0] if known else None
                cats = self.categories.get(c)
                if cats is None:
                    cats = sorted(v for v, _ in known)
                ohs.append(OneHotModel(c, list(cats)))
            ci = ModeImputerModel(modes)
        ni = sc = None
        if self.numeric:
            counts = (_long_form(df, self.numeric).groupBy("feature", "value")
                      .agg(F.count(F.lit(1)).alias("n")).checkpoint())
            known = counts.filter(F.col("value").isNotNull())
            mode_rows = (known.groupBy("feature")
                         .agg(F.max_by("value", F.struct(F.col("n"), -F.col("value"))).alias("mode"))
                         .collect())
            modes = {r["feature"]: r["mode"] for r in mode_rows}
            ni = ModeImputerModel(modes)
            nulls = [(r["feature"], float(modes[r["feature"]]), r["n"]) for r in
                     counts.filter(F.col("value").isNull()).collect()
                     if modes.get(r["feature"]) is not None]
            filled = known
            if nulls:
                moved = df.sparkSession.createDataFrame(nulls, "feature string, value double, n long")
                filled = (known.unionByName(moved).groupBy("feature", "value")
                          .agg(F.sum("n").alias("n")))
            q = {(r["feature"], r["p"]): r["value"] for r in exact_quantiles_counts(filled).collect()}
            med = {c: q.get((c, 0.5), 0.0) for c in self.numeric}
            iqr = {c: q.get((c, 0.75), 0.0) - q.get((c, 0.25), 0.0) for c in self.numeric}
            sc = RobustScalerModel(med, iqr)
        return BlockEncoderModel(ci, ohs or [], ni, sc, self.output)


def grouped_quantiles(df: DataFrame, keys, value: str, probs=(0.5,)) -> DataFrame:
    """(keys…, p, value): exact linear quantiles of ``value`` per group, a hot
    group spread over many tasks (``percentile`` would build one task's buffer of it)."""
    return wide_quantiles(df, keys, [value], probs).drop("feature")
