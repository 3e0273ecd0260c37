"""Quality classifier (operator 10): importance resampling over hashed n-grams.

Two bag-of-hashed-n-gram models (unigrams and bigrams in ``buckets`` buckets): the target model
from accepted texts, the raw model from all texts.  The target model is smoothed towards the raw
one: ``SHRINK`` n-grams are added to the seen and the expected count of each bucket, so n-grams
too rare to be met in the labelled sample say nothing against a text.  A text's log
importance weight is the sum over its n-grams of log p_target - log p_raw.  It is tempered to
a common length, 100 * weight / (n-grams + 20), as the raw sum would rank by length alone.
Texts are then drawn without replacement by Gumbel top-k: keyed Gumbel noise is added to each
tempered log weight and the k largest sums stay.  k is the number of texts whose tempered weight
reaches the threshold that separates labelled accepted from rejected texts best, so the share
kept follows the data.

The target model learns from at most ``fit_rows`` labelled rows of each class, those with the
smallest hash of their id (a documented bound); raw counts, weights, the threshold's count
and the k-th largest sum cover every row.  Per task one row per bucket leaves the scan, and the
two 65,536-entry tables are the only broadcast (fixed size).  The k-th sum is found by counting
rows in ever finer bins of its ordered bits; nothing is sorted or collected.

Defined results: null and empty texts have weight 0; a null id draws noise like id
-2**63; repeated rows share weight and noise, so they stay or go together unless they sit on
the k-th sum itself, where the text's hash and then all of the equal rows decide (equal rows
at the cut all stay); without labels of both classes every row stays; an empty table gives an
empty result; a document labelled both ways counts as neither.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.tables import row_key, saved, without
from parcelle.llm.words import shingle_hashes, slices

BUCKETS = 1 << 16
FIT_ROWS = 20_000
SHRINK = 5.0
#: Tempering: weights are brought to LENGTH n-grams; PRIOR pulls short texts to 0.
LENGTH, PRIOR = 100.0, 20.0


def features(t, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text index of every unigram and bigram."""
    w = t.words(lower=False)
    h = w.hashes()
    two, at = shingle_hashes(h, w.doc, 2)
    mod = np.uint64(buckets)
    return np.concatenate([h % mod, two % mod]).astype(np.int64), np.concatenate([w.doc, w.doc[at]])


def labelled(labels: DataFrame, fit_rows: int) -> DataFrame:
    """doc_id, good (0/1), calibrate: at most ``fit_rows`` of each class, the smallest id hashes."""
    one = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id")
           .agg(F.min("quality").alias("good"), F.max("quality").alias("_m")).filter("good = _m"))
    pick = [one.filter(F.col("good") == g).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows) for g in (0, 1)]
    # A quarter of the accepted rows is held out of the target model, for the threshold.
    return pick[0].unionByName(pick[1]).select(F.col("doc_id").cast("long").alias("doc_id"), "good",
                                               ((F.col("good") == 0) | (F.pmod(F.xxhash64("doc_id", F.lit("cut")), F.lit(4)) == 0)).alias("calibrate"))


def log_ratios(docs: DataFrame, good_ids: np.ndarray, id_col: str, text_col: str, buckets: int = BUCKETS) -> np.ndarray:
    """log p_target - log p_raw of every bucket; raw counts from all of ``docs``."""
    ids = np.sort(good_ids)

    def count(batches):
        raw, target = np.zeros(buckets), np.zeros(buckets)
        for b in batches:
            own = b.column(0).cast(pa.int64())
            known = np.isin(own.fill_null(0).to_numpy(zero_copy_only=False), ids) & own.is_valid().to_numpy(zero_copy_only=False)
            for t in slices(b.column(1)):
                f, d = features(t, buckets)
                raw += np.bincount(f, minlength=buckets)
                pick = known[t.first:t.first + t.n][d]
                target += np.bincount(f[pick], minlength=buckets)
        if raw.any():
            at = np.flatnonzero(raw)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(target[at].astype(np.int64)), pa.array(raw[at].astype(np.int64))],
                                             names=["bucket", "target", "raw"])

    counts = (docs.select(id_col, text_col).mapInArrow(count, "bucket long, target long, raw long")
              .groupBy("bucket").agg(F.sum("target").alias("t"), F.sum("raw").alias("r")).toPandas())  # at most ``buckets`` rows
    raw, target = np.zeros(buckets), np.zeros(buckets)
    raw[counts["bucket"]] = counts["r"]
    target[counts["bucket"]] = counts["t"]
    expected = raw * (target.sum() / max(1.0, raw.sum()))  # in as much target text, under the raw model
    return np.log(target + SHRINK) - np.log(expected + SHRINK)


def weights(docs: DataFrame, ratio: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """_id, _h (row key), doc_id, n_features, log_weight of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def score(batches):
        r = shared.value
        for b in batches:
            for t in slices(b.column(3)):
                f, d = features(t, len(r))
                w = np.bincount(d, weights=r[f], minlength=t.n).astype(float)
                part = b.slice(t.first, t.n)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(np.bincount(d, minlength=t.n).astype(np.int64)), pa.array(w)],
                                                 names=["_id", "_h", "doc_id", "n_features", "log_weight"])

    return (docs.select(*row_key(id_col, text_col), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
            .mapInArrow(score, "_id long, _h long, doc_id long, n_features long, log_weight double"))


def gumbel(seed: int):
    """Standard Gumbel noise keyed by the row, a function of its id and text alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "_id", "_h"), 11).cast("double")
    return -F.log(-F.log((bits + 0.5) / F.lit(float(2**53))))


def ordered_bits(col: str):
    """The rank of a double as a non-negative integer of 63 bits (larger sum, larger integer)."""
    step = F.lit(float(2**24))
    return F.greatest(F.lit(0), F.least(F.lit(2**62), F.floor(F.col(col) * step) + F.lit(2**61))).cast("long")


def kth_largest(rows: DataFrame, col: str, k: int) -> int | None:
    """The k-th largest value of a non-negative long column (63 bits), by counts in bins of 16 bits."""
    if k <= 0:
        return None
    known, left = 0, k
    for shift in (48, 32, 16, 0):
        here = rows.filter(F.shiftright(col, shift + 16) == F.lit(known)) if shift < 48 else rows
        bins = here.groupBy(F.shiftright(col, shift).alias("b")).count().collect()  # at most 65,536 rows
        for b, n in sorted(((r["b"], r["count"]) for r in bins), reverse=True):
            if left <= n:
                known = b
                break
            left -= n
        else:
            return 0
    return known


def best_threshold(good: np.ndarray, bad: np.ndarray) -> float:
    """The cut with the best balanced accuracy, midway between neighbours."""
    values = np.unique(np.concatenate([good, bad]))
    good, bad = np.sort(good), np.sort(bad)
    cuts = np.concatenate([[values[0] - 1], (values[1:] + values[:-1]) / 2])
    kept = 1 - np.searchsorted(good, cuts) / len(good)
    gone = np.searchsorted(bad, cuts) / len(bad)
    return float(cuts[int(np.argmax(kept + gone))])


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = FIT_ROWS,
             k: int | None = None, seed: int = 1) -> DataFrame:
    """_id, _h, doc_id, n_features, log_weight, tempered, gumbel_score, kept for every row of ``docs``."""
    sample = labelled(labels, fit_rows).toPandas()  # at most 2 * fit_rows rows
    good = sample.loc[~sample["calibrate"], "doc_id"].to_numpy(np.int64)
    ratio = log_ratios(docs, good, id_col, text_col)
    sample = sample.loc[sample["calibrate"], ["doc_id", "good"]]
    rows = (weights(docs, ratio, id_col, text_col)
            .withColumn("tempered", F.col("log_weight") * LENGTH / (F.col("n_features") + PRIOR))
            .withColumn("gumbel_score", F.col("tempered") + gumbel(seed)))
    rows = saved(rows.withColumn("_rank", ordered_bits("gumbel_score")), "weights")
    if k is None:
        fit = rows.join(F.broadcast(docs.sparkSession.createDataFrame(sample.rename(columns={"doc_id": "_s"}), "_s long, good int")),
                        F.col("doc_id") == F.col("_s")).select("good", "tempered").toPandas() if len(good) and len(sample) else None
        if fit is None or not len(fit) or fit["good"].nunique() < 2:
            return rows.drop("_rank").withColumn("kept", F.lit(True))
        cut = best_threshold(*(fit.loc[fit["good"] == g, "tempered"].to_numpy() for g in (1, 0)))
        k = rows.filter(F.col("tempered") >= cut).count()
    last = kth_largest(rows, "_rank", k)
    return rows.withColumn("kept", F.lit(False) if last is None else F.col("_rank") >= last).drop("_rank")


def quality_filter(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` that are drawn; their columns are unchanged."""
    return without(docs, resample(docs, labels, **kw).filter(~F.col("kept")), kw.get("id_col", "doc_id"), kw.get("text_col", "text"))
