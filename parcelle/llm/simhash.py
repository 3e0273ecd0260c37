"""SimHash near-duplicates (operator 3): bit-sliced Hamming comparison.

Fingerprints: majority bits of the XXH64 (seed 42) of every word shingle.  Pairs: two
fingerprints within ``radius`` bits agree on at least one of ``radius + 1`` bands, so
distinct fingerprints meet in buckets (band, value).  Inside a bucket they are compared
bit-sliced: 64 rows lie vertically in one machine word per bit position ("bit planes"); a
query's distances to 64 rows grow at once in carry-save bitwise counters, and a word whose
64 lanes all exceed the radius is dropped before the remaining planes are read.

Skew: equal fingerprints are one row before anything is compared; a bucket beyond
``block_rows`` is cut into blocks and every pair of its blocks is a piece of work of its
own.  Of the links found a piece returns a spanning forest, never all pairs.

Defined results: null and empty texts have fingerprint 0 and are linked like any other;
texts of fewer words than the shingle give one shingle; a null id keeps its row, with the
smallest non-null id of its component (null if it has none); repeated rows stay repeated;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelle.llm.components import connected_components
from parcelle.llm.tables import packed, row_key, saved, shuffle_width, unpacked

BITS = 64
SEED = 42
#: Fingerprints of a component from which on it is joined by broadcast.
HOT_ROOT = 100_000


def majority_bits(hashes: np.ndarray) -> int:
    """The 64 bits set in over half of the hashes (0 for none)."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for a in range(0, len(hashes), 1 << 14):
        part = hashes[a:a + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    from xxhash import xxh64_intdigest
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= shingle:
        return np.array([xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *(ends[:len(words) - shingle].tolist())]
    stops = (ends[shingle - 1:] - 1).tolist()
    return np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(stops))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, key: bool = False) -> DataFrame:
    """(doc_id, fp) per row, with ``key`` also the row key (see ``tables.row_key``)."""
    def run(batches):
        for b in batches:
            texts = b.column(b.num_columns - 1)
            fp = np.fromiter((majority_bits(shingle_hashes(t.as_py(), shingle)) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fp.view(np.int64))], names=[*b.schema.names[:-1], "fp"])

    cols = row_key(id_col, text_col) if key else []
    src = docs.select(*cols, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
    return src.mapInArrow(run, ", ".join(["_id long, _h long"] * key + ["doc_id long, fp long"]))


def within(planes: np.ndarray, qbits: np.ndarray, words: np.ndarray, query: np.ndarray, radius: int) -> np.ndarray:
    """For each pair (query[i], words[i]): a word with bit j set if lane j is within ``radius`` bits.

    ``planes[b, w]``: bit b of the 64 rows of word w.  ``qbits[b, q]``: all ones if bit b of
    query q is set.  Counters c[0..k-1] hold each lane's distance modulo 2**k; ``over`` is
    sticky once a lane has passed 2**k - 1."""
    k = radius.bit_length()
    idx = np.arange(len(words))
    out = np.zeros(len(words), np.uint64)
    c = [np.zeros(len(words), np.uint64) for _ in range(k)]
    over = np.zeros(len(words), np.uint64)

    def exceeded():
        more, same = np.zeros_like(over), np.full_like(over, ~np.uint64(0))
        for i in reversed(range(k)):
            if radius >> i & 1:
                same = same & c[i]
            else:
                more |= same & c[i]
                same = same & ~c[i]
        return over | more

    for b in range(0, BITS, 2):
        x = planes[b, words] ^ qbits[b, query]
        y = planes[b + 1, words] ^ qbits[b + 1, query]
        half = x ^ y
        carry = (x & y) | (half & c[0]) if k else x | y  # full adder: two planes and the lowest counter
        if k:
            c[0] = c[0] ^ half
        for i in range(1, k):
            c[i], carry = c[i] ^ carry, c[i] & carry
        over |= carry
        if b % 8 == 6 and b < BITS - 2:
            alive = exceeded() != ~np.uint64(0)
            if not alive.all():
                idx, words, query, over = idx[alive], words[alive], query[alive], over[alive]
                c = [x[alive] for x in c]
                if not len(idx):
                    return out
    out[idx] = ~exceeded()
    return out


def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def forest(fp: np.ndarray, run: np.ndarray, side: np.ndarray, radius: int, chunk: int = 1 << 14) -> np.ndarray:
    """Local root index of every row: rows of one run within ``radius`` bits are joined.

    ``run``: sorted run number.  ``side``: 0 compares with all of its run; 1 and 2 (a piece of a
    cut bucket) only with the other side."""
    n = len(fp)
    parent = np.arange(n)
    if n < 2:
        return parent
    lens = np.bincount(run)
    words_of = -(-lens // 64)
    first_word = np.cumsum(words_of) - words_of
    first_row = np.cumsum(lens) - lens
    place = np.arange(n) - first_row[run]
    word, lane = first_word[run] + place // 64, (place % 64).astype(np.uint64)
    planes = np.zeros((BITS, int(words_of.sum())), np.uint64)
    qbits = np.empty((BITS, n), np.uint64)
    for b in range(BITS):
        bit = fp >> np.uint64(b) & np.uint64(1)
        qbits[b] = np.uint64(0) - bit
        np.bitwise_or.at(planes[b], word, bit << lane)
    full = np.zeros(planes.shape[1], np.uint64)
    np.bitwise_or.at(full, word, np.uint64(1) << lane)
    left = np.zeros_like(full)
    np.bitwise_or.at(left, word, (side == 1).astype(np.uint64) << lane)
    right = np.zeros_like(full)
    np.bitwise_or.at(right, word, (side == 2).astype(np.uint64) << lane)
    # Each query meets its own word and those after it in its run.
    count = words_of[run] - place // 64
    ends = np.cumsum(count)
    a = 0
    while a < n:
        z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + chunk, "right")))
        q = np.repeat(np.arange(a, z), count[a:z])
        w = word[q] + np.arange(len(q)) - np.repeat(ends[a:z] - count[a:z] - (ends[a - 1] if a else 0), count[a:z])
        near = within(planes, qbits, w, q, radius) & full[w]
        near &= np.where(side[q] == 1, right[w], np.where(side[q] == 2, left[w], ~np.uint64(0)))
        hit = np.flatnonzero(near)
        if len(hit):
            bits = np.unpackbits(near[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            i, j = np.nonzero(bits)
            x = q[hit[i]]
            y = first_row[run[x]] + (w[hit[i]] - first_word[run[x]]) * 64 + j
            while True:
                rx, ry = parent[x], parent[y]
                apart = rx != ry
                if not apart.any():
                    break
                x, y, rx, ry = x[apart], y[apart], rx[apart], ry[apart]
                np.minimum.at(parent, np.maximum(rx, ry), np.minimum(rx, ry))
                parent = _roots(parent)
        a = z
    return parent


def bands(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius + 1 bands that cover the 64 bits."""
    n = radius + 1
    edges = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def links(fps: DataFrame, radius: int, block_rows: int = 2048, rows_per_task: int = 100_000) -> DataFrame:
    """Edges (a, b) that join all fingerprints of ``fps`` (distinct, column fp) within ``radius`` bits."""
    spark = fps.sparkSession
    n = fps.count()
    cells = F.array(*[F.struct(F.lit(i).alias("band"), F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)).alias("value"))
                      for i, (s, w) in enumerate(bands(radius))])
    rows = fps.select("fp", F.explode(cells).alias("_c")).select("fp", "_c.band", "_c.value")
    big = saved(rows.groupBy("band", "value").count().filter(F.col("count") > block_rows)
                .select("band", "value", "count", F.ceil(F.col("count") / block_rows).cast("int").alias("k")), "big")
    more = big.agg(F.coalesce(F.sum(F.col("count") * (F.col("k") - 1)), F.lit(0))).first()[0]  # copies for the block pairs
    rows = rows.join(big.drop("count"), ["band", "value"], "left").withColumn("k", F.coalesce("k", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp", F.lit("block")), F.col("k")).cast("int")
    rows = (rows.withColumn("_b", mine).select("fp", "band", "value", "_b", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("_o"))
            .select("fp", "band", "value", F.least("_b", "_o").alias("i"), F.greatest("_b", "_o").alias("j"),
                    F.when(F.col("_b") == F.col("_o"), 0).when(F.col("_b") < F.col("_o"), 1).otherwise(2).alias("side")))
    parts = shuffle_width(spark, n * (radius + 1) + more, rows_per_task, 64)
    rows = rows.withColumn("_g", F.pmod(F.xxhash64("band", "value", "i", "j"), F.lit(parts)).cast("int"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["band", "value", "i", "j", "fp"], ignore_index=True)
        fp = pdf["fp"].to_numpy().view(np.uint64)
        keys = pdf[["band", "value", "i", "j"]].to_numpy()
        run = np.concatenate([[0], np.cumsum((keys[1:] != keys[:-1]).any(1))])
        root = forest(fp, run, pdf["side"].to_numpy(), radius)
        far = np.flatnonzero(root != np.arange(len(root)))
        return pd.DataFrame({"a": fp[far].view(np.int64), "b": fp[root[far]].view(np.int64)}).drop_duplicates()

    return rows.groupBy("_g").applyInPandas(compare, "a long, b long")


def cluster(prints: DataFrame, radius: int) -> DataFrame:
    """Adds ``component_id``, the smallest doc_id reachable, to a table with doc_id and fp."""
    per = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fp")
    comp = connected_components(links(per.select("fp"), radius), "a", "b")
    rooted = per.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = saved(rooted, "rooted")
    ids = saved(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("_m")), "ids")
    # A component beyond ``HOT_ROOT`` fingerprints meets its id by broadcast (at most rows / HOT_ROOT ids), not in one task.
    hot = F.broadcast(ids.filter(F.col("_m") > HOT_ROOT).drop("_m"))
    joined = rooted.join(hot, "root").unionByName(rooted.join(hot, "root", "left_anti").join(ids.filter(F.col("_m") <= HOT_ROOT).drop("_m"), "root"))
    by_fp = saved(joined.select("fp", "root", "component_id"), "byfp")
    return prints.join(by_fp, "fp")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``."""
    prints = saved(fingerprints(docs, id_col, text_col, shingle), "prints")
    return cluster(prints, radius).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row of every component stays: that with the smallest id (nulls last), then the smallest text hash.

    Whole repeats of the surviving row go too.  The columns of ``docs`` are unchanged."""
    prints = saved(fingerprints(docs, id_col, text_col, shingle, key=True), "prints")
    keep = (cluster(prints, radius).groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("_z"), "_id", "_h")).alias("k")).select("k._id", "k._h"))
    keep = saved(keep, "keep")
    # A copy of the row itself (same id and text) may be repeated: one row for each key.
    w = Window.partitionBy("_id", "_h").orderBy(F.xxhash64("_row"))
    rows = packed(docs, id_col, text_col).join(keep, ["_id", "_h"]).withColumn("_n", F.row_number().over(w)).filter("_n = 1")
    return unpacked(rows, docs.columns)
