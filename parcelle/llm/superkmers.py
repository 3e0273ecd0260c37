"""Substring dedup (operator 13): windows of words counted exactly by super-k-mer partitioning.

A window is ``window`` consecutive words of one text.  Its minimiser is the smallest hash of its
runs of a few words; consecutive windows that share it form a super-k-mer and travel as one packed
string (their words, joined by one space) to the bucket of the minimiser.  Equal windows have equal
minimisers, so they meet in one bucket, where sorting counts them; neighbours are compared word by
word, so hashes decide nothing there (see ``ngrams``).  Words covered by a window found twice or
more are removed; windows are judged on the input.

Skew: the bytes of every minimiser are counted first.  One beyond ``HOT_BYTES`` (a passage in a
third of all rows) is split: its super-k-mers are brought together by content (a 128-bit digest) with
a partial aggregate, and each different one is cut anew by a longer minimiser, at last into single
windows.  The verdicts travel back to the occurrences by a join that AQE splits.  A group is thus bounded by
``BUCKET_BYTES`` or by one text; nothing is capped or dropped.

Defined results: null and empty texts have no words; texts shorter than a window lose nothing; a
null id keeps its row; repeated rows are texts of their own (their windows are found again in each
other); an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.ngrams import distinct_codes, equal_runs, numbered, run_hash, sliding_min, word_codes
from parcelle.llm.tables import row_key, saved, shuffle_width
from parcelle.llm.words import NOT_SPACE, Texts, Words, mix64, slices
from parcelle.operators.sizing import fits_broadcast, maybe_broadcast

WINDOW = 35
#: Words of the minimiser, level by level; the last level takes the whole window.
MINIMISERS = (4, 16)
HOT_BYTES = 1 << 20
BUCKET_BYTES = 4 << 20
#: Bytes of super-k-mers in one shuffle partition.
PARTITION_BYTES = 32 << 20
_SPAN = pa.schema([("_a", pa.int64()), ("_b", pa.int64()), ("_lo", pa.int32()), ("_hi", pa.int32())])
_PIECE = "_a long, _b long, _n int, _at int, _min long, _text binary"


def super_kmers(w: Words, codes: np.ndarray, window: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end word and minimiser of each run of windows that share their minimiser."""
    none = np.empty(0, np.int64)
    if len(codes) < window:
        return none, none, none
    least = sliding_min(mix64(run_hash(codes, m) + np.uint64(m)), window - m + 1)
    inside = w.doc[:len(least)] == w.doc[window - 1:]
    new = inside.copy()
    if m == window:  # the last level: every window by itself
        first = np.flatnonzero(new)
        return first, first + window, least[first].view(np.int64)
    new[1:] &= ~inside[:-1] | (least[1:] != least[:-1]) | (w.doc[1:len(least)] != w.doc[:len(least) - 1])
    first = np.flatnonzero(new)
    count = np.add.reduceat(inside.astype(np.int64), first) if len(first) else none  # windows up to the next run
    return first, first + count + window - 1, least[first].view(np.int64)


def joined(t: Texts, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """All words of a slice, each with one space behind it, and where each starts (one more entry: the end)."""
    off = np.concatenate([[0], np.cumsum(w.ends - w.starts + 1)])
    out, letters = np.full(off[-1], 0x20, np.uint8), np.ones(off[-1], bool)
    letters[off[1:] - 1] = False
    out[letters] = t.data[NOT_SPACE[t.data]]
    return out, off


def _rows(batch: pa.RecordBatch):
    """Slices of a batch (_a, _b, _n, _text) with their words."""
    for t in slices(batch.column(3)):
        yield t, t.words(NOT_SPACE, lower=False)


def cut(texts: DataFrame, window: int, m: int, only: np.ndarray | None = None) -> DataFrame:
    """The super-k-mers of (_a, _b: the text's key, _n: its count, _text) with the word they start at; ``only``: of these minimisers."""
    wanted = texts.sparkSession.sparkContext.broadcast(only)

    def run(batches):
        for b in batches:
            keys = b.select(["_a", "_b", "_n"])
            for t, w in _rows(b):
                first, end, least = super_kmers(w, word_codes(w), window, m)
                if wanted.value is not None:
                    mine = np.isin(least, wanted.value)
                    first, end, least = first[mine], end[mine], least[mine]
                if not len(first):
                    continue
                text, off = joined(t, w)
                raw = text.tobytes()
                parts = [raw[i:j - 1] for i, j in zip(off[first].tolist(), off[end].tolist())]
                own = keys.slice(t.first, t.n).take(pa.array(w.doc[first]))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array((first - w.at[w.doc[first]]).astype(np.int32)), pa.array(least), pa.array(parts, pa.binary())],
                    names=["_a", "_b", "_n", "_at", "_min", "_text"])

    return texts.mapInArrow(run, _PIECE)


def hot_minimisers(texts: DataFrame, window: int, m: int) -> DataFrame:
    """(_min, bytes) of the minimisers beyond ``HOT_BYTES`` and, under null, the bytes of all others.

    The same cut, but only lengths are sent on, summed by slice."""
    def run(batches):
        for b in batches:
            for t, w in _rows(b):
                first, end, least = super_kmers(w, word_codes(w), window, m)
                if len(first):
                    off = np.concatenate([[0], np.cumsum(w.ends - w.starts + 1)])
                    keys, back = np.unique(least, return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys), pa.array(np.bincount(back, off[end] - off[first]).astype(np.int64))], names=["_min", "bytes"])

    each = texts.mapInArrow(run, "_min long, bytes long").groupBy("_min").agg(F.sum("bytes").alias("bytes"))
    return each.groupBy(F.when(F.col("bytes") > HOT_BYTES, F.col("_min")).alias("_min")).agg(F.sum("bytes").alias("bytes"))


def repeated_spans(table: pa.Table, window: int) -> pa.Table:
    """The word spans (_a, _b, _lo, _hi) of a bucket's windows that occur twice or more in it."""
    table = table.combine_chunks()
    for t in slices(table.column("_text"), 1 << 62):
        w = t.words(NOT_SPACE, lower=False)
        codes = word_codes(w)
        n = len(codes) - window + 1
        if n <= 0:
            break
        at = np.flatnonzero(w.doc[:n] == w.doc[window - 1:])
        weight = table.column("_n").to_numpy()

        def twice():
            order, new = equal_runs(codes, at, window)
            group = np.cumsum(new) - 1
            found = np.zeros(n, bool)
            found[at[order]] = (np.bincount(group, weight[w.doc[at[order]]]) >= 2)[group]
            return np.flatnonzero(found)

        hits = twice()
        step = np.zeros(len(codes) + 1, np.int32)
        step[hits] += 1
        step[hits + window] -= 1
        if not distinct_codes(w, codes, np.flatnonzero(np.cumsum(step[:-1]))):
            codes = numbered(w)
            hits = twice()
        if not len(hits):
            break
        row = w.doc[hits]
        fresh = np.ones(len(hits), bool)
        fresh[1:] = (np.diff(hits) > 1) | (np.diff(row) > 0)
        a = np.flatnonzero(fresh)
        b = np.append(a[1:], len(hits)) - 1
        lo = hits[a] - w.at[row[a]] + table.column("_at").to_numpy()[row[a]]
        keys = table.select(["_a", "_b"]).take(pa.array(row[a]))
        return pa.table([keys.column(0), keys.column(1), pa.array(lo, pa.int32()), pa.array(lo + hits[b] - hits[a] + window, pa.int32())], _SPAN)
    return _SPAN.empty_table()


def _by_content(pieces: DataFrame, window: int) -> DataFrame:
    """``pieces`` with a 128-bit digest of their text (_c, _d)."""
    return pieces.withColumns({"_c": F.xxhash64("_text"), "_d": F.xxhash64(F.lit(window), "_text")})


def _count(texts: DataFrame, window: int, levels: tuple[int, ...]) -> DataFrame:
    """Spans (_a, _b, _lo, _hi) of the repeated windows of ``texts``, once each."""
    m, deeper = min(levels[0], window), levels[1:]
    if not deeper:  # single windows of the hottest minimisers: only digests travel, counted by a partial aggregate
        places = saved(_by_content(cut(texts, window, window), window).drop("_text", "_min"), "hot-windows")
        again = places.groupBy("_c", "_d").agg(F.sum("_n").alias("_n")).filter(F.col("_n") >= 2).select("_c", "_d")
        return saved(places.join(again, ["_c", "_d"]).select("_a", "_b", F.col("_at").alias("_lo"), (F.col("_at") + window).alias("_hi")), "spans")
    spark = texts.sparkSession
    sizes = saved(hot_minimisers(texts, window, m), "minimisers")
    total, n_hot = sizes.agg(F.sum("bytes"), F.count("_min")).first()
    pieces = cut(texts, window, m)
    if total is None:
        return pieces.select("_a", "_b", F.col("_at").alias("_lo"), F.col("_at").alias("_hi"))
    hot = sizes.filter(F.col("_min").isNotNull()).select("_min")
    cold = pieces.join(maybe_broadcast(hot, n_hot), "_min", "left_anti") if n_hot else pieces
    buckets = max(1, -(-total // BUCKET_BYTES))
    cold = (cold.select(F.pmod("_min", F.lit(buckets)).alias("_bucket"), "_a", "_b", "_n", "_at", "_text")
            .repartition(shuffle_width(spark, total, PARTITION_BYTES), "_bucket"))

    def count(table: pa.Table) -> pa.Table:
        return repeated_spans(table, window)

    spans = cold.groupBy("_bucket").applyInArrow(count, "_a long, _b long, _lo int, _hi int")
    if not n_hot:
        return saved(spans.distinct(), "spans")
    if fits_broadcast(hot, n_hot):
        warm = cut(texts, window, m, np.sort(hot.toArrow().column(0).to_numpy()))
    else:
        warm = pieces.join(hot, "_min", "left_semi")
    places = saved(_by_content(warm, window).drop("_min"), "hot-pieces")
    different = saved(places.groupBy(F.col("_c").alias("_a"), F.col("_d").alias("_b"))
                      .agg(F.least(F.sum("_n"), F.lit(2)).cast("int").alias("_n"), F.first("_text").alias("_text")), "hot-texts")
    inner = _count(different, window, deeper).select(F.col("_a").alias("_c"), F.col("_b").alias("_d"), "_lo", "_hi")
    back = places.drop("_text", "_n").join(inner, ["_c", "_d"]).select(
        "_a", "_b", (F.col("_at") + F.col("_lo")).alias("_lo"), (F.col("_at") + F.col("_hi")).alias("_hi"))
    return saved(spans.unionByName(back).distinct(), "spans")


def repeated_passages(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _h: row key, _lo, _hi): word spans, from 0, that repeated windows cover, once each; they may overlap."""
    rows = docs.select(*row_key(id_col, text_col), F.lit(1).alias("_n"), F.col(text_col).alias("_text")).toDF("_a", "_b", "_n", "_text")
    return _count(rows, window, (*MINIMISERS, window)).toDF("_id", "_h", "_lo", "_hi")


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, n_words, n_removed and kept (the words no repeated window covers, joined by one space)."""
    spans = repeated_passages(docs, window, id_col, text_col).groupBy("_id", "_h").agg(F.collect_list(F.struct("_lo", "_hi")).alias("_spans"))
    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("_text"), *row_key(id_col, text_col))
    rows = rows.join(spans, ["_id", "_h"], "left").select(id_col, F.col("_spans._lo").alias("_lo"), F.col("_spans._hi").alias("_hi"), "_text")

    def run(batches):
        for b in batches:
            for t in slices(b.column(3)):
                w = t.words(NOT_SPACE, lower=False)
                own = b.slice(t.first, t.n)
                step = np.zeros(len(w.doc) + 1, np.int64)
                for column, sign in ((1, 1), (2, -1)):
                    lists = own.column(column)
                    place = lists.flatten().to_numpy() + w.at[np.repeat(np.arange(t.n), _lengths(lists))]
                    np.add.at(step, place, sign)
                keep = np.cumsum(step)[:-1] == 0
                text, off = joined(t, w)
                kept = text[np.repeat(keep, np.diff(off))].tobytes()
                size = np.concatenate([[0], np.cumsum(np.where(keep, np.diff(off), 0))])[w.at]
                n_words = np.diff(w.at)
                n_kept = np.diff(np.concatenate([[0], np.cumsum(keep)])[w.at])
                texts = [kept[i:max(i, j - 1)] for i, j in zip(size[:-1].tolist(), size[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), pa.array(n_words.astype(np.int64)), pa.array((n_words - n_kept).astype(np.int64)),
                     pa.array(texts, pa.binary()).cast(pa.string())], names=[id_col, "n_words", "n_removed", "kept"])

    return rows.mapInArrow(run, f"`{id_col}` long, n_words long, n_removed long, kept string")


def _lengths(lists: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc
    return pc.list_value_length(lists).fill_null(0).to_numpy()
