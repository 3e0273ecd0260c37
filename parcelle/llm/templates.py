"""Benchmark decontamination (operator 4): template canonicalisation.

Words (runs of letters and digits) become typed placeholders: a number (all digits, or a digit
first), a unit (a listed unit straight after a number) or a name (a capitalised word); any other
word stays as a case-folded literal (Unicode).  Windows of ``window`` placeholders and literals are hashed
and joined between benchmark items and documents; beside them, windows of the case-folded words themselves,
so that a word-for-word copy in another letter case, whose words are typed otherwise, is met too.  Windows that meet on one diagonal
(document place - item place) belong together; a diagonal counts if it holds ``run`` windows (all of them for
a shorter item; or all typed windows of an item that has fewer, if they stretch as far) and its slots are
consistent: over the diagonal every benchmark number, unit and name answers to one value in the document;
two values of the item may be given the same one.  So a question whose numbers and names were exchanged
throughout is caught, chance agreement of placeholders is not.

Most document windows never leave the scan: a bitmap of the benchmark's window hashes (2**24
bits, 2 MB whatever the benchmark's size) lets only possible hits through, and the shuffle join
that follows is exact.  A passage in a third of all documents makes many hits of few windows;
the benchmark's windows are broadcast if their counted size allows, else the join is a
shuffle join that adaptive execution splits; the diagonals are grouped by document, so no group grows.

Defined results: null and empty texts have no windows; items and documents shorter than the
window meet as one window of their own length, an item of fewer than ``LEAST_WORDS`` words only a text of just as many; a typed window with fewer than half literals is not
used, only its words as they are; null ids and repeated rows are kept apart by place of the row; repeated items are
reported under each item id; empty tables give an empty result.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.tables import BROADCAST_BYTES, row_key, saved, without
from parcelle.llm.words import LETTERS, Texts, mix64, multipliers, slices, hash_word

WINDOW, RUN = 8, 6
FILTER_BITS = 24
#: Hits that are sent on together: their slots are lists of strings, which a slice full of a common passage has many of.
HIT_ROWS = 4096
#: An item of fewer words is a common phrase: only a text that is nothing else holds it.
LEAST_WORDS = 4
#: Words taken as units after a number.
UNITS = ("mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons ounce ounces pound pounds ml l liter liters litre litres "
         "second seconds minute minutes hour hours day days week weeks month months year years percent dollars dollar euro euros cent cents "
         "mph kmh degrees degree volt volts watt watts kw gb mb kb").split()
NUMBER, UNIT, NAME, LITERAL = 0, 1, 2, 3


def folded(t: Texts) -> Texts:
    """``t`` case-folded; folding never makes or joins words, as every byte above ASCII is part of a word."""
    if not len(t.data) or t.data.max() < 0x80:
        return t
    raw = [t.data[a:b].tobytes() for a, b in zip(t.off[:-1].tolist(), t.off[1:].tolist())]
    raw = [x if x.isascii() else x.decode("utf-8", "surrogateescape").casefold().encode("utf-8", "surrogateescape") for x in raw]
    return Texts(t.first, t.n, np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in raw])]))


@cache
def _capitals() -> np.ndarray:
    """Upper- and title-case letters of all scripts, by code point."""
    return np.fromiter(((c := chr(i)).isupper() or c.istitle() for i in range(0x110000)), bool, 0x110000)


def _points(data: np.ndarray, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code point at each byte offset ``at`` (0 from ``ends`` on) and its number of bytes."""
    byte = lambda j: np.where(at + j < ends, data[np.minimum(at + j, len(data) - 1)], 0).astype(np.int64)
    b = byte(0)
    n = 1 + (b >= 0xC0) + (b >= 0xE0) + (b >= 0xF0)
    out = np.where(n == 1, b, b & (0x7F >> n))
    for j in range(1, 4):
        out = np.where(j < n, out << 6 | byte(j) & 0x3F, out)
    return np.where(out < 0x110000, out, 0), n


def canonical(t: Texts):
    """Words of ``t`` (case-folded), their types, the hash of each word's placeholder or literal and of the word itself."""
    w = t.words(LETTERS, lower=False)
    if not len(w.starts):
        return w, np.empty(0, np.int8), np.empty(0, np.uint64), np.empty(0, np.uint64)
    low = folded(t).words(LETTERS)
    h = low.hashes()
    first, n = _points(w.data, w.starts, w.ends)
    second, _ = _points(w.data, w.starts + n, w.ends)
    number = (first >= 0x30) & (first <= 0x39)
    capital = _capitals()
    name = capital[first] & ~capital[second]
    behind = np.concatenate([[False], number[:-1] & (w.doc[1:] == w.doc[:-1])])
    unit = behind & np.isin(h, np.array([hash_word(u) for u in UNITS], np.uint64))
    kind = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, LITERAL))).astype(np.int8)
    slot = mix64(np.arange(1, 4, dtype=np.uint64))
    return low, kind, np.where(kind == LITERAL, h, slot[np.minimum(kind, 2)]), h


def windows(kind: np.ndarray, h: np.ndarray, plain: np.ndarray, w, k: int, exactly: bool):
    """Hash, first word and whether of plain words, of each usable typed window of ``k`` words and, where it has a slot,
    of the same words unreplaced (without one both are the same); ``exactly``: only of texts of k words."""
    m = len(h) - k + 1
    if m <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, bool)
    lens = np.diff(w.at)[w.doc[:m]]
    at = np.flatnonzero((w.doc[:m] == w.doc[k - 1:]) & (lens == k if exactly else lens >= k))
    r, typed, words, literal = multipliers(k), np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64), np.zeros(len(at), np.int32)
    for j in range(k):
        typed += h[at + j] * r[j]
        words += plain[at + j] * r[j]
        literal += kind[at + j] == LITERAL
    use, other = 2 * literal >= k, literal < k
    out = np.concatenate([typed[use], words[other]])
    return mix64(out + np.uint64(k)), np.concatenate([at[use], at[other]]), np.repeat([False, True], [use.sum(), other.sum()])


def _slots(w, kind, a: int, k: int) -> list[str]:
    """type:value of each slot of the window at word ``a``, with its place in the window."""
    return [f"{j}:{kind[a + j]}:{w.text(a + j)}" for j in range(k) if kind[a + j] != LITERAL]


def _hits(df: DataFrame, n_keys: int, window: int, keep, lengths, schema: str) -> DataFrame:
    """A row per usable window (of documents: that passes ``keep``): key columns, row, hash, place, windows of the text, its usable typed ones, slots, plain (of unreplaced words).

    ``lengths``: the window lengths below ``window`` that are looked for at every place of a text; None: a
    text below ``window`` words makes one window of its own length."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        from pyspark import TaskContext
        bits = keep.value if keep is not None else None
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            keys = b.select(list(range(n_keys)))  # without the texts
            for t in slices(b.column(n_keys)):
                w, kind, h, words = canonical(t)
                lens = np.diff(w.at)
                sizes = sorted({window, *(lens[(lens > 0) & (lens < window)].tolist() if lengths is None else lengths)})
                for k in sizes:
                    g, at, plain = windows(kind, h, words, w, k, lengths is None and k < window or k < LEAST_WORDS)
                    if bits is not None:
                        x = (g >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                        ok = (bits[x >> 3] >> (x & 7).astype(np.uint8) & 1).astype(bool)
                        g, at, plain = g[ok], at[ok], plain[ok]
                    d = w.doc[at]
                    typed = np.bincount(d[~plain], minlength=t.n) if bits is None else np.zeros(t.n, np.int64)
                    for c in range(0, len(g), HIT_ROWS):
                        g_c, at_c, d_c, plain_c = (v[c:c + HIT_ROWS] for v in (g, at, d, plain))
                        part = keys.take(pa.array(t.first + d_c))
                        yield pa.RecordBatch.from_arrays(
                            [*part.columns, pa.array(row + t.first + d_c), pa.array(g_c.view(np.int64)), pa.array(at_c - w.at[d_c]),
                             pa.array((lens[d_c] - k + 1).astype(np.int64)), pa.array(typed[d_c].astype(np.int64)),
                             pa.array([_slots(w, kind, a, k) for a in at_c.tolist()], pa.list_(pa.string())), pa.array(plain_c)], names=names)
            row += b.num_rows

    return df.mapInArrow(run, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text: str = "text", window: int = WINDOW, run: int = RUN) -> DataFrame:
    """_id, _h (row key), doc_id, item_id, matched windows, item windows: a row per contaminated document row and item."""
    spark = docs.sparkSession
    items = saved(_hits(benchmark.select(F.col(item_col).cast("long"), F.col(item_text)), 1, window, None, None,
                        "item_id long, item_row long, h long, item_at long, item_windows long, item_typed long, item_slots array<string>, item_plain boolean"), "items")
    # Byte and bit of each hash in the bitmap, one row per byte set: at most 2**21 short rows, and a 2 MB table.
    place = F.shiftrightunsigned("h", 64 - FILTER_BITS)
    byte = (items.groupBy(F.shiftright(place, 3).alias("b")).agg(F.bit_or(F.expr(f"shiftleft(1, cast({2**3 - 1} & shiftrightunsigned(h, {64 - FILTER_BITS}) AS int))")).alias("m"))).toPandas()
    bits = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    bits[byte["b"].to_numpy(np.int64)] = byte["m"].to_numpy(np.int64)
    shorter = [r["k"] for r in benchmark.select(F.col(item_text).alias("t")).mapInArrow(_lengths(window), "k long").distinct().collect()]  # below window
    found = _hits(docs.select(*row_key(id_col, text_col), F.col(id_col).cast("long"), F.col(text_col).alias("_t")), 3, window,
                  spark.sparkContext.broadcast(bits), shorter, "_id long, _h long, doc_id long, row long, h long, at long, total long, typed long, slots array<string>, plain boolean")
    small = items.count() * 200 < BROADCAST_BYTES
    hits = found.join(F.broadcast(items) if small else items, "h").withColumn("diagonal", F.col("at") - F.col("item_at"))
    # Words that met unreplaced have their own value, whatever type their letter case gave them.
    pair = F.transform(F.arrays_zip("item_slots", F.when(F.col("item_plain") | F.col("plain"), F.col("item_slots")).otherwise(F.col("slots")).alias("slots")), lambda x: F.struct(
        F.regexp_replace(x["item_slots"], "^[0-9]+:", "").alias("a"), F.regexp_replace(x["slots"], "^[0-9]+:", "").alias("b")))
    lines = (hits.groupBy("_id", "_h", "doc_id", "row", "item_id", "item_row", "diagonal")
             .agg(F.countDistinct("item_at").alias("n"), F.max("item_windows").alias("item_windows"), F.max("item_typed").alias("item_typed"),
                  F.countDistinct(F.when(~F.col("item_plain"), F.col("item_at"))).alias("n_typed"), (F.max("item_at") - F.min("item_at") + 1).alias("span"),
                  F.array_distinct(F.flatten(F.collect_set(pair))).alias("pairs")))
    # Few typed windows are enough if they are all the item has and stretch as far as ``run`` side by side.
    enough = (F.col("n") >= F.least(F.lit(run), "item_windows")) | ((F.col("n_typed") == F.col("item_typed")) & (F.col("item_typed") > 0) & (F.col("span") >= run))
    good = enough & (F.size("pairs") == F.size(F.array_distinct("pairs.a")))
    return (lines.filter(good).groupBy("_id", "_h", "doc_id", "row", "item_id").agg(F.max("n").alias("matched"), F.max("item_windows").alias("item_windows"))
            .drop("row"))


def _lengths(window: int):
    def run(batches):
        for b in batches:
            for t in slices(b.column(0)):
                n = np.diff(t.words(LETTERS).at)
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(n[(n > 0) & (n < window)]).astype(np.int64))], names=["k"])
    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; their columns are unchanged."""
    return without(docs, contaminated(docs, benchmark, **kw), kw.get("id_col", "doc_id"), kw.get("text_col", "text"))
