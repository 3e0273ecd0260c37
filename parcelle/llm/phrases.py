"""Phrase collocation mining (operator 12): Toivonen's sampling over contiguous phrases, exact counts, ranked collocations.

A sample of the documents proposes, per language, the phrases (1 to ``max_words`` words) that look
frequent there at a lowered threshold.  A full pass counts these and their negative border: every
phrase that is not among them while all its parts are (all words; pairs of proposed words; triples
of proposed pairs).  Border phrases that turn out frequent join the proposed ones, and another full
pass counts the phrases whose border they open, until no border phrase is frequent.  Every frequent
phrase is then known, whatever the sample was: a bad sample costs passes, not results.

Passes count by 64-bit hashes of language and words, aggregated by slice before they are shuffled;
the proposed set is a bitmap of bounded size.  A shared hash or bit only lets a phrase be counted
that need not be.  A last pass counts the texts of the phrases found frequent, so every count of the
result is of the words themselves.

Skew: a language or phrase may hold any share of the rows, counts are partial aggregates.  No
set of phrases is collected or broadcast, but for the bitmap (at most ``MOST_BITS`` a length).

Defined results: null and empty texts have no words; a null language is ``und``; repeated rows
count each; a null id changes nothing; an empty table gives an empty result; other columns are not
looked at.  Products have up to 38 digits: exact up to 10**16 words, an arithmetic error beyond.
"""

from __future__ import annotations

import math
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelle.llm.ngrams import distinct_codes, equal_runs, numbered, run_hash, word_codes
from parcelle.llm.tables import row_key, saved
from parcelle.llm.words import byte_class, mix64, slices

MIN_COUNT, MAX_WORDS, PER_LANG = 10, 3, 2000
#: A candidate goes if a longer one that contains it has at least this percentage of its occurrences.
COVERED_PERCENT = 50
#: Share of the documents in the sample, by hash of the row, and the risk that a phrase at the threshold is not proposed.
SAMPLE, RISK = 0.1, 0.01
BREAKS = b".,;:!?\n\x0b\x0c\r"
#: The logarithm of the bits of a set, by length, stays within these bounds.
LEAST_BITS, MOST_BITS = 20, 27
#: Raw text that is counted together before anything is sent on.
SLICE_BYTES = 1 << 20
PART_ROWS = 1000
#: Counted texts that a task holds before it adds equal ones up and sends them on, and rows of a batch it sends.
MERGED_ROWS, SENT_ROWS = 120_000, 20_000

_WORD = byte_class(lambda b: b not in (0x20, 0x09) and b not in BREAKS)
_BREAK = byte_class(lambda b: b in BREAKS)


def lowered(min_count: int, share: float, risk: float) -> int:
    """Sample threshold: a phrase of ``min_count`` occurrences falls below it with probability ``risk``
    (Chernoff); 2 at least, as a single sighting proposes nothing."""
    expected = min_count * share
    return max(2, math.floor(expected - math.sqrt(2 * expected * math.log(1 / risk))))


def _parts(texts: pa.Array):
    """Slices of a column, taken from some rows at a time: a whole batch of texts is not copied."""
    for a in range(0, len(texts), PART_ROWS):
        for t in slices(texts.slice(a, PART_ROWS), SLICE_BYTES):
            yield replace(t, first=t.first + a)


def _runs(batch: pa.RecordBatch):
    """Slices of a batch (_lang, _seed, _text): words, the language seed of each word, and its last place in its piece."""
    seeds = batch.column(1).to_numpy()
    for t in _parts(batch.column(2)):
        w = t.words(_WORD)
        if not len(w.doc):
            continue
        piece = np.cumsum(_BREAK[w.data], dtype=np.int32)[w.starts]
        new = np.ones(len(w.doc), bool)
        new[1:] = (w.doc[1:] != w.doc[:-1]) | (piece[1:] != piece[:-1])
        first = np.flatnonzero(new)
        end = np.repeat(np.append(first[1:], len(new)), np.diff(np.append(first, len(new))))
        yield t, w, seeds[t.first:t.first + t.n].view(np.uint64)[w.doc], end


def _places(end: np.ndarray, k: int) -> np.ndarray:
    """Words at which a phrase of ``k`` words starts that stays in its piece."""
    return np.flatnonzero(np.arange(len(end)) + k <= end)


class Proposed:
    """The proposed phrases of each length as a bitmap over the leading bits of their hashes."""

    def __init__(self, bits: dict[int, np.ndarray]):
        self.bits = bits

    def has(self, k: int, h: np.ndarray) -> np.ndarray:
        bits = self.bits[k]
        at = h >> np.uint64(64 - (len(bits) * 8).bit_length() + 1)
        return bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1

    def opens(self, k: int, hashes: dict[int, np.ndarray], at: np.ndarray) -> np.ndarray:
        """Whether the phrases of ``k`` words at places ``at`` are proposed or on the border: both parts of k - 1 words are proposed."""
        if k == 1:
            return np.ones(len(at), bool)
        return self.has(k - 1, hashes[k - 1][at]) & self.has(k - 1, hashes[k - 1][at + 1])

    def joined(self, other: Proposed) -> Proposed:
        return Proposed({k: self.bits[k] | other.bits[k] for k in self.bits})

    def newly(self, k: int, hashes: dict[int, np.ndarray], at: np.ndarray, added: Proposed) -> np.ndarray:
        """The places ``at`` of phrases that this set opens and did not without the bits ``added`` to it last."""
        if k == 1:
            return at[:0]
        at = at[added.has(k - 1, hashes[k - 1][at]) | added.has(k - 1, hashes[k - 1][at + 1])]
        return at[self.opens(k, hashes, at)]


def bitmap(spark, found: DataFrame, sizes: dict[int, int]) -> Proposed:
    """The bitmap of (k, h); ``sizes``: the logarithm of its bits by length.  One row per 64 bits set reaches the driver."""
    bits = {k: np.zeros(1 << b - 3, np.uint8) for k, b in sizes.items()}
    cell = F.create_map(*[x for k, b in sizes.items() for x in (F.lit(k), F.lit(64 - b))])[F.col("k")]
    at = F.expr("shiftrightunsigned(h, _s)")
    cells = (found.withColumn("_s", cell).select("k", at.alias("_p")).groupBy("k", F.shiftright("_p", 6).alias("cell"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(_p & 63 as int))")).alias("mask")).toArrow())
    length, where, mask = (cells.column(i).to_numpy() for i in range(3))
    for k, b in bits.items():
        words = b.view("<i8")
        words[where[length == k]] |= mask[length == k]
    return Proposed(bits)


def _counts(docs: DataFrame, max_words: int, opened: Proposed | None, added: Proposed | None = None) -> DataFrame:
    """(k, h, a): occurrences by hash of the phrases that ``opened`` opens (None: of all).

    ``added``: only of those that its bits, the ones set last, have opened."""
    shared = docs.sparkSession.sparkContext.broadcast((opened, added))

    def run(batches):
        opened, added = shared.value
        for b in batches:
            for _, w, seed, end in _runs(b):
                words = mix64(word_codes(w) ^ seed)
                hashes = {}
                for k in range(1, max_words + 1):
                    hashes[k] = run_hash(words, k)
                    at = _places(end, k)
                    if added is not None:
                        at = opened.newly(k, hashes, at, added)
                    elif opened is not None:
                        at = at[opened.opens(k, hashes, at)]
                    keys, n = np.unique(hashes[k][at], return_counts=True)
                    if len(keys):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), k, np.int32)), pa.array(keys.view(np.int64)), pa.array(n)],
                                                         names=["k", "h", "a"])

    return docs.mapInArrow(run, "k int, h long, a long").groupBy("k", "h").agg(F.sum("a").alias("a"))


def _fresh(found: DataFrame, known: Proposed) -> DataFrame:
    """The rows (k, h) whose bit is not set in ``known``."""
    shared = found.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        for b in batches:
            k, h = b.column(0).to_numpy(), b.column(1).to_numpy().view(np.uint64)
            out = np.zeros(len(k), bool)
            for length in shared.value.bits:
                mine = np.flatnonzero(k == length)
                out[mine] = ~shared.value.has(length, h[mine])
            yield b.filter(pa.array(out))

    return found.select("k", "h").mapInArrow(run, "k int, h long")


def _texts(docs: DataFrame, found: Proposed, max_words: int) -> DataFrame:
    """(lang, k, phrase, a) of the phrases whose hash is in ``found``, counted by their words; k = 0: all words of the language."""
    shared = docs.sparkSession.sparkContext.broadcast(found)
    schema = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("a", pa.int64())])

    def count(t, w, seed, end, langs):
        """The counts of one slice; its phrases are grouped by codes that are told apart by their words."""
        lang = langs.indices.to_numpy()[w.doc]
        codes = word_codes(w)
        pure = mix64(codes ^ seed)
        places, used = {}, np.zeros(len(codes), bool)
        for k in range(1, max_words + 1):
            at = _places(end, k)
            places[k] = at = at[shared.value.has(k, run_hash(pure, k)[at])]
            for j in range(k):
                used[at + j] = True
        if not distinct_codes(w, codes, np.flatnonzero(used)):
            codes = numbered(w)
        hashes = {k: run_hash(codes, k) for k in places}
        off = np.concatenate([[0], np.cumsum(w.ends - w.starts + 1)])
        text, letters = np.full(off[-1], 0x20, np.uint8), np.ones(off[-1], bool)
        letters[off[1:] - 1] = False
        text[letters] = w.data[_WORD[w.data]]
        raw = text.tobytes()
        for i, n in zip(*np.unique(lang, return_counts=True)):
            name = langs.dictionary[int(i)].as_py()
            yield pa.table([pa.array([name]), pa.array([0], pa.int32()), pa.array([""]), pa.array([n], pa.int64())], schema)
            for k, at in places.items():
                mine = at[lang[at] == i]
                order, new = equal_runs(codes, mine, k, hashes[k])
                heads = np.flatnonzero(new)
                first = mine[order[heads]]
                phrases = pa.array([raw[x:y - 1] for x, y in zip(off[first].tolist(), off[first + k].tolist())], pa.binary()).cast(pa.string())
                yield pa.table([pa.array([name] * len(first), pa.string()), pa.array(np.full(len(first), k, np.int32)), phrases,
                                pa.array(np.diff(np.append(heads, len(mine))))], schema)

    def merged(parts):
        return pa.concat_tables(parts).group_by(["lang", "k", "phrase"]).aggregate([("a", "sum")]).rename_columns(schema.names).to_batches(SENT_ROWS)

    def run(batches):
        parts, rows = [], 0
        for b in batches:
            for t, w, seed, end in _runs(b):
                for part in count(t, w, seed, end, b.column(0).slice(t.first, t.n).dictionary_encode()):
                    parts.append(part)
                    rows += part.num_rows
                if rows > MERGED_ROWS:
                    yield from merged(parts)
                    parts, rows = [], 0
        if parts:
            yield from merged(parts)

    return docs.mapInArrow(run, "lang string, k int, phrase string, a long").groupBy("lang", "k", "phrase").agg(F.sum("a").alias("a"))


def _sizes(found: DataFrame, max_words: int, each: int) -> dict[int, int]:
    """The logarithm of the bits for the phrases of each length: ``each`` a phrase, within the bounds."""
    counted = {r["k"]: r["count"] for r in found.groupBy("k").count().collect()}  # one row per length
    return {k: min(MOST_BITS, max(LEAST_BITS, (each * counted.get(k, 0)).bit_length())) for k in range(1, max_words + 1)}


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, share: float = SAMPLE, risk: float = RISK,
                     lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(lang, k, phrase, a) of every phrase of 1 to ``max_words`` words with a >= ``min_count`` occurrences; k = 0: all words of the language."""
    spark = docs.sparkSession
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    columns = [lang.alias("_lang"), F.xxhash64(lang).alias("_seed"), F.col(text_col).alias("_text")]
    rows = docs.select(*columns)
    sample = docs.filter(F.pmod(F.xxhash64(*row_key(id_col, text_col)), F.lit(1_000_000)) < int(share * 1_000_000)).select(*columns)
    proposed = saved(_counts(sample, max_words, None).filter(F.col("a") >= lowered(min_count, share, risk)).select("k", "h"), "proposed")
    sizes = _sizes(proposed, max_words, 16)
    opened, added, passes = bitmap(spark, proposed, sizes), None, []
    while True:
        found = saved(_counts(rows, max_words, opened, added).filter(F.col("a") >= min_count).select("k", "h"), "frequent")
        passes.append(found)
        failed = saved(_fresh(found.filter(F.col("k") < max_words), opened), "border-failures")  # the longest open nothing
        if failed.isEmpty():
            break
        added = bitmap(spark, failed, sizes)
        opened = opened.joined(added)
    everything = passes[0]
    for found in passes[1:]:
        everything = everything.unionByName(found)
    texts = _texts(rows, bitmap(spark, everything, _sizes(everything, max_words, 64)), max_words)
    return saved(texts.filter((F.col("a") >= min_count) | (F.col("k") == 0)), "phrases")


def _words(phrase: Column, first, count) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, count), " ")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, per_lang: int = PER_LANG,
                 covered_percent: int = COVERED_PERCENT, share: float = SAMPLE, lang_col: str = "lang", text_col: str = "text",
                 id_col: str = "doc_id") -> DataFrame:
    """The first ``per_lang`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    Cutting a phrase in two gives l and r, the occurrences of its parts, and floor(10^6 a^2 / (l r)); the cut
    with the lowest score counts, of equal ones the first.  Phrases are ordered by score, occurrences, text."""
    found = frequent_phrases(docs, min_count, max_words, share, lang_col=lang_col, text_col=text_col, id_col=id_col)
    parts = found.filter((F.col("k") >= 1) & (F.col("k") < max_words)).select("lang", "phrase", "a")
    totals = found.filter(F.col("k") == 0).select("lang", F.col("a").alias("n"))
    candidates = found.filter(F.col("k") >= 2)
    k = F.col("k")
    cuts = candidates.select("lang", "phrase", "k", "a", F.explode(F.sequence(F.lit(1), k - 1)).alias("cut"))
    cuts = cuts.select("*", _words(F.col("phrase"), F.lit(1), F.col("cut")).alias("left"),
                       _words(F.col("phrase"), F.col("cut") + 1, k - F.col("cut")).alias("right"))
    scored = (cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
              .join(parts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"]))
    exact = F.expr("cast((cast(1000000 as decimal(38,0)) * a * a) div (cast(l as decimal(38,0)) * r) as long)")
    best = (scored.withColumn("score", exact).groupBy("lang", "phrase")
            .agg(F.min(F.struct("score", "cut", "l", "r")).alias("c"), F.first("a").alias("a")))
    inner = candidates.select("lang", "a", F.explode(F.transform(
        F.filter(F.flatten(F.transform(F.sequence(F.lit(2), F.greatest(k - 1, F.lit(2))), lambda n: F.transform(
            F.sequence(F.lit(1), F.greatest(k - n + 1, F.lit(1))), lambda i: F.struct(i.alias("i"), n.alias("n"))))), lambda s: s["n"] < k),
        lambda s: _words(F.col("phrase"), s["i"], s["n"]))).alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = (best.join(longer, ["lang", "phrase"], "left")
            .filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered_percent)))
    order = Window.partitionBy("lang").orderBy(F.desc("c.score"), F.desc("a"), "phrase")
    top = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_lang)
    return top.join(F.broadcast(totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n",
        F.col("c.score").alias("score"))
