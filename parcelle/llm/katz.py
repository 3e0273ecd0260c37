"""LM scoring (operator 7): Katz backoff over Good-Turing discounted bigrams.

P(w | h) = r* / c(h) if the bigram was seen r times in training, else alpha(h) P1(w); P1(w) = r* / N
for a seen word and the left-over mass for all others together.  Counts up to K are discounted by
Good-Turing (Katz 1987), larger ones by EPS, so every history keeps mass; alpha(h) = (1 - sum of the seen
P(w | h)) / (1 - sum of P1 of the same words) normalises each history exactly.  The history of a
text's first token is a start mark.

Work on Spark, for a corpus of any size:

1. Words are counted (partial sums per slice of text, then one sum per word); the table gives N, V,
   the counts of counts and the few words so frequent that they are split below (at most 4 per bucket).
2. Every token place goes once to the bucket of its own word (a frequent word's places are dealt out by
   history), packed: the places of one slice and bucket are one row of small integer arrays.  A bucket sees all
   places of its bigrams and knows c(w), so it yields each text's part of the score, the counts of counts
   of bigrams, each history's sums, and the unseen bigrams by history.  This is written as a partitioned
   table (``kind``).
3. Buckets of histories turn the sums into alpha(h) and settle the unseen bigrams; the sums of
   frequent histories are added first (at most 4 per bucket), so their bigrams can be dealt out.
4. The parts are added by slice of text.

In a seen bigram -log10 c(h) is added where h itself stands as a word, and taken back in step 3 for unseen ones, so
seen bigrams need no second shuffle.  A bucket's size is bounded: buckets grow in number with the corpus,
and no word, history or text is gathered whole unless it is small.  Words are told apart by 64-bit hashes.

Defined results: null and empty texts hold the end mark alone; a null id counts as the text '' (training);
repeated rows are scored each; if nothing is left to learn from, N = V = 0 and P1 is 1 for every word; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.llm.tables import saved
from parcelle.llm.words import mix64, slices

K, EPS = 5, 1e-3
SLICE_BYTES = 10 << 20
MIN_BUCKETS, BUCKET_TOKENS, ROUNDS = 128, 2_000_000, 2
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)


def pack(*arrays: np.ndarray) -> bytes:
    from zstandard import ZstdCompressor

    def small(a):
        if a.dtype.kind in "iu" and a.dtype != np.uint64 and len(a):
            a = a.astype(np.min_scalar_type(int(a.max())), copy=False)
        return a
    return ZstdCompressor(level=1).compress(pickle.dumps([small(a) for a in arrays], 5))


def unpack(blob: bytes) -> list[np.ndarray]:
    from zstandard import ZstdDecompressor
    return pickle.loads(ZstdDecompressor().decompress(bytes(blob)))


def discounted(counts_of_counts: np.ndarray) -> np.ndarray:
    """r* for r = 0 .. K (0 for r = 0) from n_1 .. n_(K+1); absolute discounting where Good-Turing gives no valid value."""
    n = np.concatenate([[0], counts_of_counts]).astype(float)
    r = np.arange(K + 1, dtype=float)
    if (n[1:] > 0).all():
        a = (K + 1) * n[K + 1] / n[1]
        if a < 1:
            d = np.array([((i + 1) * n[i + 1] / (i * n[i]) - a) / (1 - a) for i in range(1, K + 1)])
            if ((d > 0) & (d < 1)).all():
                return np.concatenate([[0], d * r[1:]])
    cut = min(0.9, max(0.1, n[1] / (n[1] + 2 * n[2]))) if n[1] else 0.5
    return np.concatenate([[0], r[1:] - cut])


def stars(r: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Discounted counts."""
    return np.where(r <= K, low[np.minimum(r, K)], r - EPS)


def _sources(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    own = F.col(id_col).cast("string")
    held = F.pmod(F.crc32(F.coalesce(own, F.lit(""))), F.lit(5)) == 1
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held"), F.col(text_col).alias("_t"))


def _tokens(t):
    """Histories, words and text index of every token of a slice, the end marks included."""
    w = t.words()
    h = w.hashes()
    at = w.at[1:]  # an end mark after each text's last word
    word = np.insert(h, at, END)
    doc = np.insert(w.doc, at, np.arange(t.n))
    before = np.empty_like(word)
    before[1:] = word[:-1]
    before[np.concatenate([[0], np.flatnonzero(doc[1:] != doc[:-1]) + 1])] = START
    return before, word, doc


def _pieces(column):
    """(first text, texts, histories, words, text index) of runs of about SLICE_BYTES, hashed in smaller slices."""
    held, size, first, n = [], 0, 0, 0
    for t in slices(column):
        before, word, doc = _tokens(t)
        held.append((before, word, doc + n))
        size, n = size + len(t.data), n + t.n
        if size >= SLICE_BYTES:
            yield first, n, *map(np.concatenate, zip(*held))
            held, size, first, n = [], 0, first + n, 0
    if held:
        yield first, n, *map(np.concatenate, zip(*held))


def word_counts(src: DataFrame) -> DataFrame:
    """w, c: training count of every word and of the end mark."""
    def run(batches):
        for b in batches:
            train = ~b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for first, n, _, word, doc in _pieces(b.column(2)):
                u, c = np.unique(word[train[first:first + n][doc]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(c)], names=["w", "c"])

    return src.mapInArrow(run, "w long, c long").groupBy("w").agg(F.sum("c").alias("c"))


class Model:
    """What every task knows: sizes, unigram discounts, frequent words; all of fixed or bounded size."""

    def __init__(self, n: int, v: int, low: np.ndarray, mass: float, hot: np.ndarray, hot_count: np.ndarray, bits: int):
        self.n, self.v, self.low, self.unknown, self.hot, self.hot_count, self.bits = n, v, low, mass, hot, hot_count, bits

    def is_hot(self, w: np.ndarray) -> np.ndarray:
        return np.isin(w, self.hot)

    def bucket(self, w: np.ndarray, spread: np.ndarray) -> np.ndarray:
        """Bucket by word; frequent words by ``spread`` as well."""
        key = np.where(self.is_hot(w), mix64(w ^ mix64(spread)), mix64(w))
        return (key >> np.uint64(64 - self.bits)).astype(np.int64)

    def p1(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, stars(c, self.low) / max(1, self.n), self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.n + 0.5 * (self.v + 1)))


def _places(src: DataFrame, model, turn: int, rounds: int) -> DataFrame:
    """bucket, slice, blob: packed places of every ``rounds``-th bucket; bucket -1: the slice's texts (first round)."""
    def run(batches):
        from pyspark import TaskContext
        m = model.value
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            train = ~b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for first, n, before, word, doc in _pieces(b.column(2)):
                own = train[first:first + n]
                ids = b.column(0).slice(first, n)
                out = [(-1, pack(ids.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64), ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64),
                                 (~own).astype(np.int64), np.bincount(doc, minlength=n)))] if turn == 0 else []
                bucket = m.bucket(word, before)
                mark = doc * 2 + own[doc]
                if rounds > 1:
                    use = bucket % rounds == turn
                    word, before, mark, bucket = word[use], before[use], mark[use], bucket[use]
                order = np.argsort((bucket.astype(np.uint64) << np.uint64(64 - m.bits)) | (mix64(word ^ mix64(before)) >> np.uint64(m.bits)))
                cuts = np.searchsorted(bucket[order], np.arange((1 << m.bits) + 1))
                for i, (x, y) in enumerate(zip(cuts, cuts[1:])):
                    if x < y:
                        pick = order[x:y]
                        w, wi = np.unique(word[pick], return_inverse=True)
                        h, hi = np.unique(before[pick], return_inverse=True)
                        out.append((i, pack(w, wi, h, hi, mark[pick])))
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.int64()), pa.array([number] * len(out), pa.int64()), pa.array([x for _, x in out], pa.binary())],
                                                 names=["bucket", "slice", "blob"])
                number += 1

    return src.mapInArrow(run, "bucket long, slice long, blob binary")


def _count_bucket(model):
    """One bucket's places to rows (kind, key, blob)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        m = model.value
        if pdf["bucket"].iloc[0] < 0:
            return pd.DataFrame({"kind": "head", "key": pdf["slice"], "blob": pdf["blob"]})
        words, befores, texts, trains = [], [], [], []
        for i, blob in enumerate(pdf["blob"]):
            w, wi, h, hi, mark = unpack(blob)
            words.append(w[wi])
            befores.append(h[hi])
            texts.append((np.int64(i) << np.int64(32)) | (mark >> 1).astype(np.int64))
            trains.append((mark & 1).astype(np.int32))
        word, before = np.concatenate(words), np.concatenate(befores)
        del words, befores
        g = mix64(word ^ mix64(before))
        order = np.argsort(g)
        word, before, g = word[order], before[order], g[order]
        text, train = np.concatenate(texts)[order], np.concatenate(trains)[order]
        del texts, trains, order
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        kind = np.cumsum(np.concatenate([[0], g[1:] != g[:-1]]), dtype=np.int32)
        del g
        r = np.add.reduceat(train, first)  # training count of each bigram
        w2, w1 = word[first], before[first]
        own, back = np.unique(w2, return_inverse=True)
        c = np.bincount(back, weights=r, minlength=len(own)).astype(np.int64)
        hot = m.is_hot(own)
        c[hot] = m.hot_count[np.searchsorted(m.hot, own[hot])]
        c = c[back]
        p1 = m.p1(c)
        # Parts of each text.
        seen = r > 0
        local = np.where(seen, np.where(r > K, np.log10(np.maximum(r - EPS, EPS)), 0.0), np.log10(p1))
        local -= np.where((c > 0) & (w2 != END), np.log10(np.maximum(c, 1)), 0.0)
        docs, at = np.unique(text, return_inverse=True)
        total = lambda x: np.bincount(at, weights=x[kind], minlength=len(docs))
        sums = [total((c > 0).astype(float)), total(m.base(c)), total(local), *[total((r == i).astype(float)) for i in range(1, K + 1)]]
        out = []
        part = (docs >> 32).astype(np.int64)
        for i, s in enumerate(pdf["slice"]):
            a, z = np.searchsorted(part, [i, i + 1])
            if a < z:
                x = [v[a:z] for v in sums]
                out.append(("text", s, pack(docs[a:z] & 0xFFFFFFFF, x[0].astype(np.int64), x[1], x[2], *[v.astype(np.int64) for v in x[3:]])))
        coc = np.bincount(np.minimum(r, K + 2), minlength=K + 3)[1:K + 2]
        out.append(("coc", 0, pack(coc)))
        # Sums of each history: bigrams by count up to K, the larger counts' sums, P1.
        h, at = np.unique(w1[seen], return_inverse=True)
        rs, ps = r[seen], p1[seen]
        add = lambda x: np.bincount(at, weights=x, minlength=len(h))
        stat = [h, *[add((rs == i).astype(float)).astype(np.int64) for i in range(1, K + 1)], add(np.where(rs > K, rs, 0)).astype(np.int64), add((rs > K).astype(float)).astype(np.int64), add(ps)]
        often = m.is_hot(h) | (h == START)
        for i in np.flatnonzero(often):
            out.append(("frequent", int(h[i].astype(np.int64)), pack(*[x[i:i + 1] for x in stat])))
        stat = [x[~often] for x in stat]
        to = (mix64(stat[0]) >> np.uint64(64 - m.bits)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        for b, a, z in _runs(to[order]):
            out.append(("history", b, pack(*[x[order[a:z]] for x in stat])))
        # Unseen bigrams by history; those of frequent histories stay with their slice.
        miss = np.flatnonzero(~seen[kind])
        if len(miss):
            h, d = before[miss], text[miss]
            often = m.is_hot(h) | (h == START)
            spread = mix64(d.astype(np.uint64))
            to = (np.where(often, spread, mix64(h)) >> np.uint64(64 - m.bits)).astype(np.int64)
            order = np.lexsort((d, to))
            slots = pdf["slice"].to_numpy()
            for b, a, z in _runs(to[order]):
                pick = order[a:z]
                u, hi = np.unique(h[pick], return_inverse=True)
                s, si = np.unique(slots[d[pick] >> 32], return_inverse=True)
                out.append(("unseen", b, pack(u, hi, s.view(np.uint64), si, d[pick] & 0xFFFFFFFF)))
        return pd.DataFrame(out, columns=["kind", "key", "blob"])

    return run


def _runs(keys: np.ndarray):
    """(key, start, end) of the runs of a sorted array."""
    if len(keys):
        cut = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        for a, z in zip(cut.tolist(), cut[1:].tolist()):
            yield int(keys[a]), a, z


def _history(blobs, low: np.ndarray):
    """Histories and log10 alpha(h) + log10 c(h) from their packed sums."""
    parts = [unpack(b) for b in blobs]
    if not parts:
        return np.empty(0, np.uint64), np.empty(0)
    cols = [np.concatenate([p[i] for p in parts]) for i in range(len(parts[0]))]
    h, at = np.unique(cols[0], return_inverse=True)
    add = lambda x: np.bincount(at, weights=x, minlength=len(h))
    few = [add(x) for x in cols[1:K + 1]]
    large, n_large, p1 = add(cols[K + 1]), add(cols[K + 2]), add(cols[K + 3])
    c = sum((i + 1) * x for i, x in enumerate(few)) + large
    left = sum((i + 1 - low[i + 1]) * x for i, x in enumerate(few)) + EPS * n_large  # discounted from the seen counts: c (1 - sum of seen P)
    return h, np.log10(left) - np.log10(np.maximum(1 - p1, 1e-300))


def _settle(frequent, low):
    """One bucket of histories: its unseen bigrams to rows ('text', slice, blob)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        h, value = _history(pdf.loc[pdf["kind"] == "history", "blob"], low.value)
        fh, fv = frequent.value
        h, value = np.concatenate([h, fh]), np.concatenate([value, fv])
        order = np.argsort(h)
        h, value = h[order], value[order]
        out = []
        for blob in pdf.loc[pdf["kind"] == "unseen", "blob"]:
            u, hi, s, si, d = unpack(blob)
            at = np.minimum(np.searchsorted(h, u), max(0, len(h) - 1))
            known = (h[at] == u) if len(h) else np.zeros(len(u), bool)
            add = np.where(known, value[at] if len(h) else 0.0, 0.0)[hi]  # a history never met in training: alpha is 1
            key, back = np.unique((si.astype(np.int64) << 32) | d.astype(np.int64), return_inverse=True)
            total = np.bincount(back, weights=add, minlength=len(key))
            for i, a, z in _runs(key >> 32):
                out.append((int(s[i].astype(np.int64)), pack(key[a:z] & 0xFFFFFFFF, total[a:z])))
        return pd.DataFrame({"kind": "settled", "key": [k for k, _ in out], "blob": [b for _, b in out]})

    return run


def _finish(model, low, start_count: int):
    """One slice: its heads and parts to scored rows."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        m, lo = model.value, low.value
        ids, null, held, n = unpack(pdf.loc[pdf["kind"] == "head", "blob"].iloc[0])
        known, base, score = np.zeros(len(ids), np.int64), np.zeros(len(ids)), np.full(len(ids), -np.log10(max(1, start_count)))
        with np.errstate(divide="ignore"):
            logs = np.log10(lo)
        for kind, blob in zip(pdf["kind"], pdf["blob"]):
            if kind == "text":
                d, k, b, s, *few = unpack(blob)
                known[d] += k.astype(np.int64)
                base[d] += b
                score[d] += s + sum(x * logs[i + 1] for i, x in enumerate(few))
            elif kind == "settled":
                d, s = unpack(blob)
                score[d] += s
        return pd.DataFrame({"doc_id": pd.array(ids.view(np.int64), "Int64"), "_null": null.astype(bool), "held_out": held.astype(bool), "n_tokens": n.astype(np.int64), "n_known": known,
                             "train_tokens": m.n, "base_score": base, "score": score})

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_buckets: int = MIN_BUCKETS, bucket_tokens: int = BUCKET_TOKENS,
          rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) of every row.

    The buckets are filled in ``rounds`` passes over the texts, so that one pass's share of the packed places
    lies in shuffle files at a time."""
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    src = _sources(docs, id_col, text_col)
    words = saved(word_counts(src), "katz-words")
    total = words.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = int(total["n"] or 0), int(total["v"])
    bits = max(1, (max(min_buckets, n // bucket_tokens) - 1).bit_length())
    few = {r["c"]: r["n"] for r in words.filter(F.col("c") <= K + 1).groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    low1 = discounted(np.array([few.get(i, 0) for i in range(1, K + 2)]))
    # Left-over mass of the unigrams: what the discounts took.
    small = sum(few.values()) - few.get(K + 1, 0)
    mass = (sum(few.get(i, 0) * (i - low1[i]) for i in range(1, K + 1)) + EPS * (v - small)) / n if n else 1.0
    often = words.filter(F.col("c") * (4 << bits) > n).select("w", "c").toPandas() if n else pd.DataFrame({"w": [], "c": []}, dtype=np.int64)  # fewer than 4 per bucket
    hot = often["w"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hot)
    model = share(Model(n, v, low1, mass, hot[order], often["c"].to_numpy(np.int64)[order], bits))
    end = words.filter(F.col("w") == int(END)).first()
    starts = int(end["c"]) if end else 0

    parts = None
    for turn in range(rounds):
        # Heads (bucket -1) are dealt out by slice.
        places = _places(src, model, turn, rounds).withColumn("_g", F.when(F.col("bucket") < 0, -1 - F.col("slice")).otherwise(F.col("bucket")))
        part = saved(places.groupBy("_g").applyInPandas(_count_bucket(model), "kind string, key long, blob binary"), "katz-parts", "kind")
        parts = part if parts is None else parts.unionByName(part)
    coc = np.zeros(K + 1, np.int64)
    for r in parts.filter("kind = 'coc'").toLocalIterator():  # one short row per bucket
        coc += unpack(r["blob"])[0].astype(np.int64)
    low2 = discounted(coc)
    shared_low = share(low2)

    def frequent_sum(pdf: pd.DataFrame) -> pd.DataFrame:
        h, value = _history(pdf["blob"], shared_low.value)
        return pd.DataFrame({"h": h.view(np.int64), "value": value})

    top = parts.filter("kind = 'frequent'").groupBy("key").applyInPandas(frequent_sum, "h long, value double").toPandas()  # fewer than 4 per bucket
    frequent = share((top["h"].to_numpy(np.int64).view(np.uint64), top["value"].to_numpy(float)))
    settled = (parts.filter(F.col("kind").isin("history", "unseen")).groupBy("key").applyInPandas(_settle(frequent, shared_low), "kind string, key long, blob binary"))
    own = parts.filter(F.col("kind").isin("head", "text")).select("kind", "key", "blob").unionByName(settled)
    schema = "doc_id long, _null boolean, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    out = own.groupBy("key").applyInPandas(_finish(model, shared_low, starts), schema)
    return out.select(F.when(~F.col("_null"), F.col("doc_id")).alias("doc_id"), *[c for c in out.columns if c not in ("doc_id", "_null")])
