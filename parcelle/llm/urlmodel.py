"""URL filter (operator 1): character language-model ratio, DataFrame functions only.

Rules decide what they fit (the longest wins).  The urls they accept and reject train two
variable-order Markov models over characters; any other url is judged by the difference of its log-likelihoods,
divided by its length, against a threshold calibrated on rule-labelled urls that were held out of
training.

The models interpolate all orders up to ``order``: P_k(c | h) = (n(hc) + a P_{k-1}(c | h')) / (n(h) + a), down to
the uniform distribution, so an unseen history falls back by itself to a shorter one.  Characters
are folded to 40 symbols, so there are at most 40**(order + 1) windows (2.56 million for order 3): the
counts of all orders are sums over the window table, made in one pass with map-side combining, and the
table of log ratios has a size bound; it is written once and broadcast to the windows of all urls while its counted size allows.  A
url's windows are explained and averaged inside one task's partial aggregate; the shuffle carries one row per url.

Defined results: a null url or one without ``://`` has empty host and path and is judged as
the empty text (score 0); null ids and repeated rows are judged each; if one class has no labelled url the
scores are 0 and the default verdict is allow; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelle.llm.tables import saved
from parcelle.operators.sizing import maybe_broadcast

#: Fixed values: (verdict, host, path).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
ORDER, STRENGTH = 3, 4.0
FOLDS, STEP, LIMIT = 5, 0.005, 10.0
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789./"  # 38 symbols; a start mark and one for all else make 40
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host (lower-case), path, and all after ``://`` (each empty without one)."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), rest)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def windows(rest: Column, order: int) -> Column:
    """The folded text's windows of order + 1 symbols, one for each character."""
    folded = F.regexp_replace(F.translate(rest, UPPER, LOWER), r"(?s)[^a-z0-9./]", "~")
    return F.regexp_extract_all(F.concat(F.lit("^" * order), folded), F.lit(f"(?s)(?=(.{{{order + 1}}}))"), F.lit(1))


def log_ratios(grams: DataFrame, order: int, strength: float) -> DataFrame:
    """gram, ratio: ln P(c | h) of the accepted model less that of the rejected one, for each gram of the table (gram, good, bad)."""
    t = grams
    p = {"good": F.lit(1.0 / 40), "bad": F.lit(1.0 / 40)}
    for k in range(order + 1):
        own = F.substr("gram", F.lit(order + 1 - k), F.lit(k + 1))  # the last k + 1 symbols
        t = t.withColumn("_w", own).withColumn("_h", F.substr("_w", F.lit(1), F.lit(k)))
        for c in ("good", "bad"):
            n, of = F.sum(c).over(Window.partitionBy("_w")), F.sum(c).over(Window.partitionBy("_h"))
            t = t.withColumn(f"_{c}", (n + strength * p[c]) / (of + strength))
            p[c] = F.col(f"_{c}")
    return t.select("gram", (F.ln("_good") - F.ln("_bad")).alias("ratio"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, order: int = ORDER, strength: float = STRENGTH) -> DataFrame:
    """page_id, host, path, rule, verdict, score (length-normalised log-likelihood ratio) of every url."""
    host, path, rest = split_url(F.col(url_col))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    urls = (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("_url")).select(
        "page_id", *[c.alias(n) for c, n in zip(split_url(F.col("_url")), ("host", "path", "_rest"))])
        .withColumn("rule", rule).withColumn("_said", said).withColumn("_fold", F.pmod(F.xxhash64("_rest"), F.lit(FOLDS))))
    del host, path, rest
    one = lambda v: F.sum(F.when((F.col("_said") == v) & (F.col("_fold") > 0), 1).otherwise(0))
    # Repeated urls are counted before they are cut into windows.
    grams = (urls.groupBy("_rest").agg(one("allow").alias("good"), one("block").alias("bad"))
             .select("good", "bad", F.explode(windows(F.col("_rest"), order)).alias("gram")).groupBy("gram").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")))
    none = urls.select("page_id", "host", "path", "rule", F.coalesce("_said", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("score"))
    seen = urls.agg(F.max(F.col("_said") == "allow").alias("good"), F.max(F.col("_said") == "block").alias("bad")).first()
    if not (seen["good"] and seen["bad"]):
        return none
    ratio = saved(log_ratios(grams, order, strength), "ratio")
    keyed = urls.withColumn("_uid", F.monotonically_increasing_id())
    # At most 40 ** (order + 1) grams; see the docstring.  Broadcast behind a check of their counted size.
    scored = saved(keyed.withColumn("gram", F.explode_outer(windows(F.col("_rest"), order))).join(maybe_broadcast(ratio), "gram", "left")
                   .groupBy("_uid", "page_id", "host", "path", "rule", "_said", "_fold").agg(F.coalesce(F.avg("ratio"), F.lit(0.0)).alias("score")), "scored")
    cut = threshold(scored.filter((F.col("_fold") == 0) & F.col("_said").isNotNull()))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("_said", F.when(F.col("score") >= cut, "allow").otherwise("block")).alias("verdict"), "score")


def threshold(held: DataFrame) -> float:
    """The cut with the best balanced accuracy on held-out labelled urls, in steps of STEP within -LIMIT .. LIMIT (a fixed number of bins)."""
    bins = F.floor(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.col("score"))) / STEP).cast("int")
    n = (held.groupBy(bins.alias("b")).agg(F.count_if(F.col("_said") == "allow").alias("good"), F.count_if(F.col("_said") == "block").alias("bad")))
    w = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)  # at most 4,001 rows
    total = n.agg(F.sum("good").alias("g"), F.sum("bad").alias("z"))
    cut = (n.select("b", F.coalesce(F.sum("good").over(w), F.lit(0)).alias("lost"), F.coalesce(F.sum("bad").over(w), F.lit(0)).alias("gone"))
           .join(F.broadcast(total)).filter("g > 0 AND z > 0").orderBy(F.desc(F.col("gone") / F.col("z") - F.col("lost") / F.col("g")), F.abs("b")).first())
    return cut["b"] * STEP if cut else 0.0
