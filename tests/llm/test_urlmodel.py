"""URL filter: host, path and rule against plain code, the model against a dictionary model, held-out accuracy."""

import math
from collections import Counter

from pyspark.sql import functions as F

from parcelle.llm import urlmodel


def plain(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
    path = rest[n:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fit = [(len(h + p), h + p, v) for v, h, p in urlmodel.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


URLS = [None, "", "no scheme", "http://", "HTTP://A.Org", "http://a.ORG/x", "https://Example.org/es/1?x=://y", "http://x.example.org/en/17#f", "http://org/", "http://xorg/", "ftp://a.com/fr/ü",
        "http://a.com/de/", "http://a.com?/fr/", "http://ÀB.net/\n/fr", "://com/fr/", "a://b://c/d", "http://a.net/" + "long/" * 8000, "http://a.com/fr/", "http://a.com/fr/"]


def test_host_path_rule(spark):
    df = spark.createDataFrame([(i if i else None, u) for i, u in enumerate(URLS)], "page_id long, url string").withColumn("host", F.lit(1)).withColumn("_uid", F.lit(2))
    rows = urlmodel.judge(df).collect()
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in rows), key=str) == sorted(((i if i else None, *plain(u)[:3]) for i, u in enumerate(URLS)), key=str)
    assert all(r.verdict in ("allow", "block") for r in rows)
    assert all(r.verdict == plain(URLS[r.page_id or 0])[3] for r in rows if r.rule)
    assert urlmodel.judge(df.limit(0)).count() == 0


def test_model_equals_a_dictionary_model(spark):
    good, bad = ["abcab.org/", "abd"], ["zzz/de", "abz"]
    order, a = 3, 4.0
    grams = lambda s: ["^^^abc"[0:0] + ("^" * order + s)[i:i + order + 1] for i in range(len(s))]
    rows = Counter(), Counter()
    for side, texts in enumerate((good, bad)):
        for s in texts:
            rows[side].update(grams(s))
    table = [(g, rows[0][g], rows[1][g]) for g in {*rows[0], *rows[1], "qqqq"}]
    got = {r.gram: r.ratio for r in urlmodel.log_ratios(spark.createDataFrame(table, "gram string, good long, bad long"), order, a).collect()}

    def prob(n, g):
        p = 1 / 40
        for k in range(order + 1):
            own = g[order - k:]
            p = (sum(c for x, c in n.items() if x.endswith(own)) + a * p) / (sum(c for x, c in n.items() if x[order - k:order] == own[:-1]) + a)
        return p
    for g, _, _ in table:
        assert math.isclose(got[g], math.log(prob(rows[0], g) / prob(rows[1], g)), rel_tol=1e-9)


def test_held_out_rule_urls_are_told_apart(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    held = pages.select("page_id", urlmodel.split_url(F.col("url"))[2].alias("rest")).filter(F.pmod(F.xxhash64("rest"), F.lit(urlmodel.FOLDS)) == 0)
    rows = urlmodel.judge(pages).join(held, "page_id").withColumn("said", urlmodel.rule_of(F.col("host"), F.col("path"))[1]).filter("said IS NOT NULL").toPandas()
    good, bad = rows[rows.said == "allow"].score, rows[rows.said == "block"].score
    assert len(bad) > 20 and (good.to_numpy()[:, None] > bad.to_numpy()).mean() > 0.9


def test_no_python_in_the_plan(spark):
    from conftest import SF_SMALL
    plan = urlmodel.judge(spark.read.parquet(f"{SF_SMALL}/pages.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "html" not in plan.split("== Physical Plan ==")[1]


def test_one_labelled_class_allows_the_rest(spark):
    from parcelle.llm import urlmodel
    rows = [(i, f"http://a{i}.org/x") for i in range(60)] + [(100 + i, f"http://b{i}.net/y") for i in range(5)] + [(None, None)]
    out = urlmodel.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert len(out) == 66 and all(r.verdict == "allow" and r.score == 0 for r in out)
