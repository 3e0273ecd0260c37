"""WARC round trips, revisit rule and hostile payloads."""

import hashlib

from pyspark.sql import functions as F

from parcelle.llm import warc
from parcelle.session import scratch_path

LONG = "<html>" + "é" * 60 + "</html>"
PAGES = [(5, "http://a/1", LONG), (3, "http://a/2", LONG), (9, "http://a/3\r\nWARC-Type: x", LONG), (1, None, "short"), (2, "http://a", "short"), (4, "u", None), (6, "u", ""),
         (7, "u", "x" * 99), (8, "u", "x" * 99), (10, "u", "y" * 100), (11, "u", "y" * 100), (12, "u", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 5), (13, "u", "z" * 300_000),
         (None, "n", LONG), (14, "v", "only null" * 20), (20, "same", "repeat " * 30), (20, "same", "repeat " * 30)]
SCHEMA = "page_id long, url string, html string"


def brute(pages):
    out, groups = [], {}
    for i, (p, _, h) in enumerate(pages):
        b = (h or "").encode()
        groups.setdefault(b, []).append((p is None, p or 0, i))
    for i, (p, _, h) in enumerate(pages):
        b = (h or "").encode()
        first = min(groups[b])
        revisit = len(b) >= 100 and first[2] != i
        out.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", first[1] if revisit else None))
    return sorted(out, key=str)


def test_archive_equals_brute_force(spark):
    df = spark.createDataFrame(PAGES, SCHEMA).withColumn("digest", F.lit("own")).withColumn("payload", F.lit(1)).repartition(3)
    out, path = warc.crawl_to_archive(df)
    assert sorted((tuple(r) for r in out.collect()), key=str) == brute(PAGES)
    back = warc.read_warc(spark, path).collect()
    by_id = {r.record_id: r for r in back if r.warc_type == "response"}
    for r in back:
        if r.warc_type == "revisit":
            assert r.payload == "" and by_id[r.refers_to_id].digest == r.digest and by_id[r.refers_to_id].payload
        else:
            assert hashlib.sha256(r.payload.encode()).hexdigest() == r.digest


def test_exact_round_trip_of_payloads(spark):
    df = spark.createDataFrame(PAGES, SCHEMA)
    path = scratch_path(spark, "warc-test")
    warc.write_warc(warc.from_pages(df), path, records_per_file=3)
    got = sorted(((r.page_id, r.payload) for r in warc.read_warc(spark, path).collect()), key=str)
    assert got == sorted(((p, h or "") for p, _, h in PAGES), key=str)


def test_several_members_and_small_chunks():
    import gzip
    one = b"WARC/1.1\r\nContent-Length: 5\r\n\r\nab\r\ncd"[:-1] + b"\r\n\r\n"
    data = gzip.compress(one) + gzip.compress(one)
    assert [b for _, b in warc.parse(warc._inflated(data, 3), True)] == ["ab\r\nc"] * 2


def test_empty_table(spark):
    out, _ = warc.crawl_to_archive(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0
