"""WARC archives and revisit resolution (operator 2).

Writing: one record per row, as text files whose rows are joined by the record separator
(CRLF CRLF), gzip-compressed by Spark's own writer, so any file system Spark knows will do.  Every record
has fresh headers (type, id, date, target, digests, length).  A file holds at most ``records_per_file``
records.

Reading: the files come as bytes, one at a time; a task walks a file record by record by
Content-Length while it is inflated, so a payload that itself looks like a record cannot mislead
the reader.

Revisits: only headers are shuffled, by payload digest.  Of the records with one digest and at least
``least_bytes`` bytes the one with the smallest page id stays a response, the others revisit it; a
digest shared by a third of the pages is one small group after partial aggregation, and the join
back is a join that adaptive execution splits.  The deduplicated archive is written with fresh headers:
a revisit has no payload but names its response (WARC-Refers-To) and the payload's digest.
``resolve`` joins the revisit records of an archive to their originals again.

Defined results: a null payload is written as empty; payloads under ``least_bytes`` are responses
each; a null page id is written as its own record without a page and comes back null, is the last
choice as a response and never the page that a revisit names (an unnamed response refers by record id only); a page id
met twice with one payload makes two records, of which one is the response; an empty table gives an empty archive.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.session import checkpoint_dir, scratch_path

LEAST_BYTES = 100
RECORDS_PER_FILE = 4000
#: The WARC/1.1 revisit profile.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
FIELDS = "warc_type string, record_id string, page_id long, target string, digest string, n_bytes long, refers_to_id string, refers_to_page long, payload string"


def _header(name: str, value: Column) -> Column:
    """A header line, left out where the value is null."""
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF))).otherwise("")


def record(date: str) -> Column:
    """The text of a record, from the columns of FIELDS (payload empty for a revisit)."""
    revisit = F.col("warc_type") == "revisit"
    block = F.when(revisit, "").otherwise(F.coalesce("payload", F.lit("")))
    target = F.regexp_replace("target", r"[\r\n]", "%0A")
    return F.concat(
        F.lit("WARC/1.1" + CRLF), _header("WARC-Type", F.col("warc_type")), _header("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        _header("WARC-Date", F.lit(date)), _header("WARC-Target-URI", target), _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _header("WARC-Profile", F.when(revisit, F.lit(PROFILE))), _header("WARC-Refers-To", F.when(F.col("refers_to_id").isNotNull(), F.concat(F.lit("<"), F.col("refers_to_id"), F.lit(">")))),
        _header("X-Page-ID", F.col("page_id")), _header("X-Refers-To-Page-ID", F.col("refers_to_page")), _header("X-Payload-Length", F.col("n_bytes")),
        _header("Content-Type", F.lit("text/html; charset=utf-8")), _header("Content-Length", F.octet_length(block)), F.lit(CRLF), block)


def write_warc(records: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z", records_per_file: int = RECORDS_PER_FILE) -> None:
    (records.select(record(date).alias("value")).write.option("lineSep", CRLF + CRLF).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def from_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Response records of all rows; the record id is a name-based one of page, url, payload and place (so repeats differ)."""
    p = F.coalesce(F.col(payload_col), F.lit(""))
    return pages.select(F.lit("response").alias("warc_type"), F.sha2(p, 256).alias("digest"), F.octet_length(p).cast("long").alias("n_bytes"),
                        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("target"), p.alias("payload")).select(
        "warc_type", _record_id("response", F.monotonically_increasing_id().cast("string")).alias("record_id"), "page_id", "target", "digest", "n_bytes",
        F.lit(None).cast("string").alias("refers_to_id"), F.lit(None).cast("long").alias("refers_to_page"), "payload")


def _record_id(kind: str, *more: Column) -> Column:
    h = F.sha2(F.concat_ws("|", F.lit(kind), F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.coalesce("target", F.lit("-")), F.col("digest"), *more), 256)
    return F.concat(F.lit("urn:uuid:"), *[x for i, (a, n) in enumerate(((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) for x in ([F.lit("-")] if i else []) + [F.substring(h, a, n)]])


def parse(chunks, payloads: bool):
    """Records of one inflated file, given as byte chunks: (headers, payload or None), by Content-Length."""
    buf = bytearray()
    chunks = iter(chunks)

    def fill(until) -> bool:
        while not until():
            more = next(chunks, None)
            if more is None:
                return until()
            buf.extend(more)
        return True

    while True:
        while fill(lambda: len(buf) >= 4) and buf[:4] == b"\r\n\r\n":
            del buf[:4]
        if not buf:
            return
        if not fill(lambda: b"\r\n\r\n" in buf):
            raise ValueError("a record without end of headers")
        end = buf.index(b"\r\n\r\n")
        first, *lines = bytes(buf[:end]).decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a record: {first[:40]!r}")
        head = dict(x.split(": ", 1) for x in lines)
        n = int(head["Content-Length"])
        del buf[:end + 4]
        if not fill(lambda: len(buf) >= n):
            raise ValueError("a record is cut short")
        yield head, bytes(buf[:n]).decode() if payloads else None
        del buf[:n]


def _inflated(data: bytes, step: int = 1 << 20):
    """The bytes of a gzip file of one or more members, a megabyte at a time."""
    data = memoryview(data)
    while len(data):
        z = zlib.decompressobj(31)
        rest = data
        while not z.eof and len(rest):
            out = z.decompress(rest, step)
            rest = z.unconsumed_tail
            if out:
                yield out
        if not z.eof:
            raise ValueError("a gzip file is cut short")
        data = memoryview(z.unused_data)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records below ``path``, in the columns of FIELDS (without payload: headers only)."""
    schema = FIELDS if payloads else FIELDS.rsplit(", ", 1)[0]
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64() if x.endswith(" long") else pa.string() for x in schema.split(", ")]

    def rows(data):
        number = lambda s: int(s) if s is not None else None
        strip = lambda s: s[1:-1] if s is not None else None
        for h, body in parse(_inflated(data), payloads):
            yield (h["WARC-Type"], strip(h["WARC-Record-ID"]), number(h.get("X-Page-ID")), h.get("WARC-Target-URI"), h["WARC-Payload-Digest"].removeprefix("sha256:"),
                   number(h.get("X-Payload-Length")), strip(h.get("WARC-Refers-To")), number(h.get("X-Refers-To-Page-ID")), body)[:len(names)]

    def batch(part):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], names=names)

    def run(batches):
        for b in batches:
            for data in b.column(0):
                part, size = [], 0
                for r in rows(data.as_buffer()):
                    part.append(r)
                    size += len(r[-1] or "") if payloads else 100
                    if size > 4 << 20:
                        yield batch(part)
                        part, size = [], 0
                if part:
                    yield batch(part)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def originals(headers: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """digest, page and record id of the response of every digest of at least ``least_bytes`` bytes met twice or more."""
    order = F.struct(F.col("page_id").isNull().alias("z"), F.col("page_id").alias("page"), F.col("record_id").alias("id"))
    return (headers.filter((F.col("warc_type") == "response") & (F.col("n_bytes") >= least_bytes)).groupBy("digest")
            .agg(F.count(F.lit(1)).alias("copies"), F.min(order).alias("o")).filter("copies > 1")
            .select("digest", F.col("o.page").alias("o_page"), F.col("o.id").alias("o_id")))


def deduplicated(records: DataFrame, least_bytes: int = LEAST_BYTES, headers: DataFrame | None = None) -> DataFrame:
    """The records with all but one response per payload as revisits without payload and with fresh headers."""
    first = originals(records if headers is None else headers, least_bytes)
    rows = records.join(first, "digest", "left")
    revisit = (F.col("warc_type") == "response") & F.col("o_id").isNotNull() & (F.col("record_id") != F.col("o_id"))
    return rows.select(F.when(revisit, "revisit").otherwise(F.col("warc_type")).alias("warc_type"),
                       F.when(revisit, _record_id("revisit", F.col("record_id"))).otherwise(F.col("record_id")).alias("record_id"), "page_id", "target", "digest", "n_bytes",
                       F.when(revisit, F.col("o_id")).otherwise(F.col("refers_to_id")).alias("refers_to_id"),
                       F.when(revisit, F.col("o_page")).otherwise(F.col("refers_to_page")).alias("refers_to_page"),
                       *([F.when(revisit, F.lit("")).otherwise(F.col("payload")).alias("payload")] if "payload" in records.columns else []))


def resolve(headers: DataFrame) -> DataFrame:
    """Every record with its original: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Revisits take length and page of the response with their digest; one without it keeps what its own header says."""
    kept = headers.filter(F.col("warc_type") == "response").groupBy("digest").agg(F.max("n_bytes").alias("o_bytes"), F.min("page_id").alias("o_page"))
    back = headers.filter(F.col("warc_type") == "revisit").join(kept, "digest", "left")
    own = headers.filter(F.col("warc_type") == "response")
    out = lambda d, n, to: d.select("page_id", n.alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("warc_type").alias("record_type"), to.alias("refers_to"))
    return out(own, F.col("n_bytes"), F.lit(None).cast("long")).unionByName(out(back, F.coalesce("o_bytes", "n_bytes"), F.coalesce("o_page", "refers_to_page")))


def crawl_to_archive(pages: DataFrame, **cols) -> tuple[DataFrame, str]:
    """Write ``pages`` as an archive, read it back, write it deduplicated and read that back: (resolved records, its path)."""
    spark = pages.sparkSession
    checkpoint_dir(spark)
    raw, dedup = scratch_path(spark, "warc"), scratch_path(spark, "warc-dedup")
    write_warc(from_pages(pages, **cols), raw)
    write_warc(deduplicated(read_warc(spark, raw), headers=read_warc(spark, raw, payloads=False)), dedup)
    return resolve(read_warc(spark, dedup, payloads=False)), dedup
