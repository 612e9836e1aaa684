"""WARC archives: write captures, read them back, assemble transactions.

A capture is three records: ``request``, ``response`` (or ``revisit``, when an
earlier capture holds an equal payload) and ``metadata``; request and metadata
name the response in ``WARC-Concurrent-To``.  Archives are ordinary WARC/1.1
text with gzip, written by Spark's text writer: every row is one record and the
line separator is the two CRLF that end a record.

Reading: each archive is one binary row, split by ``Content-Length`` (a payload
may hold anything, record headers included); archives are bounded by the rows
and bytes of their write task.  Assembly: request and metadata records join
their response through the concurrent-to identifier, a revisit takes its
payload's facts from the record it refers to, and one nested row per capture
comes out.

Of records with equal payloads (equal SHA-1 and length) of at least
``min_bytes`` bytes the one with the smallest page id is the response; the
others revisit it and carry no payload.  The smallest id is a pre-aggregated
minimum, so a payload in a third of all rows is one row there, and its join is
a sort-merge join that Spark splits.

Defined results: null html is an empty payload; null URL is an empty target;
null page ids are void as ids: such rows are written as responses that nothing
refers to.  Repeated page ids are separate captures (record ids carry a row
number).  Empty tables give no archive rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.session import ensure_checkpoint_dir

CRLF = "\r\n"
END = "\r\n\r\n"
VERSION = "WARC/1.1"
ARCHIVE_ROWS = 1500         # records in one archive file at most
DATE = "2000-01-01T00:00:00Z"

RECORD = ("file string, type string, id string, concurrent_to string, refers_to string, target string, "
          "digest string, page string, length long, payload binary")


def base32_sha1(hex_digest: Column) -> Column:
    """Base32 (upper case, no padding needed) of a SHA-1 in hexadecimal: 40 bits at a time."""
    quads = [F.lpad(F.conv(F.substring(hex_digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*quads), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record(kind: Column, fields: list[tuple[str, Column]], body: Column) -> Column:
    """One record without its final CRLF CRLF; null fields are left out."""
    lines = [F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")) for name, value in fields]
    return F.concat(F.lit(f"{VERSION}{CRLF}WARC-Type: "), kind, F.lit(CRLF), *lines,
                    F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit(END), body)


def write_archives(pages: DataFrame, path: str, page: str = "page_id", url: str = "url", html: str = "html",
                   min_bytes: int = 0, rows: int = ARCHIVE_ROWS) -> None:
    """Write request, response/revisit and metadata records of every row under ``path`` (gzip)."""
    p = pages.select(F.col(f"`{page}`").alias("page"),
                     F.regexp_replace(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"[\r\n]+", " ").alias("url"),
                     F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("body"))
    p = p.withColumn("len", F.octet_length("body")).withColumn("sha", F.sha1(F.col("body").cast("binary")))
    first = (p.where(F.col("page").isNotNull() & (F.col("len") >= min_bytes))
             .groupBy("sha", "len").agg(F.min("page").alias("first"))
             .select(F.col("sha").alias("fsha"), F.col("len").alias("flen"), "first"))
    p = p.withColumn("row", F.monotonically_increasing_id())
    p = p.join(first, (F.col("sha") == F.col("fsha")) & (F.col("len") == F.col("flen")), "left")
    revisit = F.col("first").isNotNull() & F.col("page").isNotNull() & (F.col("page") != F.col("first"))
    digest = F.concat(F.lit("sha1:"), base32_sha1(F.col("sha")))
    own = F.concat(F.lit("<urn:capture:"), F.coalesce(F.col("page").cast("string"), F.lit("none")),
                   F.lit(":"), F.col("row").cast("string"))
    rid = F.concat(own, F.lit(":response>"))
    page_text = F.col("page").cast("string")
    common = [("WARC-Date", F.lit(DATE)), ("WARC-Target-URI", F.col("url")), ("X-Page-Id", page_text)]
    request = _record(F.lit("request"), [("WARC-Record-ID", F.concat(own, F.lit(":request>"))),
                                         ("WARC-Concurrent-To", rid), *common],
                      F.concat(F.lit("GET "), F.col("url"), F.lit(f" HTTP/1.1{END}")))
    response = _record(F.when(revisit, "revisit").otherwise("response"),
                       [("WARC-Record-ID", rid),
                        ("WARC-Refers-To", F.when(revisit, F.col("first").cast("string"))),
                        ("WARC-Payload-Digest", digest), *common],
                       F.when(revisit, F.lit("")).otherwise(F.col("body")))
    meta = _record(F.lit("metadata"), [("WARC-Record-ID", F.concat(own, F.lit(":metadata>"))),
                                       ("WARC-Concurrent-To", rid), *common],
                   F.concat(F.lit("payload-length: "), F.col("len").cast("string")))
    (p.select(F.explode(F.array(request, response, meta)).alias("value"))
     .write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", rows).text(path))


def _unzip(blob: bytes) -> bytes:
    """All gzip members of an archive."""
    out, rest = [], blob
    while rest:
        z = zlib.decompressobj(31)
        out.append(z.decompress(rest) + z.flush())
        rest = z.unused_data
    return b"".join(out)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, payload) of each record; names in lower case."""
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        lines = data[at:head_end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        begin = head_end + 4
        end = begin + int(head["content-length"])
        yield head, data[begin:end]
        at = end + 4


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record (``RECORD``) of the gzip archives under ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")

    def split(batches):
        for batch in batches:
            for name, blob in zip(batch.column("path"), batch.column("content")):
                found, held = [], 0

                def emit(rows):
                    return pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), [pa.string()] * 8 + [pa.int64(), pa.binary()])],
                        ["file", "type", "id", "concurrent_to", "refers_to", "target", "digest", "page", "length", "payload"])

                for h, body in parse_records(_unzip(blob.as_py())):
                    found.append((name.as_py(), h.get("warc-type"), h.get("warc-record-id"), h.get("warc-concurrent-to"),
                                  h.get("warc-refers-to"), h.get("warc-target-uri"), h.get("warc-payload-digest"),
                                  h.get("x-page-id"), len(body), body))
                    held += len(body)
                    if held > 4_000_000:
                        yield emit(found)
                        found, held = [], 0
                if found:
                    yield emit(found)

    return files.mapInArrow(split, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: page, request, response, metadata, payload_bytes, payload_digest,
    record_type, refers_to."""
    resp = records.where(F.col("type").isin("response", "revisit")).select(
        F.col("id").alias("rid"), F.col("page").cast("long").alias("page"), F.col("type").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
        F.struct("id", "target", "digest", "length", F.sha1("payload").alias("sha")).alias("response"))
    side = {}
    for kind in ("request", "metadata"):
        side[kind] = records.where(F.col("type") == kind).select(
            F.col("concurrent_to").alias(f"{kind}_to"), F.struct("id", "target", "length", "payload").alias(kind))
    out = resp
    for kind, df in side.items():
        out = out.join(df, F.col("rid") == F.col(f"{kind}_to"), "left").drop(f"{kind}_to")
    # a revisit's payload is the one of the record it refers to (ids may repeat: those payloads are equal)
    whole = (resp.where("record_type = 'response' AND page IS NOT NULL")
             .groupBy(F.col("page").alias("fpage"), F.col("response.digest").alias("fdigest"))
             .agg(F.max(F.struct("response.length", "response.sha")).alias("full")))
    out = out.join(whole, (F.col("refers_to") == F.col("fpage")) & (F.col("response.digest") == F.col("fdigest")), "left")
    revisit = F.col("record_type") == "revisit"
    sha = F.when(revisit, F.col("full.sha")).otherwise(F.col("response.sha"))
    return out.select("page", "request", "response", "metadata",
                      F.when(revisit, F.col("full.length")).otherwise(F.col("response.length")).alias("payload_bytes"),
                      base32_sha1(sha).alias("payload_digest"), "record_type", "refers_to")


def round_trip(pages: DataFrame, **names) -> DataFrame:
    """Write ``pages`` as archives into the shared folder, read them back and assemble the captures."""
    import uuid
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, **names)
    return assemble(read_records(spark, path))
