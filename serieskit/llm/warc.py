"""WARC archives: revisit resolution by payload digest, deduplicated archives, reading them back.

A record is one text row ``header CRLF CRLF payload`` and Spark's text writer puts the
CRLF CRLF that ends a record behind it, so archives are written by Spark's own committer and
a lost executor's attempt leaves nothing behind. Archives are read whole, file by file, and cut by Content-Length.

Defined cases: a null payload is empty; a null url is written as an empty target; line
breaks inside a url are percent-encoded; a null page_id is written as an empty id and never is
an original while its group holds another; rows that repeat the original's page_id and
payload are responses too; other columns are ignored; no rows give an archive without records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from serieskit.llm.common import scratch, small_batches, stored

# Fixed values of the format.
VERSION = "WARC/1.1"
BREAK = "\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

FILE_RECORDS = 5_000
RECORD_FIELDS = "page_id long, url string, record_type string, payload_digest string, refers_to long, payload_bytes long, payload binary, sound boolean"
HEADER_FIELDS = "page_id long, url string, record_type string, payload_digest string, refers_to long, payload_bytes long, sound boolean"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: forty hex digits are four groups of 40 bits, eight base32 digits each."""
    digits = F.sha1(payload.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), CONV32, BASE32)


def headers(pages: DataFrame) -> DataFrame:
    """page_id, payload_digest and payload_bytes of every page."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        base32_sha1(payload).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
    )


def resolve(heads: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Distinct (page_id, payload_digest) that revisit another page, with that page as ``refers_to``.

    Only headers are shuffled. The originals come from a partial maximum per digest; a digest
    with very many copies then meets its original in a join that Spark can split.
    """
    large = heads.where(F.col("payload_bytes") >= min_bytes)
    originals = large.groupBy("payload_digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies")).where("copies > 1 and refers_to is not null").drop("copies")
    copies = large.select("page_id", "payload_digest").distinct()
    return copies.join(originals, "payload_digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "payload_digest", "refers_to")


def _urn(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))


def record(date: str) -> Column:
    """One record as text, with fresh headers."""
    payload = F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(""))
    target = F.replace(F.replace(F.coalesce(F.col("url"), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.when(F.col("refers_to").isNull(), F.lit("response")).otherwise(F.lit("revisit"))),
        F.concat(F.lit("WARC-Record-ID: "), _urn(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), target),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(F.col("refers_to").isNotNull(), F.concat(F.lit("WARC-Refers-To: "), _urn(F.col("refers_to")), F.lit(f"{BREAK}WARC-Profile: {REVISIT_PROFILE}"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(payload)),
    ]
    return F.concat(F.concat_ws(BREAK, *lines), F.lit(BREAK * 2), payload)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write every page as a response or, where another page holds the same payload, as a revisit of it."""
    revisits = resolve(headers(pages), min_bytes).withColumnRenamed("page_id", "_page").withColumnRenamed("payload_digest", "_digest")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html"), F.lit("")).alias("payload"))
    rows = rows.withColumn("payload_digest", base32_sha1(F.col("payload")))
    joined = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("payload_digest") == F.col("_digest")), "left")
    joined.select(record(date).alias("value")).write.option("lineSep", BREAK * 2).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


def cut_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and payload of every record of an open archive."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            head[name.decode().lower()] = value.strip().decode()
        size = int(head["content-length"])
        payload = stream.read(size)
        if len(payload) != size:
            raise ValueError("a record ends before its Content-Length")
        yield head, payload


def _page(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").rstrip(">")
    return int(digits) if digits else None


def _read(with_payload: bool, batch_records: int = 500):
    names = [f.split()[0] for f in (RECORD_FIELDS if with_payload else HEADER_FIELDS).split(", ")]
    kinds = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary(), "sound": pa.bool_()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def read(batches):
        for batch in batches:
            for content in batch.column("content"):
                raw = content.as_buffer()
                stream = pa.BufferReader(raw)
                packed = raw.size >= 2 and raw[0:2].to_pybytes() == b"\x1f\x8b"
                rows = []
                for head, payload in cut_records(io.BufferedReader(gzip.GzipFile(fileobj=stream)) if packed else stream):
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    kind, said = head["warc-type"], head.get("warc-payload-digest", "").removeprefix("sha1:")
                    response = kind == "response"
                    row = {
                        "page_id": _page(head["warc-record-id"]), "url": head.get("warc-target-uri"), "record_type": kind,
                        "payload_digest": digest if response else said, "refers_to": _page(head.get("warc-refers-to")),
                        "payload_bytes": len(payload) if response else None, "payload": payload if response else None,
                        "sound": not response or digest == said,
                    }
                    rows.append({n: row[n] for n in names})
                    if len(rows) >= batch_records:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return read


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Records of all archives under ``path``; revisits have no payload and no size of their own yet."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_read(with_payload), RECORD_FIELDS if with_payload else HEADER_FIELDS)


def join_revisits(records: DataFrame) -> DataFrame:
    """Give every revisit the size (and payload, if read) of the response it refers to."""
    carried = [c for c in ("payload_bytes", "payload") if c in records.columns]
    own = records.where("record_type = 'response'")
    originals = own.dropDuplicates(["page_id", "payload_digest"]).select(F.col("page_id").alias("refers_to"), "payload_digest", *carried)
    revisits = records.where("record_type = 'revisit'").drop(*carried).join(originals, ["refers_to", "payload_digest"], "left")
    return own.unionByName(revisits.select(*own.columns))


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the archives into the shared folder, read them back, and join revisits to their responses."""
    small_batches(spark)
    path = scratch(spark, "warc")
    write_archives(pages, path, min_bytes)
    return join_revisits(stored(read_archives(spark, path), "warc-heads"))
