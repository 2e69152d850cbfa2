"""WARC as a content-addressed archive.

Payloads are stored once under their SHA-256; a second digest and the length verify that one SHA-256
stands for one payload. The exact header of every record is stored apart from it. Records are put
together again by joining the two; written out they are ordinary WARC files (gzip, each about FILE_BYTES of
records), and reading parses them by Content-Length, a record at a time, and checks every digest.

Defined results: a null payload counts as empty; of equal payloads of at least MIN_REVISIT bytes the
record with the least id is the response and the others revisit it, smaller ones are all responses;
a null URL leaves its header line out; line ends in a URL are percent-encoded. Every row is one
record. Rows with a null id, and all rows of the least id of a payload, are responses; where an id is
missing or repeats, the names of all records have the digest and a number besides the id. An empty
table gives an archive without records. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import work_path, written

MIN_REVISIT, RECORDS_A_FILE, FILE_BYTES = 100, 2000, 64_000_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def store(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = MIN_REVISIT) -> None:
    """Write `path`/payloads (digest, payload), one row a digest, and `path`/headers (page_id, digest, record_type, header), one row a page."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8").alias("payload"))
    named = rows.select("page_id", "url", F.octet_length("payload").cast("long").alias("n"), F.sha2("payload", 256).alias("digest"), F.md5("payload").alias("second"))
    firsts = named.groupBy("digest", F.substring("digest", 1, 1).alias("again")).agg(F.min("page_id").alias("first"), F.min("second").alias("a"), F.max("second").alias("b"), F.min("n").alias("c"), F.max("n").alias("d"))
    firsts = firsts.withColumn("first", F.when((F.col("a") == F.col("b")) & (F.col("c") == F.col("d")), F.col("first")).otherwise(F.raise_error(F.lit("two payloads have one SHA-256")).cast("long"))).select("digest", "first")
    told = named.join(firsts, "digest").withColumn("record_type", F.when((F.col("n") >= least) & (F.col("page_id") != F.col("first")), "revisit").otherwise("response"))
    line = lambda name, value: F.concat(F.lit(f"\r\n{name}: "), value)
    if rows.groupBy("page_id").count().where("page_id is null or count > 1").isEmpty():
        told, name = told.withColumn("copy", F.lit(1)), lambda c, copy: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    else:
        told = told.withColumn("copy", F.row_number().over(Window.partitionBy("page_id", "digest").orderBy("url")))
        name = lambda c, copy: F.concat(F.lit("<urn:page:"), F.concat_ws(":", F.coalesce(c.cast("string"), F.lit("")), "digest", copy.cast("string")), F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    header = F.concat(
        F.lit("WARC/1.1"), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", name(F.col("page_id"), F.col("copy"))), line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", name(F.col("first"), F.lit(1))), line("WARC-Profile", F.lit(PROFILE)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html")), line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n").cast("string"))),
    )
    told.select("page_id", "digest", "record_type", header.alias("header"), F.when(revisit, 0).otherwise(F.col("n")).alias("n")).write.parquet(f"{path}/headers")
    rows.select(F.sha2("payload", 256).alias("digest"), "payload").dropDuplicates(["digest"]).write.option("compression", "zstd").parquet(f"{path}/payloads")


def records(spark: SparkSession, path: str) -> DataFrame:
    """Rows (page_id, record): every record as it was, from its header and its payload."""
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    end = F.encode(F.lit("\r\n\r\n"), "UTF-8")
    head = F.encode("header", "UTF-8")
    whole = headers.where("record_type = 'response'").join(payloads, "digest").select("page_id", F.concat(head, end, F.col("payload")).alias("record"))
    return whole.unionByName(headers.where("record_type = 'revisit'").select("page_id", F.concat(head, end).alias("record")))


def records_a_file(spark: SparkSession, path: str) -> int:
    """Records that have about FILE_BYTES together, RECORDS_A_FILE at most."""
    mean = spark.read.parquet(f"{path}/headers").agg(F.avg(F.col("n") + F.length("header"))).first()[0]
    return max(1, min(RECORDS_A_FILE, int(FILE_BYTES / mean))) if mean else RECORDS_A_FILE


def write_files(found: DataFrame, path: str, a_file: int = RECORDS_A_FILE) -> None:
    """WARC files of records: the line end that Spark's text writer puts after each is the end of a WARC record."""
    found.select(F.col("record").cast("string")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", a_file).text(path)


def parsed(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an unpacked WARC file."""
    number = 0
    while line := stream.readline():
        number += 1
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"record {number} doesn't start as one of WARC")
        headers = {}
        while (line := stream.readline()) != b"\r\n":
            if not line:
                raise ValueError(f"record {number} ends in its header")
            name, value = line.decode().removesuffix("\r\n").split(": ", 1)
            headers[name] = value
        size = int(headers["Content-Length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {number} doesn't end where its length says")
        yield headers, block


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows (page_id, copy, record_type, refers_to, digest, n) of the records in the files; digests are computed from the blocks, and checked. `copy` numbers the rows of one id and payload."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = lambda name: name.removeprefix("<urn:page:").removesuffix(">").split(":")
        number = lambda name: int(parts(name)[0]) if parts(name)[0] else None
        copy = lambda name: int(parts(name)[2]) if len(parts(name)) > 1 else 1
        for batch in batches:
            rows = []
            for content in batch.column(0):
                for headers, block in parsed(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))):
                    digest, response = headers["WARC-Payload-Digest"].removeprefix("sha256:"), headers["WARC-Type"] == "response"
                    if response and hashlib.sha256(block).hexdigest() != digest:
                        raise ValueError(f"{headers['WARC-Record-ID']}: the payload isn't what its digest says")
                    rows.append((number(headers["WARC-Record-ID"]), copy(headers["WARC-Record-ID"]), headers["WARC-Type"], None if response else number(headers["WARC-Refers-To"]), digest, len(block) if response else None))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 6, kinds, strict=True)], ["page_id", "copy", "record_type", "refers_to", "digest", "n"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(work, "page_id long, copy long, record_type string, refers_to long, digest string, n long")


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = MIN_REVISIT) -> DataFrame:
    """Archive `pages`, write the records to WARC files, read them: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A revisit's payload is that of the response it refers to.
    """
    spark = pages.sparkSession
    path = work_path(spark, "warc")
    store(pages, path, page_id, url, payload, least)
    write_files(records(spark, path), f"{path}/files", records_a_file(spark, path))
    # what was read is small next to the files, which are parsed once
    read = written(read_files(spark, f"{path}/files"), "records")
    responses = read.where("record_type = 'response'")
    plain = responses.select("page_id", F.col("n").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to")
    again = read.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to", F.col("digest").alias("payload_digest"))
    sources = responses.where("copy = 1").select(F.col("page_id").alias("refers_to"), F.col("digest").alias("payload_digest"), F.col("n").alias("payload_bytes"))
    return plain.unionByName(again.join(sources, ["refers_to", "payload_digest"]).select(*plain.columns))


ORACLE_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
     q AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS f FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> f THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> f THEN f END AS refers_to
FROM q
"""
