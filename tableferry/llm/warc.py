"""WARC archives with revisit resolution.

Headers are shuffled by payload digest to find each payload's original; copies
become revisit records that name it, and Spark's text writer stores the
deduplicated records, so archives can lie wherever Spark can write. Reading
parses the archives again, file by file.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.session import scratch_dir

LEAST_BYTES = 1000
#: Bounds the records of a file, which is read back by one task.
FILE_RECORDS = 4000
DATE = "2024-01-01T00:00:00Z"
_END = "\r\n\r\n"


def resolved(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Pages with digest, size, record type, and the page a revisit refers to.

    Of equal payloads of at least ``least_bytes`` the one with the greatest page_id
    is the response. Rows that tie on it are all responses; null ids come after all
    others, and a payload of null ids only has responses only.
    """
    body = F.coalesce("html", F.lit(""))
    headed = pages.select(
        "page_id",
        "url",
        body.alias("html"),
        F.octet_length(body).cast("bigint").alias("payload_bytes"),
        F.sha1(body.cast("binary")).alias("payload_digest"),
    )
    originals = (
        headed.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("original"))
    )
    # A payload with a third of all rows is a hot key of a plain join, which Spark splits.
    joined = headed.join(originals, "payload_digest", "left")
    again = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return joined.withColumn("record_type", F.when(again, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(again, F.col("original"))
    )


def _record_id(page_id: Column) -> Column:
    digest = F.md5(F.concat(F.lit("page:"), page_id.cast("string")))
    parts = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, null without a value."""
    return F.concat(F.lit(f"{name}: "), value.cast("string"))


def records(pages: DataFrame) -> DataFrame:
    """One text ``value`` per row of :func:`resolved`: a WARC/1.1 record with fresh headers."""
    revisit = F.col("record_type") == "revisit"
    status = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
    block = F.concat(
        F.lit(status), F.col("payload_bytes").cast("string"), F.lit(_END), F.when(revisit, "").otherwise(F.col("html"))
    )
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Date", F.lit(DATE)),
        # A control character would end the header; other characters stay as they are.
        _line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to")))),
        _line("X-Refers-To-Page", F.col("refers_to")),
        _line("X-Page-Id", F.col("page_id")),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length("block")),
    )
    return pages.withColumn("block", block).select(F.concat(head, F.lit(_END), F.col("block")).alias("value"))


def write_archives(pages: DataFrame, location: str, least_bytes: int = LEAST_BYTES) -> None:
    """Write the deduplicated archives of ``pages(page_id, url, html)`` as gzip files."""
    (
        records(resolved(pages, least_bytes))
        # The blank lines that end a record are the writer's separator.
        .write.option("lineSep", _END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", FILE_RECORDS)
        .text(location)
    )


def parsed_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive; a cut or malformed record is an error."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(line.split(": ", 1) for line in lines[1:])
        start, size = end + 4, int(head["Content-Length"])
        if data[start + size : start + size + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut short")
        yield head, data[start : start + size]
        at = start + size + 4


def inflated(data: bytes | memoryview, chunk: int = 1 << 20) -> bytes:
    """All members of a gzip file one after the other, of which usual archives have one per record."""
    data, at, out = memoryview(data), 0, []
    while at < len(data):
        member = zlib.decompressobj(31)
        while not member.eof:
            if at >= len(data):
                raise ValueError("the archive ends inside a compressed member")
            out.append(member.decompress(data[at : at + chunk]))
            at = min(at + chunk, len(data))
        at -= len(member.unused_data)
    return b"".join(out)


def _long(head: dict[str, str], name: str) -> int | None:
    return int(head[name]) if name in head else None


def read_archives(spark: SparkSession, location: str, page_id: str = "bigint") -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to, url, html)`` of each record.

    A response's digest and size are taken from its payload and held against its
    headers; a revisit has no payload and gives those of its headers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for head, block in parsed_records(inflated(content.as_buffer())):
                    lines, _, body = block.partition(b"\r\n\r\n")
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(lines.rpartition(b": ")[2])
                    response = head["WARC-Type"] == "response"
                    if response and (len(body), hashlib.sha1(body).hexdigest()) != (size, digest):
                        raise ValueError(f"payload of {head.get('WARC-Record-ID')} does not fit its headers")
                    rows.append(
                        {
                            "page_id": _long(head, "X-Page-Id"),
                            "payload_bytes": size,
                            "payload_digest": digest,
                            "record_type": head["WARC-Type"],
                            "refers_to": _long(head, "X-Refers-To-Page"),
                            "url": head.get("WARC-Target-URI"),
                            "html": body.decode() if response else None,
                        }
                    )
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema(
        [
            ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("html", pa.string()),
        ]
    )
    files = spark.read.format("binaryFile").load(location).select("content")
    return files.mapInArrow(
        run,
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
        "url string, html string",
    ).withColumns({c: F.col(c).cast(page_id) for c in ("page_id", "refers_to")})


def archived(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back: a row per page.

    A null html is an empty payload, a null url has no header. Repeated rows are
    records of their own. No pages give archives without records and no rows.
    """
    location = scratch_dir(spark, "warc")
    write_archives(pages.select("page_id", "url", "html"), location)
    return read_archives(spark, location, dict(pages.dtypes)["page_id"]).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


ORACLE = """
with sized as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest
    from pages),
originals as (
    select payload_digest, max(page_id) as original from sized where payload_bytes >= 1000 group by payload_digest)
select page_id, payload_bytes, payload_digest,
    case when original is not null and page_id is distinct from original then 'revisit' else 'response' end as record_type,
    case when original is not null and page_id is distinct from original then original end as refers_to
from sized left join originals using (payload_digest)
"""
