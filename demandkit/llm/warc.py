"""Web archives with revisit records.

Only headers (digest, size, id) meet in the shuffle that looks for equal payloads; the
payload moves once, to the digest it has. Archives are gzipped part files in a shared
folder, written by Spark's own committer, so a lost executor leaves no half file behind.

Defined results: a null payload is empty; a null id counts as smaller than any other;
several rows with the largest id of their payload are all responses (with equal record
ids); a null or unprintable address is written percent-encoded; an empty table gives no
records; further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from demandkit.runtime import fresh_path, settle

CRLF = "\r\n"
RECORD_END = CRLF + CRLF
#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Bytes that an archive's records have at most before they are zipped; payloads up to SMALL_BYTES are one size.
FILE_BYTES, SMALL_BYTES = 1 << 29, 1 << 16

RECORDS = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "record_id string, target_uri string"
)


def _record_id(page_id: Column, digest: Column) -> Column:
    """The same id for the same page and payload, wherever it is made."""
    h = F.md5(F.concat_ws(":", F.coalesce(page_id.cast("string"), F.lit("-")), digest))
    cut = [F.substring(h, begin, size) for begin, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _field(name: str, value: Column | str) -> Column:
    """A header line; nothing for null."""
    value = F.lit(value) if isinstance(value, str) else value
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


#: Characters that may stand in an address as they are, besides letters and digits.
PLAIN = ":/?#[]@!$&'()*+,;=-._~%"


def _target(url: Column) -> Column:
    """The address with everything percent-encoded that may not stand in one, a space as ``%20``."""
    out = F.replace(F.url_encode(F.coalesce(url, F.lit(""))), F.lit("+"), F.lit("%20"))
    # The percent sign is the last one, so that what it spells is not read again.
    for c in PLAIN:
        out = F.replace(out, F.lit(f"%{ord(c):02X}"), F.lit(c))
    return F.when(url.rlike(r"^[\x21-\x7E]+$"), url).otherwise(out)


def resolve(pages: DataFrame, payload: str = "html", key: str = "page_id", min_bytes: int = 1000) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest and the page that has the payload (``original``)."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(
        F.col(key).cast("long").alias("page_id"),
        url.alias("url"),
        body.alias("payload"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        F.sha1(body.cast("binary")).alias("payload_digest"),
    )
    # Written, so that the join has a shuffle of its own on both sides and a digest that
    # many pages have can be split.
    originals = settle(
        rows.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
        .drop("copies"),
        "originals",
    )
    return rows.join(originals, "payload_digest", "left")


def records(resolved: DataFrame, date: str) -> DataFrame:
    """One text column: the record without its end."""
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=UTF-8{CRLF}Content-Length: "), F.col("payload_bytes").cast("string"), F.lit(RECORD_END))
    block_bytes = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    head = F.concat(
        F.lit(VERSION + CRLF),
        _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("payload_digest"))),
        _field("WARC-Date", date),
        _field("WARC-Target-URI", _target(F.col("url"))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(
            revisit,
            F.concat(
                _field("WARC-Profile", REVISIT_PROFILE),
                _field("WARC-Refers-To", _record_id(F.col("original"), F.col("payload_digest"))),
                _field("WARC-Refers-To-Date", date),
                _field("X-Refers-To-Page", F.col("original").cast("string")),
            ),
        ).otherwise(F.lit("")),
        _field("X-Page", F.col("page_id").cast("string")),
        _field("Content-Type", "application/http;msgtype=response"),
        _field("Content-Length", block_bytes.cast("string")),
        F.lit(CRLF),
    )
    return resolved.select(F.concat(head, http, F.when(revisit, F.lit("")).otherwise(F.col("payload"))).alias("record"))


def write_archives(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", file_bytes: int = FILE_BYTES, **options) -> None:
    """Archives of all pages. The end of a record is the writer's line separator.

    Pages of like sizes go into files of their own, each size with as many records a file as stay
    below ``file_bytes`` (a larger record is a file by itself). So the reader, which takes a file as
    one value, can hold every file.
    """
    resolved = resolve(pages, **options)
    steps = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.col("payload_bytes"), F.lit(1)) / SMALL_BYTES)))
    sized = resolved.withColumn("steps", steps.cast("int"))
    found = [r.steps for r in sized.select("steps").distinct().collect()]  # at most 32 sizes
    for number, step in enumerate(sorted(found) or [0]):
        # The header of a record is shorter than the smallest size.
        per_file = max(1, file_bytes // (2 * SMALL_BYTES << step))
        own = sized if len(found) < 2 else sized.filter(F.col("steps") == step)
        (
            records(own, date).write.mode("append" if number else "overwrite").option("lineSep", RECORD_END).option("compression", "gzip")
            .option("maxRecordsPerFile", per_file).text(folder)
        )


def _inflated(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    view, at, unzip = memoryview(data), 0, zlib.decompressobj(31)
    while at < len(view) or unzip.unused_data:
        rest = unzip.unused_data
        if unzip.eof:  # the next member
            unzip = zlib.decompressobj(31)
        chunk = rest or bytes(view[at : at + step])
        at += 0 if rest else step
        yield unzip.decompress(chunk)
    if not unzip.eof and len(view):
        raise ValueError("the archive ends within a record")


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of a gzipped archive."""
    buffer, source = bytearray(), _inflated(data)

    def need(n: int) -> bool:
        while len(buffer) < n:
            more = next(source, None)
            if more is None:
                return False
            buffer.extend(more)
        return True

    while True:
        seen, end = 0, -1
        while (end := buffer.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(buffer)
            if not need(seen + 1):
                if buffer.strip():
                    raise ValueError("the archive ends within a header")
                return
        lines = bytes(buffer[:end]).decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
        size = int(fields["content-length"])
        if not need(end + 4 + size + 4) or buffer[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError("a record does not end where it says")
        yield fields, bytes(buffer[end + 4 : end + 4 + size])
        del buffer[: end + 8 + size]


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives of a folder; the digest of each stored payload is checked."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for fields, block in parse(content.as_py()):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest, kind = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"]
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"payload of {fields['warc-record-id']} does not have its digest")
                    page, other = fields.get("x-page"), fields.get("x-refers-to-page")
                    rows.append((None if page is None else int(page), size, digest, kind, None if other is None else int(other), fields["warc-record-id"], fields.get("warc-target-uri")))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
                names = [x.split()[0] for x in RECORDS.split(", ")]
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("content").mapInArrow(read, RECORDS)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the archives into the shared folder and read them back."""
    folder = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, folder, **options)
    return read_archives(pages.sparkSession, folder)
