"""WARC archives: writing captures, and assembling their records again."""

import base64
import hashlib
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from paralane.llm.common import batches_of, text_or_empty
from paralane.session import materialize, new_folder

END = "\r\n"
VERSION = "WARC/1.1"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of records that a file should have, before compression.
FILE_BYTES = 32 << 20

RECORD = StructType([
    StructField("record_id", StringType()), StructField("record_type", StringType()),
    StructField("concurrent_to", StringType()), StructField("refers_to", StringType()),
    StructField("target_uri", StringType()), StructField("date", StringType()),
    StructField("digest", StringType()), StructField("payload_bytes", LongType()),
    StructField("payload_sha1", StringType()), StructField("fields", StringType()), StructField("payload", BinaryType()),
])


def base32_of_hex(hexadecimal: Column) -> Column:
    """Base32 (upper case) of 20 bytes in hexadecimal: five bits a letter."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    groups = []
    for at in range(1, 41, 5):  # five hexadecimal digits are four letters
        bits = F.conv(F.substring(hexadecimal, at, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            groups.append(F.substring(letters, F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*groups)


def _header(*lines: tuple[str, Column | str]) -> list[Column]:
    """Header lines; those with a null value are left out."""
    return [F.concat(F.lit(f"{END}{name}: "), F.lit(x) if isinstance(x, str) else x) for name, x in lines]


def _record(kind: Column | str, headers: list[Column], block: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = F.concat_ws("", F.lit(f"{VERSION}{END}WARC-Type: "), kind, *headers)
    size = F.concat(F.lit(f"{END}Content-Length: "), F.octet_length(block).cast("string"), F.lit(END + END))
    return F.concat(lines, size, block)


def _one_line(column: Column) -> Column:
    """Header values hold no line breaks."""
    return F.regexp_replace(column, r"[\r\n]", " ")


def captures(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Which pages are stored whole, and which refer to a page of equal payload.

    Of pages whose payloads are equal and have ``least_bytes`` or more, that with the largest page_id
    is the response; smaller payloads are all responses. Payloads are equal if length, SHA-1 and
    SHA-256 are. Rows that share the largest page_id are all responses, and the others refer to one of
    them; a null page_id is smaller than any other.

    ``row_name`` tells rows apart that have no page_id or repeat one; it is null for others. Rows are
    written once with it, when this is called, so that ``refers_to`` (page_id and row_name) names a row.
    """
    payload = text_or_empty("html")
    rows = pages.select(
        "page_id", _one_line(F.col("url").cast("string")).alias("url"), payload.alias("html"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload.cast("binary")).alias("sha1"),
        F.sha2(payload.cast("binary"), 256).alias("sha256"), F.uuid().alias("uuid"),
    )
    ids = pages.filter(F.col("page_id").isNotNull()).groupBy(F.col("page_id").cast("string").alias("key"))
    repeated = materialize(ids.agg(F.count("*").alias("rows")).filter(F.col("rows") > 1))
    # Rows without a page_id are spread under keys that begin with a space, as no page_id does.
    rows = rows.withColumn("key", F.coalesce(F.col("page_id").cast("string"), F.concat(F.lit(" "), "uuid")))
    shared = F.col("page_id").isNull() | F.col("rows").isNotNull()
    rows = materialize(rows.join(repeated, "key", "left").withColumn("row_name", F.when(shared, F.col("uuid"))).drop("key", "rows", "uuid"))
    groups = rows.groupBy("payload_bytes", "sha1", "sha256").agg(
        F.max(F.struct("page_id", "row_name")).alias("newest"), F.count("*").alias("copies")
    )
    several = groups.filter((F.col("copies") > 1) & (F.col("payload_bytes") >= least_bytes)).drop("copies")
    older = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest.page_id"))
    return rows.join(materialize(several), ["payload_bytes", "sha1", "sha256"], "left").select(
        "page_id", "row_name", "url", "html", "payload_bytes", base32_of_hex(F.col("sha1")).alias("digest"),
        F.when(older, F.col("newest")).alias("refers_to"),
    )


def _uri(page_id: Column, part: str, row_name: Column) -> Column:
    """A record's id: that of its page, and the row's name if others have the page_id too."""
    page = F.coalesce(page_id.cast("string"), F.lit("null"))
    return F.concat(F.lit("<urn:page:"), page, F.lit(f":{part}"), F.coalesce(F.concat(F.lit(":"), row_name), F.lit("")), F.lit(">"))


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", least_bytes: int = 0) -> None:
    """Write a request, a response or revisit, and a metadata record of every page, as gzipped WARC files.

    ``pages`` has page_id, url and html; the html, in UTF-8, is the payload. Records end with two line
    breaks, which is how Spark's text writer ends them, so no payload passes through Python. Files get as
    many records as make some 32 MB on average. Null html is an empty payload, a null url is left out,
    and repeated rows are records of their own. All record ids differ.
    """
    rows = captures(pages, least_bytes)
    spread = pages.agg(F.sum(F.octet_length(text_or_empty("html"))), F.count("*")).first()
    mean = (spread[0] or 0) / max(1, spread[1]) + 1500
    body = F.col("html")
    http = f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=UTF-8{END}Content-Length: "
    response = F.concat(F.lit(http), F.octet_length(body).cast("string"), F.lit(END + END), body)
    bare = F.concat(F.lit(http), F.octet_length(body).cast("string"), F.lit(END + END))
    revisit = F.col("refers_to").isNotNull()
    page_id, row_name, uri = F.col("page_id"), F.col("row_name"), F.col("url")
    own = _uri(page_id, "capture", row_name)
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    stored = _record(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        _header(
            ("WARC-Record-ID", own), ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", digest),
            ("WARC-Profile", F.when(revisit, F.lit(REVISIT))),
            ("WARC-Refers-To", F.when(revisit, _uri(F.col("refers_to.page_id"), "capture", F.col("refers_to.row_name")))),
            ("Content-Type", "application/http; msgtype=response"),
        ),
        F.when(revisit, bare).otherwise(response),
    )
    request = _record(
        "request",
        _header(
            ("WARC-Record-ID", _uri(page_id, "request", row_name)), ("WARC-Date", date), ("WARC-Target-URI", uri),
            ("WARC-Concurrent-To", own), ("Content-Type", "application/http; msgtype=request"),
        ),
        F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(f" HTTP/1.1{END}{END}")),
    )
    metadata = _record(
        "metadata",
        _header(
            ("WARC-Record-ID", _uri(page_id, "metadata", row_name)), ("WARC-Date", date), ("WARC-Target-URI", uri),
            ("WARC-Concurrent-To", own), ("Content-Type", "application/warc-fields"),
        ),
        F.concat(F.lit("pageId: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(f"{END}payloadBytes: "), F.col("payload_bytes").cast("string"), F.lit(END)),
    )
    records = rows.select(F.explode(F.array(request, stored, metadata)).alias("value"))
    (
        records.write.option("lineSep", END + END).option("compression", "gzip")
        .option("maxRecordsPerFile", 3 * max(1, int(FILE_BYTES / mean))).text(path)
    )


def unzipped(data: bytes) -> bytes:
    """The contents of a plain or gzipped archive, of one member or of one per record."""
    parts = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(wbits=31)
        parts.append(member.decompress(data))
        data = member.unused_data
    return b"".join(parts) if parts else data


def records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive in order: headers (names in lower case) and block."""
    at = 0
    while True:
        begin = archive.find(b"WARC/", at)
        if begin < 0:
            return
        end = archive.find(b"\r\n\r\n", begin)
        if end < 0:
            raise ValueError("a record's header does not end")
        headers: dict[str, str] = {}
        for line in archive[begin:end].decode("utf-8", "replace").split(END)[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        at = end + 4 + size
        if at > len(archive):
            raise ValueError(f"record {headers.get('warc-record-id')} is cut off")
        yield headers, archive[end + 4 : at]


def _rows(archive: bytes) -> Iterator[tuple]:
    for headers, block in records(archive):
        kind, http = headers.get("warc-type"), "application/http" in headers.get("content-type", "")
        payload = block.partition(b"\r\n\r\n")[2] if http else block
        digest = headers.get("warc-payload-digest", "").rpartition(":")[2] or None
        holds = kind in ("response", "resource")
        yield (
            headers.get("warc-record-id"), kind, headers.get("warc-concurrent-to"), headers.get("warc-refers-to"),
            headers.get("warc-target-uri"), headers.get("warc-date"), digest,
            len(payload) if holds else None,
            base64.b32encode(hashlib.sha1(payload).digest()).decode() if holds else None,
            None if http or kind == "warcinfo" else block.decode("utf-8", "replace"), payload if holds else None,
        )


def _parsed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive in batch.column(0):
            yield from batches_of(_rows(unzipped(archive.as_py())), schema, 256)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the WARC files (plain or gzipped) below a path.

    A file is parsed in one task, which holds it whole; lengths, not separators, tell where a record
    ends, so payloads may hold anything. A record that is cut off is an error. Payloads are those of
    responses and resources, without HTTP headers.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(partial(_parsed, schema=to_arrow_schema(RECORD)), RECORD)


def assemble(rows: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, request and metadata.

    Requests and metadata name the record they are concurrent to; they are joined to it by that
    identifier. A capture without one of them has null there; of several, that with the smallest
    record id counts. Records without a capture are left out.
    """
    main = rows.filter(F.col("record_type").isin("response", "resource", "revisit"))
    sides = (
        rows.filter(F.col("record_type").isin("request", "metadata") & F.col("concurrent_to").isNotNull())
        .groupBy(F.col("concurrent_to").alias("__capture"))
        .agg(*(
            F.min(F.when(F.col("record_type") == kind, F.struct("record_id", "target_uri", "date", "fields"))).alias(kind)
            for kind in ("request", "metadata")
        ))
    )
    return main.join(sides, main["record_id"] == sides["__capture"], "left").select(
        "record_id", "record_type",
        F.struct("target_uri", "date", "digest", "payload_bytes", "payload_sha1", "payload").alias("response"),
        "refers_to", "request", "metadata",
    )


def _field(name: str) -> Column:
    return F.regexp_extract(F.col("metadata.fields"), rf"(?m)^{name}: *(-?\d+)", 1)


def _page_of(uri: str) -> Column:
    return F.regexp_extract(uri, r"^<urn:page:(-?\d+):", 1)


def _number(text: Column) -> Column:
    return F.when(text != "", text.cast("long"))


def archived_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of pages that were archived and read back.

    A response's length and digest are those of the payload that was read; one that does not match the
    digest in its header is an error. A revisit stores no payload: its digest and length are those that
    were recorded with it. An empty table gives an empty result.
    """
    path = new_folder(pages.sparkSession, "warc")
    write_archives(pages, path, least_bytes=least_bytes)
    whole = F.col("record_type") == "response"
    damaged = whole & (F.col("response.digest") != F.col("response.payload_sha1"))
    return assemble(read_records(pages.sparkSession, path)).select(
        _number(_field("pageId")).alias("page_id"),
        F.when(whole, F.col("response.payload_bytes")).otherwise(_number(_field("payloadBytes"))).alias("payload_bytes"),
        F.when(damaged, F.raise_error(F.concat(F.lit("damaged record "), F.col("record_id"))))
        .when(whole, F.col("response.payload_sha1")).otherwise(F.col("response.digest")).alias("payload_digest"),
        "record_type", _number(_page_of("refers_to")).alias("refers_to"),
    )
