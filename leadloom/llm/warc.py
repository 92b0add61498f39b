"""WARC archives: writing, reading, and revisit records for payloads that were captured before.

``write`` makes a response record of every page, ``deduplicate`` writes archives in which each
payload is kept once, and ``resolve`` reads such archives and gives revisit records what their
originals hold.

Revisit resolution: one pass over the archives keeps a narrow header row for each record,
with the digest and size of the payload as they are, not as they are declared.  Headers are
shuffled by digest, the largest page of each is the original (a ``max`` combined before the
shuffle), and the others are joined to it.  A second pass writes every record anew: originals
with their payload and id, the others as revisit records that name the original, all with
fresh headers.  Payloads are only moved if the table of revisits is too large for Spark to broadcast.

Spark's text writer makes the files, one gzip file for each task and at most
``RECORDS_A_FILE`` records: a row is a record, the blank lines behind a record are its line
end.  Files come whole into a task, as archives do elsewhere, and are unpacked there record by
record, framed by ``Content-Length``, so payloads may hold anything.

Defined results: a null payload counts as empty, and equal empty payloads are equal payloads;
a null page id is smaller than any other and written as no field; of rows with the same page
and payload one is the response, the others revisit it; line ends in an address are written
as %0D and %0A, a null address as no field; an empty table gives an archive without records,
and archives without records give an empty table; payloads below ``least_bytes`` stay
responses; a revisit record whose original is in no archive has no size; a file that is cut
off or no archive is an error; other columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.common import in_batches
from leadloom.session import cut_lineage

RECORDS_A_FILE = 10_000
#: Bytes of records that leave a task at a time, and that are unpacked at a time.
BATCH_BYTES = 4 << 20
CHUNK = 1 << 20
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

HEADER = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("refers_to_id", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
    ]
)
RECORD = T.StructType([*HEADER.fields, T.StructField("payload", T.BinaryType())])


def digest_of(payload: bytes) -> str:
    """Base32 SHA-1, as archives carry it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_of(kind: str, page: str | None, uri: str | None, date: str, digest: str, payload: bytes, refers: tuple | None = None, own_id: str | None = None) -> bytes:
    """A record without the blank lines behind it; ``refers`` is the original's id, address and date.

    Without an id of its own the record gets one made from what it says.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    said = hashlib.md5("\x1f".join([kind, page or "", uri or "", digest]).encode())
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", own_id or f"<urn:uuid:{uuid.UUID(bytes=said.digest())}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if uri is None else uri.replace("\r", "%0D").replace("\n", "%0A")),
        ("WARC-Page-ID", page),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if refers:
        names = ("WARC-Refers-To", "WARC-Refers-To-Target-URI", "WARC-Refers-To-Date")
        fields += [("WARC-Profile", PROFILE), *zip(names, refers, strict=True)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return f"{head}\r\n".encode() + block


def _save(records: DataFrame, path: str, records_a_file: int) -> None:
    records.select(F.col("record").cast("string")).write.mode("overwrite").options(
        lineSep=END, compression="gzip", maxRecordsPerFile=records_a_file
    ).text(path)


def write(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    uri: str = "url",
    payload: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    records_a_file: int = RECORDS_A_FILE,
) -> None:
    """A response record for each row, replacing what is at ``path``."""
    rows = pages.select(
        F.col(key).cast("string").alias("page"), F.col(uri).cast("string").alias("uri"), F.col(payload).cast("binary").alias("payload")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches, 500):
            columns = [c.to_pylist() for c in batch.columns]
            out = [record_of("response", page, where, date, digest_of(body or b""), body or b"") for page, where, body in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    _save(rows.mapInArrow(run, "record binary"), path, records_a_file)


def _unpacked(content: bytes) -> Iterator[bytes]:
    """The bytes of a file piece by piece; of a gzip file, those of all its members."""
    if content[:2] != b"\x1f\x8b":
        for start in range(0, len(content), CHUNK):
            yield content[start : start + CHUNK]
        return
    view, start = memoryview(content), 0
    while start < len(content):
        member = zlib.decompressobj(wbits=31)
        while not member.eof:
            if start >= len(content) and not member.unconsumed_tail:
                raise ValueError("the gzip file is cut off")
            given = member.unconsumed_tail or view[start : start + CHUNK]
            if not member.unconsumed_tail:
                start += len(given)
            yield member.decompress(given, CHUNK)
        start -= len(member.unused_data)


def records_in(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields (names in lower case) and block of each record of a file."""
    buffer, pieces, ended = bytearray(), _unpacked(content), False

    def more() -> bool:
        nonlocal ended
        piece = next(pieces, None)
        ended = piece is None
        buffer.extend(piece or b"")
        return not ended

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0 and more():
            pass
        if end < 0:
            if buffer.strip():
                raise ValueError("a record is cut off")
            return
        first, *lines = bytes(buffer[:end]).decode("utf-8", "replace").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("no WARC record")
        fields = {name.lower(): value.strip(" ") for name, _, value in (line.partition(":") for line in lines)}
        whole = end + 4 + int(fields["content-length"])
        while len(buffer) < whole + 4 and more():
            pass
        if len(buffer) < whole + 4:
            raise ValueError("a record is cut off")
        yield fields, bytes(buffer[end + 4 : whole])
        del buffer[: whole + 4]


def payload_of(fields: dict[str, str], block: bytes) -> bytes:
    """The block without its HTTP head."""
    return block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """A row for each response or revisit record; digest and size are those of the payload that is there.

    Revisit records have the digest they declare and no size.
    """
    schema = RECORD if payloads else HEADER
    kinds = T.StructType(schema.fields)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = {"number": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, types.get(n, pa.string())) for c, n in zip(columns, kinds.fieldNames(), strict=True)], names=kinds.fieldNames()
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches, 1):
            name, content = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
            rows, held = [], 0
            for number, (fields, block) in enumerate(records_in(content)):
                kind = fields.get("warc-type")
                if kind not in ("response", "revisit"):
                    continue
                body = payload_of(fields, block)
                own = kind == "response"
                declared = fields.get("warc-payload-digest", "").removeprefix("sha1:")
                row = [name, number, kind, fields.get("warc-record-id"), fields.get("warc-page-id"), fields.get("warc-target-uri")]
                row += [fields.get("warc-date"), fields.get("warc-refers-to"), digest_of(body) if own else declared, len(body) if own else None]
                rows.append(tuple(row + [body] * payloads))
                held += len(body) * payloads + 400
                if held > BATCH_BYTES:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, schema)


def originals(headers: DataFrame, page_type: str = "bigint", least_bytes: int = 0) -> DataFrame:
    """file and number of each record that repeats a payload, and the record it repeats."""
    page = F.expr(f"try_cast(page AS {page_type})")
    candidates = headers.filter((F.col("record_type") == "response") & (F.col("payload_bytes") >= least_bytes))
    first = F.max(F.struct(page.alias("page"), "file", "number", "record_id", "uri", "date"))
    shared = candidates.groupBy("payload_digest").agg(F.count(F.lit(1)).alias("n"), first.alias("first")).filter("n > 1")
    return (
        candidates.select("payload_digest", "file", "number")
        .join(shared.select("payload_digest", "first"), "payload_digest")
        .filter((F.col("file") != F.col("first.file")) | (F.col("number") != F.col("first.number")))
        .select(
            F.col("file").alias("in_file"),
            F.col("number").alias("at"),
            *[F.col(f"first.{c}").alias(f"first_{c}") for c in ("record_id", "uri", "date")],
        )
    )


def deduplicate(
    spark: SparkSession,
    path: str,
    to: str,
    page_type: str = "bigint",
    least_bytes: int = 0,
    records_a_file: int = RECORDS_A_FILE,
) -> None:
    """Write the archives at ``path`` anew, equal payloads once; revisit records stay as they refer."""
    repeats = cut_lineage(originals(cut_lineage(read(spark, path)), page_type, least_bytes))
    rows = read(spark, path, payloads=True)
    same = (F.col("file") == F.col("in_file")) & (F.col("number") == F.col("at"))
    joined = rows.join(repeats, same, "left").select(
        "record_type", "record_id", "page", "uri", "date", "payload_digest", "refers_to_id", "first_record_id", "first_uri", "first_date",
        F.when(F.col("first_record_id").isNull(), F.col("payload")).alias("payload"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches, 500):
            out = []
            for kind, name, page, uri, date, digest, old, first, first_uri, first_date, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                refers = (first, first_uri, first_date) if first else (old, None, None) if kind == "revisit" else None
                out.append(record_of("revisit" if refers else "response", page, uri, date, digest, body or b"", refers, None if first else name))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    _save(joined.mapInArrow(run, "record binary"), to, records_a_file)


def resolve(spark: SparkSession, path: str, page_type: str = "bigint") -> DataFrame:
    """page_id, uri, payload_bytes, payload_digest, record_type and refers_to of every record.

    Revisit records have the size of their original's payload, and its page in ``refers_to``.
    """
    headers = cut_lineage(read(spark, path))
    page: Column = F.expr(f"try_cast(page AS {page_type})")
    response = F.col("record_type") == "response"
    own = headers.filter(response).select(
        page.alias("page_id"), "uri", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast(page_type).alias("refers_to")
    )
    first = headers.filter(response).select(
        F.col("record_id").alias("of"), F.col("payload_bytes").alias("bytes"), page.alias("refers_to")
    )
    revisits = headers.filter(~response).join(first, F.col("refers_to_id") == F.col("of"), "left")
    return own.unionAll(revisits.select(page.alias("page_id"), "uri", F.col("bytes"), "payload_digest", "record_type", "refers_to"))


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex,
    row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST) AS place,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS largest FROM pages
)
SELECT page_id, strlen(html) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN largest END AS refers_to
FROM p
"""
