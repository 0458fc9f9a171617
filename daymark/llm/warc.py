"""WARC archives in which no payload stands twice: revisit resolution.

Pages are captured as records with an id, the length and the SHA-256 of their payload. Only
these headers are shuffled, by digest: the response with the least page id of a digest is its
original, and all other records of the digest become revisits that name it. Revisits need no
payload, so the payloads move at most once, when the revisits are taken out of the captured
records; where there are few revisits Spark sends their ids round instead.

Archives are ``.warc.gz`` in the usual form, each record a gzip member of its own, some MB a
file. They go through Spark's text writer, one row a file, whose commits are atomic and which
writes to any store that Spark knows. The line end that it adds is an empty gzip member.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.session import new_path

from .store import ship, written

#: Payloads under this many bytes are stored as they are; a revisit record would not be shorter.
LEAST = 100
#: Compressed bytes after which a file is closed.
FILE_BYTES = 16 << 20
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
#: A gzip member without content.
NOTHING = bytes.fromhex("1f8b080000000000020303000000000000000000").decode("latin-1")

RECORD = (
    "record_id string, page_id long, url string, record_type string, payload_bytes long, "
    "payload_digest string, refers_id string, refers_to long, refers_uri string"
)
FIELDS = [part.split()[0] for part in RECORD.split(", ")]


def captured(pages: DataFrame) -> DataFrame:
    """A response record per row of ``pages`` (page_id, url, html), with a payload column.

    The records are written down, so that their random ids stay the same for all who read them.
    """
    rows = pages.select(
        F.expr("uuid()").alias("record_id"),
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.lit("response").alias("record_type"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumns(
        {
            "payload_bytes": F.octet_length("payload").cast("long"),
            "payload_digest": F.sha2("payload", 256),
            "refers_id": F.lit(None).cast("string"),
            "refers_to": F.lit(None).cast("long"),
            "refers_uri": F.lit(None).cast("string"),
        }
    )
    return written(rows.select(*FIELDS, "payload"), "captured")


def resolved(records: DataFrame, least: int = LEAST) -> DataFrame:
    """The records with each payload of ``least`` bytes or more in one response only.

    ``records`` may hold revisits already, from archives that were read: they are joined to the
    response of their digest, whatever its size, and keep what they refer to if there is none.
    Of equal payloads the response with the least page id stays; records without a page id come
    last, and of rows with the same page id one stays. ``records`` is read more than once, so
    it should be a stored table.
    """
    headers = records.select(*FIELDS)
    response = F.col("record_type") == "response"
    name = F.struct(F.col("page_id").isNull().alias("nameless"), "page_id", "record_id", "url")
    originals = (
        headers.groupBy("payload_digest")
        .agg(
            F.min(F.when(response, name)).alias("first"),
            F.count(F.when(response & (F.col("payload_bytes") >= least), 1)).alias("n"),
            F.count(F.when(~response, 1)).alias("n_revisits"),
        )
        .where("first IS NOT NULL AND (n > 1 OR n_revisits > 0)")
        .select("payload_digest", "first")
    )
    # As a table the originals have a known size, and the join with them is a plain one, whose
    # large groups Spark can split.
    originals = written(originals, "originals")
    able = headers.where(~response | (F.col("payload_bytes") >= least))
    revisits = able.join(originals, "payload_digest").where("record_id <> first.record_id").select(
        "record_id", "page_id", "url", F.lit("revisit").alias("record_type"), "payload_bytes", "payload_digest",
        F.col("first.record_id").alias("refers_id"), F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_uri"),
    )
    revisits = written(revisits, "revisits")
    rest = records.join(revisits.select("record_id"), "record_id", "left_anti").select(*FIELDS, "payload")
    return rest.unionByName(revisits.withColumn("payload", F.lit(None).cast("binary")))


def _field(text: str) -> str:
    """A value fit for a header line: blanks, control and other characters as percent escapes."""
    return re.sub(r"[^!-~]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "surrogatepass")), text)


def record_bytes(row: dict, payload: bytes | None, date: str) -> bytes:
    """One WARC record with headers made anew."""
    own = f"urn:uuid:{row['record_id']}"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: <{own}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_field(row['url'] or '') or own}",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
    ]
    if row["page_id"] is not None:
        lines.append(f"X-Page-ID: {row['page_id']}")
    if row["record_type"] == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
        if row["refers_id"] is not None:
            target = _field(row["refers_uri"] or "") or f"urn:uuid:{row['refers_id']}"
            lines += [f"WARC-Refers-To: <urn:uuid:{row['refers_id']}>", f"WARC-Refers-To-Target-URI: {target}", f"WARC-Refers-To-Date: {date}"]
        if row["refers_to"] is not None:
            lines.append(f"X-Refers-To-Page-ID: {row['refers_to']}")
    block = HTTP.format(row["payload_bytes"]).encode() + (payload or b"")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _info(date: str) -> bytes:
    block = b"software: daymark\r\nformat: WARC File Format 1.1\r\n"
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {date}", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(records: DataFrame, path: str, date: str | None = None, file_bytes: int = FILE_BYTES) -> None:
    """Write ``records`` as ``.warc.gz`` files to ``path``; ``date`` (ISO, now by default) dates them all."""
    ship(records.sparkSession)
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def files(batches):
        held, size = [], 0

        def close():
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["value"])

        for batch in batches:
            rows = batch.drop_columns(["payload"]).to_pylist()
            payloads = batch.column("payload")
            for i, row in enumerate(rows):
                if not held:
                    held.append(_member(_info(date)))
                held.append(_member(record_bytes(row, payloads[i].as_py(), date)))
                size += len(held[-1])
                if size >= file_bytes:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    made = records.select(*FIELDS, "payload").mapInArrow(files, "value binary").select(F.col("value").cast("string"))
    made.write.option("lineSep", NOTHING).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 1).text(path)


def members(data: memoryview, window: int = 1 << 14):
    """The content of each gzip member of a file, one after another."""
    at = 0
    while at < len(data):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            piece = data[at : at + window]
            if not len(piece):
                raise ValueError("the archive ends inside a record")
            parts.append(unpacker.decompress(piece))
            at += len(piece) - len(unpacker.unused_data)
        yield b"".join(parts)


def parsed(raw: bytes) -> tuple[dict, bytes] | None:
    """The fields of a record (names in lower case) and its block; nothing for an empty member."""
    if not raw:
        return None
    head, found, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not found or not version.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    length = int(fields["content-length"])
    if len(rest) < length:
        raise ValueError("the record ends early")
    return fields, rest[:length]


def _bare(identifier: str | None) -> str | None:
    return identifier and identifier.strip("<>").removeprefix("urn:uuid:")


def _as_row(fields: dict, block: bytes) -> tuple[list, bytes | None]:
    """The columns of RECORD, and the payload of a response. Lengths and digests of payloads
    that are there are counted again; a payload that does not fit its header is an error."""
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if fields["warc-type"] == "response":
        count, actual = len(payload), hashlib.sha256(payload).hexdigest()
        if digest and digest != actual:
            raise ValueError(f"record {fields['warc-record-id']} has another payload than its header says")
        digest = actual
    else:
        payload = None
        told = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        count = int(told[1]) if told else None
    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
    row = [
        _bare(fields["warc-record-id"]), int(page) if page else None, fields.get("warc-target-uri"), fields["warc-type"], count,
        digest, _bare(fields.get("warc-refers-to")), int(refers) if refers else None, fields.get("warc-refers-to-target-uri"),
    ]
    return row, payload


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The response and revisit records of the archives at ``path``, as ``resolved`` takes them.

    Revisits have no payload. Without ``payloads`` that column is left out. Records of a file
    are handed on in batches of about 8 MB.
    """
    ship(spark)
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def records(batches):
        rows, bodies, size = [], [], 0

        def close():
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = list(FIELDS)
            if payloads:
                columns.append(pa.array(bodies, pa.binary()))
                names.append("payload")
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for content in batch.column(0):
                for raw in members(memoryview(content.as_buffer())):
                    found = parsed(raw)
                    if not found or found[0].get("warc-type") not in ("response", "revisit"):
                        continue
                    row, body = _as_row(*found)
                    rows.append(row)
                    bodies.append(body if payloads else None)
                    size += 300 + (len(body or b"") if payloads else 0)
                    if size >= 1 << 23:
                        yield close()
                        rows, bodies, size = [], [], 0
        if rows:
            yield close()

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(records, RECORD + ", payload binary" * payloads)


def restored(records: DataFrame) -> DataFrame:
    """The records with every revisit's payload taken from the response that it refers to."""
    responses = records.where("record_type = 'response'")
    whole = responses.select(F.col("record_id").alias("refers_id"), F.col("payload").alias("body"))
    back = records.where("record_type = 'revisit'").drop("payload").join(whole, "refers_id", "left")
    return responses.unionByName(back.withColumnRenamed("body", "payload"))


def deduplicated(pages: DataFrame, path: str | None = None, least: int = LEAST) -> DataFrame:
    """Archive ``pages`` (page_id, url, html), each payload once, and read the archives back.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to per row of ``pages``.
    A null html is an empty payload, a null url is replaced by the record's id. Very long pages
    are written whole. Rows without a page_id are archived as well; they are originals only
    where no other row has the payload. Repeated rows are a response and revisits to its page
    id. Ties cannot arise: a digest has one least page id, and of its rows the one with the
    least record id stays. An empty table gives an empty result. Other columns are ignored.
    """
    spark = pages.sparkSession
    path = path or new_path(spark, "archives")
    write_archives(resolved(captured(pages), least), path)
    return read_archives(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS original FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND original < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND original < page_id THEN original END AS refers_to
FROM f
"""
