"""Dictionary-compressed WARC writer and its reader.

One archive per partition: a skippable frame with a Zstandard dictionary built from
that archive's first records, then one Zstandard frame per record. The bytes are
written by Spark's text writer, so any file system it knows will do and a lost
executor's file is written again. The writer ends each value with a separator;
that separator is an empty skippable frame, which every Zstandard reader passes over.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from barline.llm.common import join_few, row_key
from barline.session import scratch_folder
from barline.sources.tables import stage

# Fixed values of the format: the dictionary's frame, and an empty frame as separator.
DICTIONARY_MAGIC = 0x184D2A5D
SEPARATOR = struct.pack("<II", 0x184D2A50, 0).decode("ascii")

#: Bytes of records from which an archive's dictionary is built, and its size.
SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
    date: str = "2025-01-01T00:00:00Z",
    level: int = 3,
) -> None:
    """Write a record per row of ``pages`` to the folder ``path``.

    The payload is the text in UTF-8, NULL as empty. Of records with equal payloads
    of at least ``least_bytes`` bytes the one with the largest id is a response and
    the others revisit it; smaller ones are all responses. Rows that repeat id and
    payload share their type; a NULL id loses against any other. A NULL url becomes
    ``urn:page:<id>``. An empty table gives archives without records. Columns besides
    the three named are not read.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    )
    rows = rows.withColumn("key", row_key("id", "payload"))
    equal = rows.filter(F.octet_length("payload") >= least_bytes).select("key", "id", F.sha2("payload", 256).alias("sha"))
    first = equal.groupBy("sha").agg(F.max("id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    visits = equal.join(first, "sha").filter(~F.col("id").eqNullSafe(F.col("first")))
    visits = stage(visits.select("key", "first").distinct(), "warc-revisits")
    marked = rows.join(visits, "key", "left").select("id", "url", "payload", F.col("first").alias("refers_to"))

    def archive(batches) -> Iterator[pa.RecordBatch]:
        records = (r for b in batches for r in map(_record, *(b.column(c).to_pylist() for c in ("id", "url", "payload", "refers_to"))))
        for frames in _chunks(_frames(records, level)):
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])

    def _record(page, url, payload, refers_to) -> bytes:
        return _warc_record(page, url, payload, refers_to, date)

    frames = marked.mapInArrow(archive, "frame binary")
    frames.select(F.col("frame").cast("string")).write.mode("overwrite").option("lineSep", SEPARATOR).text(path)


def _warc_record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    visit = refers_to is not None
    block = http if visit else http + payload
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url) if url else f"urn:page:{page}"
    fields = [
        ("WARC-Type", "revisit" if visit else "response"),
        ("WARC-Record-ID", f"<{_record_id(page)}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if page is not None:
        fields.append(("X-Page-Id", str(page)))
    if visit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<{_record_id(refers_to)}>"),
            ("X-Refers-To-Page", str(refers_to)),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _record_id(page: int | None) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page}").urn


def _frames(records: Iterator[bytes], level: int) -> Iterator[bytes]:
    """The dictionary's frame, then a frame per record. Only the records it is built from are held."""
    held, size = [], 0
    for record in records:
        held.append(record)
        size += len(record)
        if size >= SAMPLE_BYTES:
            break
    dictionary = _dictionary(held)
    data = dictionary.as_bytes() if dictionary else b""
    yield struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data
    compressor = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True)
    for record in held:
        yield compressor.compress(record)
    held.clear()
    for record in records:
        yield compressor.compress(record)


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """None where the records are too few to build one from."""
    samples = [r[: 64 << 10] for r in records]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        return None


def _chunks(frames: Iterator[bytes], most: int = 8 << 20) -> Iterator[list[bytes]]:
    held, size = [], 0
    for frame in frames:
        held.append(frame)
        size += len(frame)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def read_archives(spark, path: str) -> DataFrame:
    """The records of the archives in ``path``.

    Returns ``page_id``, ``url``, ``record_type``, ``refers_to``, ``payload_bytes``,
    ``payload_digest`` (both of the full payload) and ``payload`` (NULL for revisits).
    A payload that is there is checked against its digest.
    """

    def parse(batches):
        for b in batches:
            for content in b.column("content"):
                rows, size = [], 0
                for row in _parse(memoryview(content.as_buffer())):
                    rows.append(row)
                    size += len(row["payload"] or b"")
                    if size >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    _SCHEMA = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
    ])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(
        parse,
        "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary",
    )


def _parse(archive: memoryview) -> Iterator[dict]:
    magic, size = struct.unpack_from("<II", archive)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("an archive begins with its dictionary")
    dictionary = zstandard.ZstdCompressionDict(bytes(archive[8 : 8 + size])) if size else None
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(archive[8 + size :], read_across_frames=True)
    buffer = bytearray()

    def fill(n: int) -> bool:
        while len(buffer) < n:
            more = reader.read(1 << 20)
            if not more:
                return False
            buffer.extend(more)
        return True

    while fill(1):
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not fill(len(buffer) + 1):
                raise ValueError("an archive ends within a record")
        head = dict(line.split(": ", 1) for line in buffer[:end].decode().split("\r\n")[1:])
        length = int(head["Content-Length"])
        if not fill(end + 4 + length + 4):
            raise ValueError("an archive ends within a record")
        block = bytes(buffer[end + 4 : end + 4 + length])
        del buffer[: end + 4 + length + 4]
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        visit = head["WARC-Type"] == "revisit"
        if not visit and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"record {head['WARC-Record-ID']}: the payload is not that of its digest")
        told = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length"))
        yield {
            "page_id": int(head["X-Page-Id"]) if "X-Page-Id" in head else None,
            "url": head["WARC-Target-URI"],
            "record_type": head["WARC-Type"],
            "refers_to": int(head["X-Refers-To-Page"]) if "X-Refers-To-Page" in head else None,
            "payload_bytes": told if visit else len(payload),
            "payload_digest": digest,
            "payload": None if visit else payload,
        }


def round_trip(spark, pages: DataFrame, **options) -> DataFrame:
    """The pages' records as the archives written from them give them back."""
    path = scratch_folder(spark, "warc")
    write_archives(pages, path, **options)
    return read_archives(spark, path)
