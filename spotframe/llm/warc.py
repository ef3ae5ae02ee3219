"""Zstandard WARC archives: a dictionary in a leading skippable frame, then one frame per record."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import shared_dir, stable

# Payload bytes that one archive should hold.
ARCHIVE_BYTES = 32 << 20
# Payloads below this size are never stored as a reference to an equal one.
LEAST_SHARED = 100

# Bytes of an archive's first records that its dictionary is trained on, and the size of the dictionary.
DICTIONARY_SAMPLE, DICTIONARY_BYTES = 512 << 10, 32 << 10
LEVEL = 3
CHUNK = 64 << 10

# Frame numbers (little-endian) of the format, and lines of the archive standard.
DICTIONARY_FRAME = (0x184D2A5D).to_bytes(4, "little")
SKIPPABLE_FIRST, SKIPPABLE_LAST, DATA_FRAME = 0x184D2A50, 0x184D2A5F, 0xFD2FB528
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

# Spark's text writer puts a separator after every row; an empty skippable frame is one that readers pass over.
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"

RECORD = (
    "id string, url string, date string, record_type string, refers_to string, payload binary, payload_bytes long, "
    "payload_digest string"
)


class BadArchive(ValueError):
    """An archive that breaks the format."""


def _uri(value: str | None) -> str:
    return "<urn:record>" if value is None else f"<urn:record:{quote(value, safe='')}>"


def _of_uri(uri: str) -> str | None:
    if uri == "<urn:record>":
        return None
    if not uri.startswith("<urn:record:") or not uri.endswith(">"):
        raise BadArchive(f"not a record id: {uri!r}")
    return unquote(uri[len("<urn:record:") : -1])


def record_bytes(name: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, revisit: bool) -> bytes:
    """One record; a revisit has the HTTP header of the payload and not the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _uri(name)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if url is not None:
        # Control characters and spaces can't stand in a header.
        headers.append(("WARC-Target-URI", quote(url, safe="%/:?#[]@!$&'()*+,;=-._~")))
    if revisit:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _uri(refers_to))]
    else:
        block += payload
    headers.append(("Content-Length", str(len(block))))
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n"
    return head + block + b"\r\n\r\n"


def _headers(data: bytes, where: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in data.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise BadArchive(f"{where}: header line {line[:80]!r}")
        out[name.strip().lower().decode()] = value.strip().decode()
    return out


def _number(headers: dict[str, str], where: str) -> int:
    value = headers.get("content-length", "")
    if not value.isascii() or not value.isdigit():
        raise BadArchive(f"{where}: Content-Length {value!r}")
    return int(value)


def parse_record(data: bytes, where: str) -> dict:
    """Fields of one record; every length and the digest are checked."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    first, _, lines = head.partition(b"\r\n")
    if first != VERSION or not blank:
        raise BadArchive(f"{where}: no record of version {VERSION.decode()}")
    headers = _headers(lines, where)
    missing = {"warc-type", "warc-record-id", "warc-date", "warc-payload-digest"} - set(headers)
    if missing:
        raise BadArchive(f"{where}: without {', '.join(sorted(missing))}")
    size = _number(headers, where)
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise BadArchive(f"{where}: block of {len(rest) - 4} bytes, {size} announced")
    http, blank, payload = block.partition(b"\r\n\r\n")
    status, _, lines = http.partition(b"\r\n")
    if not status.startswith(b"HTTP/") or not blank:
        raise BadArchive(f"{where}: no HTTP response")
    full = _number(_headers(lines, where), where)
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response":
        if len(payload) != full or hashlib.sha256(payload).hexdigest() != digest:
            raise BadArchive(f"{where}: payload does not match its length and digest")
    elif kind != "revisit" or payload or "warc-refers-to" not in headers:
        raise BadArchive(f"{where}: record of type {kind!r}")
    return {
        "id": _of_uri(headers["warc-record-id"]),
        "url": headers.get("warc-target-uri"),
        "date": headers["warc-date"],
        "record_type": kind,
        "refers_to": _of_uri(headers["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
        "payload_bytes": full,
        "payload_digest": digest,
    }


def frames_of(records: Iterable[bytes]) -> Iterator[bytes]:
    """The dictionary frame, then a compressed frame per record."""
    records = iter(records)
    first, size = [], 0
    for record in records:
        first.append(record)
        size += len(record)
        if size >= DICTIONARY_SAMPLE:
            break
    if not first:
        return
    # A record larger than the sample counts with its beginning; the archive holds it whole.
    sample = [r[:DICTIONARY_SAMPLE] for r in first]
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, sample).as_bytes()
    except zstandard.ZstdError:
        # Too few records to train on.
        trained = b""
    yield DICTIONARY_FRAME + len(trained).to_bytes(4, "little") + trained
    press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(trained) if trained else None, write_checksum=True)
    for record in first:
        yield press.compress(record)
    del first, sample
    for record in records:
        yield press.compress(record)


def records_of(archive: bytes, name: str = "archive") -> Iterator[dict]:
    """Parsed records of a whole archive."""
    data, at = memoryview(archive), 0
    dictionary = None
    while at < len(data):
        where = f"{name}, byte {at}"
        magic = int.from_bytes(data[at : at + 4], "little")
        if SKIPPABLE_FIRST <= magic <= SKIPPABLE_LAST:
            size = int.from_bytes(data[at + 4 : at + 8], "little")
            if at + 8 + size > len(data):
                raise BadArchive(f"{where}: frame ends after the archive")
            if at == 0 and bytes(data[:4]) == DICTIONARY_FRAME and size:
                content = bytes(data[8 : 8 + size])
                # The dictionary may itself be compressed.
                if int.from_bytes(content[:4], "little") == DATA_FRAME:
                    content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                dictionary = zstandard.ZstdCompressionDict(content)
            at += 8 + size
            continue
        if magic != DATA_FRAME:
            raise BadArchive(f"{where}: no frame")
        unpress = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj()
        parts = []
        try:
            while not unpress.eof and at < len(data):
                part = data[at : at + CHUNK]
                parts.append(unpress.decompress(part))
                at += len(part) - (len(unpress.unused_data) if unpress.eof else 0)
        except zstandard.ZstdError as error:
            raise BadArchive(f"{where}: {error}") from error
        if not unpress.eof:
            raise BadArchive(f"{where}: frame ends after the archive")
        yield parse_record(b"".join(parts), where)


def write_archives(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> str:
    """Write a record per row to a new folder of archives; returns the folder.

    Of the rows with equal payloads of at least LEAST_SHARED bytes, the one with the smallest id is the response and the
    others revisit it; all other rows are responses. The folder is ``path``, or a new one in the session's shared
    folder. Spark writes the files, so a lost executor's task is written again and never twice; a file holds
    about ARCHIVE_BYTES of payloads, in any order.

    Null markup is an empty payload and a null url gives no header; a null id comes after all others; rows that repeat
    the smallest id and a payload are all responses; an empty table gives an empty folder; other columns are ignored.
    """
    spark = pages.sparkSession
    path = path or f"{shared_dir(spark)}/archives-{uuid.uuid4().hex}"
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).alias("_order"),
        F.col(id_col).cast("string").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
    )
    light = stable(rows.select("_order", "digest", F.octet_length("payload").cast("long").alias("size")))
    volume = light.select(F.sum("size")).first()[0] or 0
    groups = light.where(F.col("size") >= LEAST_SHARED).groupBy("digest").agg(F.min("_order").alias("_first"), F.count(F.lit(1)).alias("_n"))
    shared = stable(groups.where("_n > 1").select(F.col("digest").alias("_d"), "_first"))
    archives = max(int(spark.conf.get("spark.sql.shuffle.partitions")), volume // ARCHIVE_BYTES + 1)
    marked = rows.join(shared, F.col("digest") == F.col("_d"), "left").select(
        "id",
        "url",
        "payload",
        "digest",
        F.col("_first").cast("string").alias("refers_to"),
        (F.col("_d").isNotNull() & ~F.col("_order").eqNullSafe(F.col("_first"))).alias("revisit"),
    )

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for row in zip(*[batch.column(c) for c in ("id", "url", "payload", "digest", "refers_to", "revisit")], strict=True):
                    yield record_bytes(*[v.as_py() for v in row])

        held, size = [], 0
        for frame in frames_of(records()):
            held.append(frame)
            size += len(frame)
            if size >= 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(held, type=pa.binary())], ["frame"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, type=pa.binary())], ["frame"])

    frames = marked.repartition(archives).mapInArrow(pack, "frame binary")
    frames.select(F.col("frame").cast("string")).write.option("lineSep", EMPTY_FRAME).text(path)
    return path


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives in a folder.

    Columns: id, url, date, record_type, refers_to (ids as text), payload (null for a revisit), payload_bytes and
    payload_digest of the full payload. Frames, headers, lengths and digests are checked; a broken archive ends the job
    with its name and the place. Files without a byte have no records.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").schema("path string, modificationTime timestamp, length long, content binary").load(path)

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in RECORD.split(", ")]
        kinds = [pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string() for n in names]
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                held, size = [], 0
                for record in records_of(content.as_py(), name.as_py()):
                    held.append(record)
                    size += len(record["payload"] or b"")
                    if size >= 4 << 20:
                        yield _table(held, names, kinds)
                        held, size = [], 0
                yield _table(held, names, kinds)

    return files.select("path", "content").mapInArrow(unpack, RECORD)


def _table(records: list[dict], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in records], type=k) for n, k in zip(names, kinds, strict=True)], names)
