"""WARC archives: writing pages as records, and reading the archives back record by record.

An archive is a file of gzip members, one per record, as the format asks. Tasks pack records
into archives of about ``ARCHIVE_BYTES``. Spark writes and reads the files, so they may lie in
any store that Spark knows; an archive is one row while it is read, which is why its size is
bounded. (Spark's text writer ends every row with a separator. The last byte of a gzip member is
the top byte of its length, zero for records under 16 MB, so that byte is left to the writer;
after a larger record it becomes padding, which gzip readers skip.)

The reader decompresses a member in pieces, finds the block by its Content-Length and checks the
digests of block and payload.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeframe.sources.scratch import materialize

ARCHIVE_BYTES = 8 * 1024 * 1024
PIECE = 64 * 1024
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:gaugeframe:record:"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")

SCHEMA = ("record_id string, record_type string, target_uri string, refers_to string, "
          "payload_digest string, payload_bytes long, payload binary, verified boolean")


class WarcError(ValueError):
    """An archive that breaks the format."""


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def make_record(record_id, uri, payload: bytes, refers_to=None) -> bytes:
    """One response, or one revisit that keeps the headers but not the payload."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <{_URN}{'' if record_id is None else record_id}>",
            "WARC-Date: 2000-01-01T00:00:00Z", "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: sha1:{digest(payload)}",
            f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}"]
    if uri is not None:
        # A header value holds no white space or control characters.
        head.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", uri))
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_URN}{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _records(archive: bytes):
    """The records of an archive, each from a gzip member of its own, read piece by piece."""
    view, at = memoryview(archive), 0
    while at < len(view):
        if view[at] == 0:  # padding
            at += 1
            continue
        unpack, out = zlib.decompressobj(31), []
        while not unpack.eof:
            piece = view[at : at + PIECE]
            if not len(piece):
                raise WarcError("an archive ends inside a record")
            try:
                out.append(unpack.decompress(piece))
            except zlib.error as e:
                raise WarcError(f"a record is not a gzip member: {e}") from e
            at += len(piece) - len(unpack.unused_data)
        yield b"".join(out)


def _headers(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def parse_record(data: bytes) -> tuple:
    """The fields of ``SCHEMA``; raises ``WarcError`` where the framing is broken."""
    head, sep, rest = data.partition(b"\r\n\r\n")
    if not sep or not head.startswith(b"WARC/1."):
        raise WarcError("a record does not begin with a WARC header")
    named = _headers(head)
    length = named.get("content-length", "")
    if not length.isdigit() or rest[int(length):] != b"\r\n\r\n":
        raise WarcError("a record's block does not end where its Content-Length says")
    block = rest[: int(length)]
    kind = named.get("warc-type")
    said = named.get("warc-payload-digest", "").removeprefix("sha1:") or None
    ok = named.get("warc-block-digest") in (None, f"sha1:{digest(block)}")
    payload, size = block, len(block)
    if "application/http" in named.get("content-type", ""):
        http, sep, payload = block.partition(b"\r\n\r\n")
        if not sep:
            raise WarcError("an HTTP block has no end of headers")
        stated = _headers(http).get("content-length", "")
        size = int(stated) if kind == "revisit" and stated.isdigit() else len(payload)
        ok = ok and (kind == "revisit" or not stated or int(stated) == size)
    if kind == "revisit":
        payload = None
    else:
        ok = ok and said in (None, digest(payload))
    strip = lambda v: v and v.strip("<>").removeprefix(_URN)
    return (strip(named.get("warc-record-id")), kind, named.get("warc-target-uri"),
            strip(named.get("warc-refers-to")), said, size, payload, ok)


def write_warc(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write ``pages (record_id, uri, payload binary, refers_to)`` as archives under ``path``.

    ``refers_to`` is null for a response. A null payload is empty.
    """
    columns = ["record_id", "uri", "payload", "refers_to"]
    pages = pages.select(*[F.col(c).cast("binary" if c == "payload" else "string") for c in columns])

    def run(batches):
        packed, size = [], 0
        for batch in batches:
            for record, uri, payload, refers in zip(*[c.to_pylist() for c in batch.columns]):
                packed.append(gzip_member(make_record(record, uri, payload or b"", refers)))
                size += len(packed[-1])
                if size >= archive_bytes:
                    yield _archive(packed)
                    packed, size = [], 0
        if packed:
            yield _archive(packed)

    archives = pages.mapInArrow(run, "archive binary")
    archives.select(F.col("archive").cast("string").alias("value")).write.option(
        "lineSep", "\0").option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def _archive(packed: list[bytes]) -> pa.RecordBatch:
    data = b"".join(packed)
    data = data[:-1] if data.endswith(b"\0") else data
    return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["archive"])


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """A row per record of the archives under ``path``, see ``SCHEMA``.

    ``payload_bytes`` is that of the full payload, also for a revisit, whose payload is null.
    ``verified`` tells whether digests and lengths agree. Without ``payload`` the payloads are
    checked but not returned. A broken archive fails the job.
    """
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    types = [pa.string()] * 5 + [pa.int64(), pa.binary(), pa.bool_()]
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches):
        for batch in batches:
            for archive in batch.column(0):
                rows, size = [], 0
                for data in _records(archive.as_buffer().to_pybytes()):
                    row = parse_record(data)
                    rows.append(row if payload else (*row[:6], None, row[7]))
                    size += len(data)
                    if size >= ARCHIVE_BYTES and payload:
                        yield _rows(rows, names, types)
                        rows, size = [], 0
                if rows:
                    yield _rows(rows, names, types)

    return files.mapInArrow(run, SCHEMA)


def _rows(rows, names, types) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], types[k]) for k in range(len(names))], names=names)


def as_records(pages: DataFrame) -> DataFrame:
    """``pages (page_id, url, html)`` as rows for ``write_warc``.

    Of pages with equal payloads that with the largest page_id is the response and the others
    revisit it. Null html is an empty payload. A row that repeats the response's page_id is a
    response as well, and so are equal payloads none of which has an id.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    # Only payloads that occur again travel; the table is stored, so that the join with it can
    # be split where a payload has very many copies.
    again = materialize(
        rows.groupBy("sha").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where(
            "n > 1 AND first IS NOT NULL").select(F.col("sha").alias("of"), "first"), "repeated")
    return rows.join(again, rows["sha"] == again["of"], "left").select(
        F.col("page_id").alias("record_id"), F.col("url").alias("uri"), "payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))
