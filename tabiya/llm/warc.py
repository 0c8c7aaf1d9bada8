"""WARC archives: gzip members per record, written by tasks and read by byte ranges.

Writing: every task writes its rows as ``.warc.gz`` files into a shared
folder and returns one manifest row per file; only files of the manifest
count, so a repeated task leaves at most an orphan. Reading: files are cut
into byte ranges; a task looks for the gzip magic from its range's first byte
on, accepts a candidate only if its decoded head is a WARC version line, and
owns the records whose member starts inside the range. From one member's end
the next start is known, so the rest of the range is read without searching.

Defined cases: null html is an empty payload; a null url has no target header;
null page ids are written as ``null`` and read as null; rows that repeat the
smallest page_id of equal payloads are responses too; payloads under
``LEAST`` bytes are always responses.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, shared_path, stored

LEAST = 100
FILE_BYTES = 32 << 20
RANGE_BYTES = 8 << 20
#: Records carry this date unless the caller gives another one, so that equal input gives equal archives.
DATE = "2024-01-01T00:00:00Z"
MAGIC = b"\x1f\x8b\x08"
_CHUNK = 1 << 18


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _line(name: str, value: str) -> bytes:
    return f"{name}: {value}".replace("\r", "%0D").replace("\n", "%0A").encode() + b"\r\n"


def record(page_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str = DATE) -> bytes:
    """One gzip member holding a response, or a revisit of ``refers_to`` (http head only)."""
    revisit = refers_to is not None
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + _line("Content-Length", str(len(payload))) + b"\r\n")
    block = http if revisit else http + payload
    head = b"WARC/1.1\r\n" + _line("WARC-Type", "revisit" if revisit else "response")
    head += _line("WARC-Record-ID", f"<urn:page:{page_id}>") + _line("WARC-Date", date)
    if url is not None:
        head += _line("WARC-Target-URI", url)
    head += _line("WARC-Payload-Digest", f"sha256:{digest}")
    if revisit:
        head += _line("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head += _line("WARC-Refers-To", f"<urn:page:{refers_to}>")
    head += _line("Content-Type", "application/http; msgtype=response") + _line("Content-Length", str(len(block)))
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(head + b"\r\n" + block + b"\r\n\r\n") + z.flush()


def _writer(folder: str, date: str, file_bytes: int):
    def write(batches):
        store, path = open_folder(folder)
        out, name, size, count = None, "", 0, 0

        def done():
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64()), pa.array([count], pa.int64())], names=["file", "bytes", "records"])

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to")))
            for page_id, url, html, digest, refers_to in rows:
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                data = record(page_id, url, html.encode(), digest, refers_to, date)
                out.write(data)
                size += len(data)
                count += 1
                if size >= file_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return write


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   date: str = DATE, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row into ``folder``; the stored manifest (file, bytes, records)."""
    spark = ship(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    equal = rows.filter(F.octet_length("html") >= LEAST).groupBy(F.col("digest").alias("d")) \
        .agg(F.count("*").alias("n"), F.min("id").alias("first")).filter("n > 1")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    rows = rows.join(equal, F.col("digest") == F.col("d"), "left").select(
        F.coalesce(F.col("id").cast("string"), F.lit("null")).alias("page_id"), "url", "html", "digest", F.when(revisit, F.col("first").cast("string")).alias("refers_to"))
    store, path = open_folder(folder)
    store.create_dir(path, recursive=True)
    return stored(rows.mapInArrow(_writer(folder, date, file_bytes), "file string, bytes bigint, records bigint"), "manifest")


def _member(stream, at: int) -> tuple[bytes, int] | None:
    """The decoded gzip member that starts at ``at`` and the offset after it; None if there is none."""
    stream.seek(at)
    z, out, read = zlib.decompressobj(31), [], 0
    checked = False
    try:
        while not z.eof:
            chunk = stream.read(_CHUNK)
            if not chunk:
                return None
            read += len(chunk)
            out.append(z.decompress(chunk))
            if not checked and sum(map(len, out)) >= 7:
                if not b"".join(out).startswith(b"WARC/1."):
                    return None
                checked = True
    except zlib.error:
        return None
    data = b"".join(out)
    return (data, at + read - len(z.unused_data)) if data.startswith(b"WARC/1.") else None


def members(stream, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, decoded record) of the members that start in [start, end)."""
    at = start
    while at < end:
        found = _member(stream, at) if at > start or _is_magic(stream, at) else None
        if found:
            yield at, found[0]
            at = found[1]
            continue
        at = _next_magic(stream, at + 1, end)


def _is_magic(stream, at: int) -> bool:
    stream.seek(at)
    return stream.read(3) == MAGIC


def _next_magic(stream, at: int, end: int) -> int:
    """The first offset in [at, end) with the gzip magic, or ``end``."""
    while at < end:
        stream.seek(at)
        chunk = stream.read(min(_CHUNK, end - at) + 2)
        k = chunk.find(MAGIC)
        if k >= 0 and at + k < end:
            return at + k
        if len(chunk) < 3:
            break
        at += len(chunk) - 2
    return end


def parse(data: bytes) -> dict:
    """Header fields and payload of a decoded record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    urn = lambda k: fields[k].removeprefix("<urn:page:").removesuffix(">") if k in fields else None
    return {"page_id": urn("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"], "refers_to": urn("WARC-Refers-To"),
            "digest": fields["WARC-Payload-Digest"].removeprefix("sha256:"), "payload_bytes": size, "payload": payload}


def _reader(folder: str):
    names = ["file", "offset", "page_id", "url", "record_type", "refers_to", "digest", "payload_bytes", "payload"]

    def read(batches):
        store, path = open_folder(folder)
        for batch in batches:
            for file, start, end in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "end"))):
                with store.open_input_file(f"{path}/{file}") as stream:
                    rows, size = [], 0
                    for at, data in members(stream, start, end):
                        row = parse(data)
                        if row["record_type"] == "response" and hashlib.sha256(row["payload"]).hexdigest() != row["digest"]:
                            raise ValueError(f"{file}:{at}: the payload does not have its digest")
                        rows.append(row | {"file": file, "offset": at})
                        size += len(row["payload"])
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in rows], schema=SCHEMA)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in rows], schema=SCHEMA)

    return read


SCHEMA = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()),
                    ("refers_to", pa.string()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records of the manifest's files, read by byte ranges: file, offset, page_id, url, record_type, refers_to, digest, payload_bytes, payload."""
    ship(spark)
    ranges = manifest.select("file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    ranges = ranges.select("file", "start", F.least(F.col("start") + range_bytes, "bytes").alias("end"))
    # a given number of partitions: Spark would put the small rows that name the ranges into one task
    ranges = ranges.repartition(max(1, ranges.count()))
    return ranges.mapInArrow(_reader(folder), "file string, offset bigint, page_id string, url string, record_type string, refers_to string, digest string, payload_bytes bigint, payload binary")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` and read the records back."""
    spark = pages.sparkSession
    folder = shared_path(spark, "warc")
    manifest = write_archives(pages, folder)
    return read_archives(spark, folder, manifest)
