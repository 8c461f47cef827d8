"""Web archives with a dictionary inside, and their reader.

An archive is a sequence of Zstandard frames: a skippable frame that holds the dictionary, then one frame for each
record, compressed with it.  Every writing task trains the dictionary of its archive from the first records that go
into it, so archives stand alone.  Records of equal payload are stored once: the page with the largest
id as a response, the others as revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.graph import store
from sluiceway.llm.skew import attach

# Fixed by the format.
DICTIONARY_MAGIC = 0x184D2A5D
CRLF = b"\r\n"

ARCHIVE_BYTES = 32 * 1024 * 1024  # of records before compression; an archive is closed beyond this
SAMPLE_BYTES = 1024 * 1024  # of the first records of an archive, for its dictionary
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
MIN_REVISIT_BYTES = 0


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def make_record(page_id, url, payload: bytes, keep_id) -> bytes:
    """A response with the payload, or a revisit of page `keep_id` without it."""
    revisit = keep_id is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group(0)):02X}", url or "")
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
    ]
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_id(keep_id)}")
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + CRLF * 2 + block + CRLF * 2


def parse_record(record: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of one record.

    A response's length and digest are computed from its payload and must equal the header's.
    """
    head, _, rest = record.partition(CRLF * 2)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(CRLF * 2)
    length = int(re.search(rb"Content-Length: (\d+)", http).group(1))
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or sha1_base32(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def page(text: str | None):
        digits = (text or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    return {
        "page_id": page(fields["WARC-Record-ID"]), "payload_bytes": length, "payload_digest": digest,
        "record_type": kind, "refers_to": page(fields.get("WARC-Refers-To")),
    }


def train_dictionary(records: list[bytes]) -> bytes:
    """A Zstandard dictionary of the given records; too few records serve as raw content themselves."""
    import zstandard

    pieces = [r[at : at + 4096] for r in records for at in range(0, len(r), 4096)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[:DICTIONARY_BYTES]


# Tasks write through pyarrow, which knows these stores; s3a and s3n are other names of s3, with the machine's credentials.
SCHEMES = ("file", "hdfs", "viewfs", "s3", "s3a", "s3n", "gs", "gcs", "abfs", "abfss")


def check_folder(folder: str) -> str:
    """The folder, if tasks can write archives there; else an error before any task starts."""
    scheme = folder.partition(":")[0] if ":" in folder.partition("/")[0] else "file"
    if scheme not in SCHEMES:
        raise ValueError(f"archives cannot be written to {scheme}: paths; give a folder on one of {', '.join(SCHEMES)}")
    return folder


def _file_system(path: str):
    if path.startswith(("s3a://", "s3n://")):
        path = "s3" + path[3:]
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class ArchiveWriter:
    """Writes one archive; the first SAMPLE_BYTES of records wait for the dictionary made of them.

    The file gets its name when it is complete, so a task that dies leaves no archive.
    """

    def __init__(self, folder: str):
        self.fs, base = _file_system(folder)
        self.name = f"part-{uuid.uuid4().hex}.warc.zst"
        self.path, self.waiting, self.size, self.count = f"{base}/{self.name}", [], 0, 0
        self.fs.create_dir(base, recursive=True)
        self.out, self.compressor = self.fs.open_output_stream(self.path + ".open", compression=None), None

    def _start(self) -> None:
        import zstandard

        data = train_dictionary(self.waiting)
        self.out.write(struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(data))
        for record in self.waiting:
            self.out.write(self.compressor.compress(record))
        self.waiting = []

    def add(self, record: bytes) -> None:
        self.size, self.count = self.size + len(record), self.count + 1
        if self.compressor:
            self.out.write(self.compressor.compress(record))
        else:
            self.waiting.append(record)
            if self.size >= SAMPLE_BYTES:
                self._start()

    def close(self) -> str:
        if not self.compressor:
            self._start()
        self.out.close()
        self.fs.move(self.path + ".open", self.path)
        return self.name


def read_records(stream) -> Iterator[bytes]:
    """Records of an archive, one at a time."""
    import zstandard

    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary at the start of the archive")
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stream.read(size)))
    rest = b""
    while True:
        one, out = decompressor.decompressobj(), io.BytesIO()
        while not one.eof:
            data = rest or stream.read(1 << 20)
            rest = b""
            if not data:
                if out.tell():
                    raise ValueError("the archive ends inside a record")
                return
            out.write(one.decompress(data))
        rest = one.unused_data
        yield out.getvalue()


def _write(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None

        def done():
            return pa.RecordBatch.from_arrays(
                [pa.array([writer.close()]), pa.array([writer.count], pa.int64())], ["archive", "records"]
            )

        for batch in batches:
            for page_id, url, html, keep_id in zip(*batch.columns):
                writer = writer or ArchiveWriter(folder)
                payload = (html.as_py() or "").encode()
                writer.add(make_record(page_id.as_py(), url.as_py(), payload, keep_id.as_py()))
                if writer.size >= ARCHIVE_BYTES:
                    yield done()
                    writer = None
        if writer:
            yield done()

    return write


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES, id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages as archives below `folder` (shared by all executors); returns (archive, records).

    Null html is an empty payload; null urls are written empty.  Of equal payloads of at least
    `min_bytes` bytes, the page with the largest id is the response; rows that repeat this id are responses,
    too.  Pages of equal payload without any id are all responses.  An empty table gives no archives.  An archive of so
    few records that no dictionary can be trained takes the first DICTIONARY_BYTES of them as one.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = rows.withColumn("digest", F.unhex(F.sha1(payload)))
    groups = rows.where(F.octet_length(payload) >= min_bytes).groupBy("digest")
    groups = groups.agg(F.max("page_id").alias("last_id"), F.count("*").alias("size")).where("size > 1")
    rows = attach(rows, store(groups, "payloads"), "digest", "size", 64)
    keep = F.when(F.col("last_id").isNotNull() & ~F.col("last_id").eqNullSafe(F.col("page_id")), F.col("last_id"))
    rows = rows.select("page_id", "url", "html", keep.alias("keep_id"))
    return store(rows.mapInArrow(_write(check_folder(folder)), "archive string, records long"), "archives")


def _read(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.int64()),
        ])
        fs, base = _file_system(folder)
        for batch in batches:
            for name in batch.column(0):
                with fs.open_input_stream(f"{base}/{name.as_py()}", compression=None) as stream:
                    found = []
                    for record in read_records(stream):
                        found.append(parse_record(record))
                        if len(found) == 2000:
                            yield pa.RecordBatch.from_pylist(found, schema=schema)
                            found = []
                    if found:
                        yield pa.RecordBatch.from_pylist(found, schema=schema)

    return read


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """One row per record of the listed archives: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Empty payloads, null ids and repeated rows come back as they were written, whole and in any number; without
    archives there are no rows.  A damaged record is an error.
    """
    names = archives.select("archive").repartition(max(1, archives.sparkSession.sparkContext.defaultParallelism * 3))
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return names.mapInArrow(_read(check_folder(folder)), schema)
