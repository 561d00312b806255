"""WARC archives as seekable Zstandard bundles.

A bundle is a valid ``.warc.zst`` file: independent Zstandard frames, each
with whole WARC records, then a seek table in a skippable frame (the seekable
format: compressed and decompressed size of every frame, and a footer). The
index maps a record identifier to (bundle, frame, offset in the frame), so one
record is read by fetching and decompressing one frame.

Bundles are rows of a table (``bundle_id, archive``) so that they can be
written to and read from any store that Spark reaches; ``archive`` is the
file's bytes. A worker holds one bundle at a time, about ``BUNDLE_BYTES``
compressed, or one record if that is larger.

Pages with equal payloads become one response and revisits that refer to it;
the choice exchanges digests and identifiers only.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, cut_lineage

FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 4 * 1024 * 1024
# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

BUNDLE_SCHEMA = "bundle_id string, n_records long, archive binary, index array<struct<record_id:string,frame:int,offset:long,length:long>>"
_BUNDLE_ARROW = pa.schema(
    [
        ("bundle_id", pa.string()),
        ("n_records", pa.int64()),
        ("archive", pa.binary()),
        ("index", pa.list_(pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))),
    ]
)


# ---- records ---------------------------------------------------------------


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    text = record_id.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "null" else int(text)


def _header_value(text: str) -> str:
    """A value on one line: control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in text)


def make_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record: a response with the payload, or a revisit without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_header_value(url)}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {_record_id(refers_to)}")
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record in a run of whole records."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(headers["Content-Length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError("a record's length does not fit")
        yield headers, data[start:stop]
        at = stop + 4


def split_http(block: bytes) -> tuple[dict[str, str], bytes]:
    """HTTP headers and body of a record's block."""
    head, _, body = block.partition(b"\r\n\r\n")
    return dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:]), body


# ---- bundles ---------------------------------------------------------------


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The skippable frame with (compressed, decompressed) sizes of all frames."""
    body = b"".join(struct.pack("<II", c, d) for c, d in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def read_seek_table(archive: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of each frame, from the footer."""
    n, descriptor, magic = struct.unpack("<IBI", archive[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    width = 12 if descriptor & 0x80 else 8
    at, out, start = 0, [], len(archive) - 9 - n * width
    for i in range(n):
        c, d = struct.unpack_from("<II", archive, start + i * width)
        out.append((at, c, d))
        at += c
    return out


def read_frame(archive: bytes, frame: int) -> bytes:
    at, c, d = read_seek_table(archive)[frame]
    return zstandard.ZstdDecompressor().decompress(archive[at : at + c], max_output_size=d)


def read_record(archive: bytes, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record by its index entry: decompresses its frame alone."""
    return next(parse_records(read_frame(archive, frame)[offset : offset + length]))


class BundleWriter:
    """Collects records into frames and frames into one archive."""

    def __init__(self, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self._zstd = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self._frame_bytes = frame_bytes
        self._open = bytearray()
        self._frames: list[bytes] = []
        self._sizes: list[tuple[int, int]] = []
        self.index: list[dict] = []
        self.size = 0

    def add(self, record_id: str, record: bytes) -> None:
        self.index.append({"record_id": record_id, "frame": len(self._frames), "offset": len(self._open), "length": len(record)})
        self._open += record
        if len(self._open) >= self._frame_bytes:
            self._close_frame()

    def _close_frame(self) -> None:
        frame = self._zstd.compress(bytes(self._open))
        self._frames.append(frame)
        self._sizes.append((len(frame), len(self._open)))
        self.size += len(frame)
        self._open.clear()

    def finish(self) -> bytes:
        if self._open:
            self._close_frame()
        return b"".join(self._frames) + seek_table(self._sizes)


# ---- Spark -----------------------------------------------------------------


def _bundler(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, n = TaskContext.get().partitionId(), 0
    writer = BundleWriter()

    def out() -> pa.RecordBatch:
        nonlocal writer, n
        row = {"bundle_id": f"{task:08d}-{n:06d}", "n_records": len(writer.index), "archive": writer.finish(), "index": writer.index}
        writer, n = BundleWriter(), n + 1
        return pa.RecordBatch.from_pylist([row], schema=_BUNDLE_ARROW)

    for b in batches:
        for i in range(b.num_rows):  # one page at a time is held as an object
            page, url, html, refers_to, revisit = (b.column(c)[i].as_py() for c in ("page_id", "url", "html", "refers_to", "revisit"))
            payload = b"" if html is None else html.encode("utf-8")
            writer.add(_record_id(page), make_record(page, url, payload, refers_to, revisit))
            if writer.size >= BUNDLE_BYTES:
                yield out()
    if writer.index:
        yield out()


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of pages whose payload another page, with a
    larger identifier, holds too."""
    small = pages.select("page_id", F.sha2(F.coalesce("html", F.lit("")), 256).alias("digest"))
    kept = small.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 AND refers_to IS NOT NULL")
    return small.join(kept, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def write_bundles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The bundles of all pages (``BUNDLE_SCHEMA``): write them with any writer.

    Of pages with equal payloads the one with the largest identifier is the
    response, the others revisit it. Null html is the empty payload, a null
    url has no target header. Null identifiers are responses only where no
    page of the group has one; repeated identifiers give a record each.
    """
    src = bound_batches(pages).select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    second = revisits(src)
    keyed = src.withColumn("digest", F.sha2(F.coalesce("html", F.lit("")), 256))
    second = second.select(F.col("page_id").alias("r_page"), F.col("digest").alias("r_digest"), "refers_to")
    same = F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("digest") == F.col("r_digest"))
    rows = keyed.join(second, same, "left").select("page_id", "url", "html", "refers_to", F.col("refers_to").isNotNull().alias("revisit"))
    return rows.mapInArrow(_bundler, BUNDLE_SCHEMA)


_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, bundle_id string, frame int, offset long"
_READ_ARROW = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
     ("refers_to", pa.int64()), ("target_uri", pa.string()), ("bundle_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64())]
)


def _reader(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            archive, bundle = b.column("archive")[i].as_py(), b.column("bundle_id")[i].as_py()
            for frame in range(len(read_seek_table(archive))):
                rows, offset = [], 0
                for headers, block in parse_records(read_frame(archive, frame)):
                    http, payload = split_http(block)
                    revisit = headers["WARC-Type"] == "revisit"
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(http["Content-Length"])
                    if not revisit and (payload_digest(payload) != digest or len(payload) != size):
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} differs from its digest")
                    refers = _page_id(headers["WARC-Refers-To"]) if revisit else None
                    rows.append((_page_id(headers["WARC-Record-ID"]), size, digest, headers["WARC-Type"], refers, headers.get("WARC-Target-URI"), bundle, frame, offset))
                    head = sum(len(f"{k}: {v}\r\n".encode()) for k, v in headers.items()) + len("WARC/1.1\r\n")
                    offset += head + 2 + len(block) + 4
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _READ_ARROW)], schema=_READ_ARROW)


def read_bundles(bundles: DataFrame) -> DataFrame:
    """Every record of the bundles, read back frame by frame; a response's
    payload is checked against its digest and length."""
    return bundles.select("bundle_id", "archive").mapInArrow(_reader, _READ)


def bundle_index(bundles: DataFrame) -> DataFrame:
    """(record_id, bundle_id, frame, offset, length) of every record."""
    return bundles.select("bundle_id", F.explode("index").alias("r")).select("r.record_id", "bundle_id", "r.frame", "r.offset", "r.length")


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all pages into bundles in the shared folder and read them back.

    One row per page: page_id, payload_bytes, payload_digest, record_type,
    refers_to, and the record's target_uri, bundle_id, frame and offset. An
    empty table gives no rows; other columns are not read.
    """
    return read_bundles(cut_lineage(write_bundles(pages, id_col, url_col, html_col)))


# base32 of SHA-1: 32 groups of five of its 160 bits
SQL = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, from_hex(sha1(coalesce(html, '')))::BIT::VARCHAR AS bits,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keep
  FROM pages
)
SELECT page_id, octet_length(payload) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT + 4 * substr(bits, 5 * i + 3, 1)::INT
           + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM p
"""
