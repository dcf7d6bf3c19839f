"""WARC archives with Zstandard: one frame for each record, the dictionary in front.

An archive starts with a skippable frame that holds the dictionary; every
record is a frame of its own, compressed with it, so a record can be read
without those before it. Archives are byte strings of bounded size in a table
of the shared folder; :func:`read_files` reads archives that are files.

Defined results: a null page has an empty payload; equal page ids with equal
payloads are all the response, since the smallest id decides; a null id is
never referred to unless no row of the group has one, and such rows are
responses; an empty table gives an empty one; other columns are ignored.
Malformed archives raise ValueError with the record and the reason.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean_batches, map_batches, materialise, utf8

# Fixed values of the format: the dictionary's skippable frame, and the magic of a frame.
DICT_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"
LEAST_REVISIT = 100
#: Bytes that the reader takes at a time.
SLICE = 16 << 10


def train(samples: list[bytes], size: int = 32 * 1024):
    """A dictionary from sample payloads, or None where they are too few to train one."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, [s for s in samples if s], level=3)
    except zstandard.ZstdError:
        return None


@dataclass(frozen=True)
class Record:
    kind: str
    headers: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        """The block without its HTTP header."""
        return self.block.split(CRLF + CRLF, 1)[1]


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One record. A revisit carries the HTTP header of the full payload and no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    name = "null" if page_id is None else str(page_id)
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>", "WARC-Date: 2000-01-01T00:00:00Z",
        f"WARC-Target-URI: {(url or 'about:blank').replace(chr(13), '%0D').replace(chr(10), '%0A')}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(lines).encode() + CRLF + CRLF + block + CRLF + CRLF


class Writer:
    """Frames for one archive; the dictionary frame comes first."""

    def __init__(self, dictionary: bytes | None, level: int = 3):
        import zstandard

        self._c = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None, write_checksum=True, write_content_size=True)
        self.head = struct.pack("<II", DICT_MAGIC, len(dictionary)) + dictionary if dictionary else b""
        self._parts, self.size = [self.head], len(self.head)

    def add(self, record: bytes) -> None:
        frame = self._c.compress(record)
        self._parts.append(frame)
        self.size += len(frame)

    def take(self) -> bytes:
        """The archive so far; the next record starts another."""
        out = b"".join(self._parts)
        self._parts, self.size = [self.head], len(self.head)
        return out

    @property
    def empty(self) -> bool:
        return len(self._parts) == 1


def _frames(data: bytes) -> Iterator[bytes]:
    """The decoded content of each frame, the dictionary loaded from the leading skippable frame."""
    import zstandard

    at, dictionary = 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICT_MAGIC:
        size = struct.unpack_from("<I", data, 4)[0]
        if 8 + size > len(data):
            raise ValueError("the dictionary frame is cut off")
        held = data[8 : 8 + size]
        if held[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary itself may be compressed
            held = zstandard.ZstdDecompressor().decompress(held)
        dictionary, at = zstandard.ZstdCompressionDict(held), 8 + size
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    view, n = memoryview(data), 0
    while at < len(data):
        if len(data) - at < 5 or struct.unpack_from("<I", data, at)[0] != FRAME_MAGIC:
            raise ValueError(f"record {n}: no frame at byte {at}")
        one, parts = reader.decompressobj(), []
        try:
            # Fed in slices: what a frame leaves unused is copied, and must not be the rest of the archive.
            while not one.eof and at < len(data):
                parts.append(one.decompress(view[at : at + SLICE]))
                at = min(at + SLICE, len(data))
        except zstandard.ZstdError as error:
            raise ValueError(f"record {n}: {error}") from None
        if not one.eof:
            raise ValueError(f"record {n}: the frame is cut off")
        yield b"".join(parts)
        at, n = at - len(one.unused_data), n + 1


def parse(content: bytes, n: int = 0) -> Record:
    """One record, its version line, headers and lengths checked."""
    head, sep, rest = content.partition(CRLF + CRLF)
    lines = head.split(CRLF)
    if not sep or not lines[0].startswith(b"WARC/1."):
        raise ValueError(f"record {n}: no WARC header")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"record {n}: malformed header {line!r}")
        headers[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ValueError(f"record {n}: no {name}")
    if not headers["content-length"].isdigit() or len(rest) != int(headers["content-length"]) + 4 or rest[-4:] != CRLF + CRLF:
        raise ValueError(f"record {n}: its length is not its Content-Length")
    record = Record(headers["warc-type"], headers, rest[:-4])
    if record.kind == "response" and "warc-payload-digest" in headers:
        if "sha256:" + hashlib.sha256(record.payload).hexdigest() != headers["warc-payload-digest"]:
            raise ValueError(f"record {n}: the payload does not match its digest")
    return record


def read(data: bytes) -> Iterator[Record]:
    for n, content in enumerate(_frames(data)):
        yield parse(content, n)


def _page(urn: str) -> int | None:
    name = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "null" else int(name)


READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _row(record: Record) -> tuple:
    http = dict(x.split(b": ", 1) for x in record.block.partition(CRLF + CRLF)[0].split(CRLF)[1:])
    size = int(http[b"Content-Length"])
    if record.kind == "response" and size != len(record.payload):
        raise ValueError(f"{record.headers['warc-record-id']}: the payload is not as long as its HTTP header says")
    refers = record.headers.get("warc-refers-to")
    return _page(record.headers["warc-record-id"]), size, record.headers["warc-payload-digest"].removeprefix("sha256:"), record.kind, _page(refers) if refers else None


def write(pages: DataFrame, sample_rows: int = 500, archive_bytes: int = 8 << 20, sample_chars: int = 4096) -> DataFrame:
    """Archives of ``pages`` as a table (archive binary), in the shared folder.

    The dictionary is trained on ``sample_rows`` pages at most, the first ``sample_chars`` of each.
    """
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    sample = [utf8(r["s"]) for r in own.select(F.substring("html", 1, sample_chars).alias("s")).limit(sample_rows).collect()]
    trained = train(sample)
    dictionary = trained.as_bytes() if trained else None
    keyed = own.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)).withColumn("long_enough", F.octet_length("html") >= LEAST_REVISIT)
    # Only ids and digests meet by digest, where a page with many copies is one hot key: minima are combined
    # before the shuffle, and the join of ids has no page in it. Pages then meet their flag by id and digest.
    ids = keyed.where("long_enough and page_id is not null").select("page_id", "digest")
    firsts = ids.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first < last").select("digest", "first")
    again = ids.join(firsts, "digest").where("page_id <> first").distinct().select(F.col("page_id").alias("of_id"), F.col("digest").alias("of"), "first")
    marked = keyed.join(again, (F.col("page_id") == F.col("of_id")) & (F.col("digest") == F.col("of")), "left")
    marked = marked.select("page_id", "url", "html", "digest", F.col("first").isNotNull().alias("again"), F.col("first").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = Writer(dictionary)
        pack = lambda: pa.RecordBatch.from_arrays([pa.array([writer.take()], pa.binary())], names=["archive"])
        for batch in batches:
            for page_id, url, html, digest, again, refers in zip(*batch.columns, strict=True):
                writer.add(record_bytes(page_id.as_py(), url.as_py(), utf8(html.as_py()), digest.as_py(), "revisit" if again.as_py() else "response", refers.as_py()))
                if writer.size >= archive_bytes:
                    yield pack()
        if not writer.empty:
            yield pack()

    lean_batches(pages.sparkSession)
    return materialise(marked.mapInArrow(run, "archive binary"), "warc", "none")


def read_archives(archives: DataFrame, column: str = "archive") -> DataFrame:
    """One row per record of the archives in ``column``: the columns of ``READ_SCHEMA``."""

    def make():
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]

        def step(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
            out = []
            for cell in batch.column(0):
                rows = list(zip(*map(_row, read(cell.as_py() or b"")), strict=True)) or [()] * 5
                out.append(pa.RecordBatch.from_arrays([pa.array(list(v), t) for v, t in zip(rows, types, strict=True)], names=names))
            return out

        return step

    return map_batches(archives.select(F.col(column)), make, READ_SCHEMA)


def read_files(spark, path: str) -> DataFrame:
    """Records of the ``.warc.zst`` files at ``path``, through Spark's own file reader."""
    return read_archives(spark.read.format("binaryFile").load(path), "content")
