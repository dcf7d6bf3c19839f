"""One large JSON array in one file, written and read by many tasks.

Writing: tasks write their elements as parts beside the target; the commit strings them
together in the order of the tasks under a name of its own and renames that over the target,
so a reader sees the old file or the new one. A failed job leaves the old file and no parts.

Reading: ranges of bytes are tasks. An element begins on a line with the white space that the
first element's line begins with, directly before its brace: in JSON, line feeds stand between
tokens only, and inner objects of a printed array stand deeper, or on the element's own line.
A range reads the elements that begin in it, whichever range they end in. An array whose first
element shares its line with the opening bracket has no such borders and is one task.

A compressed file is a row of zstd frames of some elements each, which any zstd reader joins to
the same text. Its last frame is one that readers skip: it lists the bytes and elements of the
others. So a range is whole frames, and knows the place and the number of its first element.

Both see the store through ``pyarrow.fs``: a mounted folder or a URI of a store it knows.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

WRITER, READER = "seatledger_array_writer", "seatledger_array"
CHUNK = 1 << 20
#: Elements that a task hands over at a time.
BATCH = 4096
#: First bytes of a zstd frame and of one that readers skip, and the last ones of the index; entries of the index: bytes in the file, bytes of text, elements.
ZSTD, SKIPPED, INDEXED, ENTRY = b"\x28\xb5\x2f\xfd", b"\x5e\x2a\x4d\x18", b"SLAX", "<III"


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def _frame(text: bytes) -> bytes:
    return pa.Codec("zstd", 1).compress(text, asbytes=True)


@dataclass
class Part(WriterCommitMessage):
    task: int
    path: str
    rows: int
    frames: list[tuple[int, int, int]] = field(default_factory=list)


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, compressed: bool):
        self.path, self.job, self.compressed = path, uuid.uuid4().hex, compressed

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        from pyspark import TaskContext

        store, path = _store(self.path)
        task = TaskContext.get()
        done = Part(task.partitionId(), f"{path}.{self.job}/{task.partitionId():06d}-{task.taskAttemptId()}", 0)
        held, size = [], 0
        store.create_dir(f"{path}.{self.job}", recursive=True)
        with store.open_output_stream(done.path) as out:

            def flush() -> None:
                text = b"".join(held)
                data = _frame(text) if self.compressed else text
                out.write(data)
                done.frames.append((len(data), len(text), len(held)))

            for batch in iterator:
                for element in batch.column(0).to_pylist():
                    held.append((",\n" if done.rows else "").encode() + element.encode())
                    size += len(held[-1])
                    done.rows += 1
                    if size >= CHUNK:
                        flush()
                        held, size = [], 0
            if held:
                flush()
        return done

    def commit(self, messages: list[Part | None]) -> None:
        store, path = _store(self.path)
        own, first, frames = f"{path}.{self.job}/whole", True, []
        store.create_dir(f"{path}.{self.job}", recursive=True)
        with store.open_output_stream(own) as out:

            def mark(text: bytes) -> None:
                data = _frame(text) if self.compressed else text
                out.write(data)
                frames.append((len(data), len(text), 0))

            mark(b"[")
            for part in sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.task):
                mark(b"\n" if first else b",\n")
                first = False
                with store.open_input_stream(part.path) as source:
                    while chunk := source.read(CHUNK):
                        out.write(chunk)
                store.delete_file(part.path)  # so that the array is held once
                frames += part.frames
            mark(b"]\n" if first else b"\n]\n")
            if self.compressed:
                index = b"".join(struct.pack(ENTRY, *f) for f in frames) + struct.pack("<I", len(frames)) + INDEXED
                out.write(SKIPPED + struct.pack("<I", len(index)) + index)
        store.move(own, path)
        store.delete_dir(f"{path}.{self.job}")

    def abort(self, messages: list[Part | None]) -> None:
        from pyarrow import fs

        store, path = _store(self.path)
        if store.get_file_info(f"{path}.{self.job}").type == fs.FileType.Directory:
            store.delete_dir(f"{path}.{self.job}")


class ArrayWriter(DataSource):
    """A sink of one string column, each value a JSON text without line feeds."""

    @classmethod
    def name(cls) -> str:
        return WRITER

    def schema(self) -> str:
        return "element string"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], self.options.get("compressed", "false") == "true")


@dataclass
class Range(InputPartition):
    lo: int
    hi: int
    indent: bytes | None


@dataclass
class Frames(InputPartition):
    """Frames of a compressed file: where they begin there, their entries, and the place and number of their first element."""

    at: int
    entries: list[tuple[int, int, int]]
    place: int
    number: int


class _Reader(DataSourceReader):
    def __init__(self, path: str, size: int):
        self.path, self.size = path, size

    def partitions(self) -> list[Range]:
        store, path = _store(self.path)
        total = store.get_file_info(path).size
        with store.open_input_file(path) as f:
            head = f.read(1 << 16)
            if head.startswith(ZSTD):
                return self._frames(f, total)
        before = head[head.index(b"[") + 1 :].split(b"{", 1)[0] if b"{" in head else b""
        if b"\n" not in before or before.strip():
            return [Range(0, total, None)]
        indent = before.rsplit(b"\n", 1)[1]
        return [Range(lo, min(lo + self.size, total), indent) for lo in range(0, total, self.size)]

    def _frames(self, f, total: int) -> list[Frames]:
        f.seek(total - 8)
        n, ends = struct.unpack("<I4s", f.read(8))
        if ends != INDEXED:
            raise ValueError(f"{self.path} has no index of its frames")
        f.seek(total - 8 - n * struct.calcsize(ENTRY))
        out, at, place, number, size = [Frames(0, [], 0, 0)], 0, 0, 0, 0
        for entry in struct.iter_unpack(ENTRY, f.read(n * struct.calcsize(ENTRY))):
            if size >= self.size:
                out.append(Frames(at, [], place, number))
                size = 0
            out[-1].entries.append(entry)
            at, place, number, size = at + entry[0], place + entry[1], number + entry[2], size + entry[1]
        return out

    def read(self, partition: Range | Frames) -> Iterator[pa.RecordBatch]:
        rows = self._read(partition)
        while some := list(islice(rows, BATCH)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)], names=["place", "number", "element"])

    def _read(self, partition: Range | Frames) -> Iterator[tuple]:
        """place, number (null where nothing counts them) and text of the elements of a range."""
        if isinstance(partition, Frames):
            yield from self._unpacked(partition)
            return
        for place, element in self._plain(partition):
            yield place, None, element

    def _unpacked(self, r: Frames) -> Iterator[tuple]:
        store, path = _store(self.path)
        place, number = r.place, r.number
        with store.open_input_file(path) as f:
            f.seek(r.at)
            for packed, size, n in r.entries:
                data = f.read(packed)
                if n:
                    at = place
                    for line in pa.Codec("zstd").decompress(data, size, asbytes=True).split(b"\n"):
                        element = line.removesuffix(b",")
                        if element:
                            yield at, number, element.decode()
                            number += 1
                        at += len(line) + 1
                place += size

    def _plain(self, partition: Range) -> Iterator[tuple]:
        store, path = _store(self.path)
        with store.open_input_file(path) as f:
            if partition.indent is None:
                text, at, decoder = f.read().decode(), 0, json.JSONDecoder()
                at = text.index("[") + 1
                while (at := next((i for i in range(at, len(text)) if text[i] not in " \t\r\n,"), len(text))) < len(text) and text[at] != "]":
                    _, end = decoder.raw_decode(text, at)
                    yield len(text[:at].encode()), text[at:end]
                    at = end
                return
            yield from _elements(f, partition)


def _elements(f, r: Range) -> Iterator[tuple]:
    """Place and text of the elements that begin in a range."""
    border = b"\n" + r.indent + b"{"
    f.seek(r.lo)
    held, at = b"", r.lo  # ``at`` is the place of held[0]
    started = False
    while True:
        more = f.read(CHUNK)
        held += more
        while True:
            if not started:
                i = held.find(border)
                if i < 0:
                    keep = len(border) - 1
                    at, held = at + max(0, len(held) - keep), held[-keep:] if len(held) > keep else held
                    break
                if at + i >= r.hi:
                    return
                at, held, started = at + i, held[i:], True
            j = held.find(border, 1)
            if j < 0:
                break
            yield at + 1 + len(r.indent), held[:j].strip().rstrip(b",").decode()
            if at + j >= r.hi:
                return
            at, held = at + j, held[j:]
        if not more:
            if started:
                yield at + 1 + len(r.indent), held.strip().removesuffix(b"]").strip().decode()
            return
        if not started and at >= r.hi:
            return


class ArrayFile(DataSource):
    """place long, number long (from 0; of a compressed file), element string of a JSON array file; option ``range_bytes``."""

    @classmethod
    def name(cls) -> str:
        return READER

    def schema(self) -> str:
        return "place long, number long, element string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("range_bytes", 64 << 20)))


def export(df: DataFrame, element: Column, order: list[Column], path: str, compressed: bool = False) -> None:
    """``element`` (a JSON text) of every row as one array, in ``order``: a range sort gives tasks their share."""
    spark = df.sparkSession
    spark.dataSource.register(ArrayWriter)
    df.orderBy(*order).select(element.alias("element")).write.format(WRITER).option("compressed", compressed).mode("append").save(path)


def _read(spark: SparkSession, path: str, range_bytes: int) -> DataFrame:
    spark.dataSource.register(ArrayFile)
    return spark.read.format(READER).option("range_bytes", range_bytes).load(path)


def read(spark: SparkSession, path: str, schema: str, range_bytes: int = 64 << 20) -> DataFrame:
    """place and the fields of ``schema`` of the elements of an array file; places rise with the order of the array."""
    rows = _read(spark, path, range_bytes)
    return rows.select("place", F.from_json("element", schema).alias("e")).select("place", "e.*")


def numbered(spark: SparkSession, path: str, schema: str, range_bytes: int = 64 << 20) -> DataFrame:
    """number (from 0) and the fields of ``schema`` of the elements of a compressed array file."""
    rows = _read(spark, path, range_bytes)
    return rows.select("number", F.from_json("element", schema).alias("e")).select("number", "e.*")
