"""Token-ID output in training order, as fixed-stride binary shards.

Every text is cut into sequences of ``length`` tokens; a keyed Feistel
permutation with cycle-walking gives each sequence a global slot, so the order
needs no sort key and no shuffle table. Sequences are range-partitioned by slot,
and each range is one flat, uncompressed file of records of one stride: slot s
lies at byte (s - first slot) * stride of its file, so a reader goes on at any
slot with one seek. A record is a header (slot, doc_id, part, tokens, flags,
CRC-32), the tokens as little-endian 16-bit numbers, filled up, and an end mark.

A folder holds ``manifest`` (what was written, from what input), ``tokens`` (the
tokenised texts, which fix the numbering) and ``shards``, written in ``WAVES``
jobs, one after the other, each for its part of the slots. A range is committed
when its task ends. A run that was stopped goes on with the ranges that are
missing; a folder whose manifest tells of another input, key or layout is
refused.

Defined results: a null or empty text is one sequence with the end token only;
repeated rows are sequences of their own; other columns are ignored; an empty
table gives no shard. Texts are tokenised whole, special strings as ordinary text.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _written, map_batches, shared_dir, short_shuffles

LENGTH = 512
#: Bytes of a shard, of which a reading task holds a few copies.
SHARD_BYTES = 2 << 20
#: Jobs that write the shards; the shuffle of one is gone when the next begins.
WAVES = 4
KEY = 0x5EA71ED6E2
VOCABULARY = "byte_bpe_50k.tiktoken"
#: A free id of that vocabulary, for the end of a text; and what fills a record.
END, PAD = 50256, 65535
#: GPT-style splitting of a text before the merges. Fixed value, from the vocabulary's description.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
HEADER = np.dtype([("slot", "<i8"), ("doc_id", "<i8"), ("part", "<u4"), ("n_tokens", "<u4"), ("flags", "<u4"), ("crc32", "<u4")])
#: Flag of a row without a doc_id.
NO_ID = 1
MARK = "\r\n"


def stride(length: int = LENGTH) -> int:
    return HEADER.itemsize + 2 * length + len(MARK)


def slots_of(length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> int:
    """Records of a shard."""
    return max(1, shard_bytes // stride(length))


def vocabulary_path(name: str = VOCABULARY, folder: str = "/opt/tokenizers") -> str:
    return f"{folder}/{name}"


def load_encoder(path: str):
    """The tiktoken encoding of a ranks file, held on the library's module: a worker that is used again loads it once."""
    import base64

    import tiktoken

    held = tiktoken.__dict__.setdefault("_seatledger_encoders", {})
    if path not in held:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        held[path] = tiktoken.Encoding("shards", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return held[path]


def _round(x: np.ndarray, key: int, r: int) -> np.ndarray:
    h = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((key * (2 * r + 1) + r * 0xD1B54A32D192ED03) & ((1 << 64) - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def permute(x: np.ndarray, n: int, key: int = KEY, rounds: int = 6, back: bool = False) -> np.ndarray:
    """The slot of each index in [0, n), or with ``back`` the index of each slot.

    A balanced Feistel network over the next even number of bits; a value that falls
    beyond n is permuted again until it does not, which keeps it a bijection on [0, n).
    """
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = np.asarray(x, np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for r in reversed(range(rounds)) if back else range(rounds):
            if back:
                left, right = right ^ (_round(left, key, r) & mask), left
            else:
                left, right = right, left ^ (_round(right, key, r) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def tokenise(docs: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """task, first, doc_id, n_tokens, tokens: ``first`` numbers the sequences of a task's rows.

    To be written once: then the numbering is a stored fact, and a lost executor changes nothing.
    """

    def make():
        from pyspark import TaskContext

        encoder, task, first = load_encoder(path), TaskContext.get().partitionId(), 0

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal first
            firsts, sizes, out = [], [], []
            for cell in batch.column(1):
                ids = np.array(encoder.encode_ordinary(cell.as_py() or "") + [END], "<u2")
                firsts.append(first)
                first += -(-len(ids) // length)
                sizes.append(len(ids))
                out.append(ids.tobytes())
            return pa.RecordBatch.from_arrays([pa.array([task] * batch.num_rows, pa.int32()), pa.array(firsts, pa.int64()), batch.column(0), pa.array(sizes, pa.int64()), pa.array(out, pa.binary())], names=["task", "first", "doc_id", "n_tokens", "tokens"])

        return step

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, TOKENS, 500)


TOKENS = "task int, first long, doc_id long, n_tokens long, tokens binary"


def numbering(tokenised: DataFrame, length: int = LENGTH) -> tuple[dict[int, int], int]:
    """The number of the first sequence of each task, and how many sequences there are."""
    per_task = tokenised.groupBy("task").agg(F.sum(F.ceil(F.col("n_tokens") / length)).alias("n"))
    # One row for each task of the tokenising stage comes to the driver.
    offsets, total = {}, 0
    for task, n in sorted((r["task"], r["n"]) for r in per_task.collect()):
        offsets[task] = total
        total += n
    return offsets, total


def sequences(tokenised: DataFrame, offsets: dict[int, int], total: int, length: int = LENGTH, key: int = KEY, first: int = 0, end: int | None = None) -> DataFrame:
    """slot and record (header and tokens, not filled up) of the sequences with slots from ``first`` up to ``end``."""
    end = total if end is None else end

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n = batch.column(3).to_numpy()
            parts = -(-n // length)
            row = np.repeat(np.arange(len(n)), parts)
            part = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = np.array([offsets[t] for t in batch.column(0).to_pylist()], np.int64) + batch.column(1).to_numpy()
            slot = permute((start[row] + part).astype(np.uint64), total, key)
            own = np.flatnonzero((slot >= first) & (slot < end))
            row, part, head = row[own], part[own], np.zeros(len(own), HEADER)
            head["slot"], head["part"], head["n_tokens"] = slot[own], part, np.minimum(length, n[row] - part * length)
            ids = batch.column(2)
            head["doc_id"], head["flags"] = ids.fill_null(0).to_numpy()[row], np.where(ids.is_null().to_numpy(zero_copy_only=False)[row], NO_ID, 0)
            cells = batch.column(4).to_pylist()
            bodies = [cells[r][2 * length * p : 2 * length * (p + 1)] for r, p in zip(row.tolist(), part.tolist(), strict=True)]
            head["crc32"] = [zlib.crc32(b) for b in bodies]
            raw = head.tobytes()
            records = [raw[k * HEADER.itemsize : (k + 1) * HEADER.itemsize] + body for k, body in enumerate(bodies)]
            return pa.RecordBatch.from_arrays([pa.array(slot[own], pa.int64()), pa.array(records, pa.binary())], names=["slot", "record"])

        return step

    return map_batches(tokenised.select("task", "first", "doc_id", "n_tokens", "tokens"), make, "slot long, record binary", 500)


def _files(spark: SparkSession, path: str, per_wave: int) -> DataFrame:
    """shard, length and content of the files of a shard folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
    place = lambda pattern: F.regexp_extract("path", pattern, 1).cast("int")
    return files.where("length > 0").select((place(r"wave-(\d+)/") * per_wave + place(r"part-(\d+)")).alias("shard"), "length", "content")


def _missing(error: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(error)


def layout(total: int, length: int, shard_slots: int | None) -> tuple[int, int, int]:
    """Slots of a shard, shards, and shards of a wave."""
    slots = shard_slots or slots_of(length)
    shards = -(-total // slots)
    return slots, shards, max(1, -(-shards // WAVES))


def finished(spark: SparkSession, path: str, per_wave: int) -> DataFrame:
    """shard of every range that is committed."""
    try:
        return _files(spark, path, per_wave).select("shard").distinct()
    except Exception as error:  # no folder there yet
        if not _missing(error):
            raise
        return spark.createDataFrame([], "shard int")


def write_shards(part_of: Callable[[int, int], DataFrame], spark: SparkSession, total: int, path: str, length: int = LENGTH, shard_slots: int | None = None) -> None:
    """One file for each range of ``shard_slots`` slots, in waves; ranges that are there are left as they are.

    ``part_of`` has the sequences between two slots. A task's file is moved in place when the
    task commits (version 2 of the committer), so what is finished outlives a run that fails.
    """
    slots, shards, per_wave = layout(total, length, shard_slots)
    done = finished(spark, path, per_wave)
    filled = F.rpad("record", F.lit(stride(length) - len(MARK)), F.lit(bytearray(b"\xff")))
    for wave, first in enumerate(range(0, shards, per_wave)):
        end = min(shards, first + per_wave)
        mine = done.where((F.col("shard") >= first) & (F.col("shard") < end)).select((F.col("shard") - first).alias("shard"))
        n_done = mine.count()
        if n_done == end - first:
            continue
        rows = part_of(first * slots, min(total, end * slots)).withColumn("shard", (F.floor(F.col("slot") / slots) - first).cast("int"))
        if n_done:
            rows = rows.join(mine, "shard", "left_anti")
        ordered = rows.repartitionById(end - first, F.col("shard")).sortWithinPartitions("slot").select(filled.cast("string").alias("value"))
        with short_shuffles(spark):
            ordered.write.mode("append").option("lineSep", MARK).option("compression", "none").option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(f"{path}/wave-{wave:02d}")


RECORDS = "slot long, shard int, byte_offset long, doc_id long, part int, n_tokens int, crc32 long, tokens binary"


def read_shards(spark: SparkSession, path: str, total: int, length: int = LENGTH, shard_slots: int | None = None, first_slot: int = 0) -> DataFrame:
    """A row (columns of ``RECORDS``) for each record from ``first_slot`` on; files before it are not opened.

    Fails where a range is missing or twice there, or where a record is not at its place or does not match its CRC-32.
    """
    slots, shards, per_wave = layout(total, length, shard_slots)
    if not shards:
        return spark.createDataFrame([], RECORDS)
    files = _files(spark, path, per_wave)
    there = files.agg(F.count("*").alias("n"), F.count_distinct("shard").alias("d")).first()
    if there["n"] != shards or there["d"] != shards:
        raise ValueError(f"{there['n']} files with {there['d']} of {shards} ranges")
    record = np.dtype([("head", HEADER), ("tokens", f"V{2 * length}"), ("mark", f"V{len(MARK)}")])

    def make():
        def step(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
            out = []
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = content.as_py()
                n = min(slots, total - shard * slots)
                if len(raw) != n * record.itemsize:
                    raise ValueError(f"shard {shard} is damaged: {len(raw)} bytes for {n} records")
                head = np.frombuffer(raw, record)["head"]
                tokens = [raw[at : at + 2 * k] for at, k in zip(range(HEADER.itemsize, len(raw), record.itemsize), head["n_tokens"].tolist(), strict=True)]
                crc = [zlib.crc32(t) for t in tokens]
                if (head["slot"] != np.arange(n) + shard * slots).any() or crc != head["crc32"].tolist():
                    raise ValueError(f"shard {shard} is damaged")
                keep = slice(max(0, first_slot - shard * slots), n)
                ids = pa.array(head["doc_id"].copy(), pa.int64(), mask=(head["flags"] & NO_ID).astype(bool))
                offsets = np.arange(n, dtype=np.int64) * record.itemsize
                cols = [pa.array(head["slot"].copy()), pa.array(np.full(n, shard, np.int32)), pa.array(offsets), ids, pa.array(head["part"].astype(np.int32)), pa.array(head["n_tokens"].astype(np.int32)), pa.array(crc, pa.int64()), pa.array(tokens, pa.binary())]
                out.append(pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in RECORDS.split(", ")]).slice(keep.start))
            return out

        return step

    return map_batches(files.where(F.col("shard") >= first_slot // slots).select("shard", "content"), make, RECORDS, 1)


def _manifest(spark: SparkSession, out: str) -> dict | None:
    try:
        lines = spark.read.text(f"{out}/manifest").collect()
    except Exception as error:
        if not _missing(error):
            raise
        return None
    return json.loads(lines[0]["value"]) if lines else None


def write(docs: DataFrame, out: str, path: str | None = None, length: int = LENGTH, shard_slots: int | None = None, key: int = KEY) -> dict:
    """Tokenise, permute and write the shards at ``out``, or what is missing of them; the manifest."""
    spark, vocabulary, slots = docs.sparkSession, path or vocabulary_path(), shard_slots or slots_of(length)
    rows = docs.agg(F.count("*").alias("n"), F.sum(F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).cast("decimal(38,0)")).alias("digest")).first()
    mine = {"rows": rows["n"], "digest": str(rows["digest"]), "vocabulary": vocabulary.rsplit("/", 1)[-1], "length": length, "shard_slots": slots, "key": key}
    found = _manifest(spark, out)
    if found is None:
        tokenise(docs, vocabulary, length).write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/tokens")
    elif {k: found.get(k) for k in mine} != mine:
        raise ValueError(f"{out} holds shards of other input: {found}, not {mine}")
    stored = spark.read.schema(TOKENS).parquet(f"{out}/tokens")
    offsets, total = numbering(stored, length)
    if found is None:
        found = mine | {"total": total}
        spark.createDataFrame([(json.dumps(found),)], "value string").coalesce(1).write.text(f"{out}/manifest")
    write_shards(lambda first, end: sequences(stored, offsets, total, length, key, first, end), spark, total, f"{out}/shards", length, slots)
    return found


def read(spark: SparkSession, out: str, first_slot: int = 0) -> DataFrame:
    """The records of a folder that :func:`write` has filled, from ``first_slot`` on."""
    m = _manifest(spark, out)
    return read_shards(spark, f"{out}/shards", m["total"], m["length"], m["shard_slots"], first_slot)


def materialised_order(docs: DataFrame, path: str | None = None, length: int = LENGTH, shard_slots: int | None = None, key: int = KEY, out: str | None = None) -> DataFrame:
    """Write the shards and read them back; without ``out`` into a new folder of the session's shared one."""
    import uuid

    spark = docs.sparkSession
    if out is None:
        out = f"{shared_dir(spark)}/seatledger/shards-{uuid.uuid4().hex}"
        _written.setdefault(spark, []).append(out)
    write(docs, out, path, length, shard_slots, key)
    return read(spark, out)
