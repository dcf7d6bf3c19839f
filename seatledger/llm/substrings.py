"""Exact substring deduplication with suffix arrays.

A byte goes if a 400-byte string that covers it also starts anywhere else. Two
equal strings of 400 bytes choose the same anchor inside (the 64-byte piece
with the smallest hash), so equal strings meet under their anchor's hash.
Each start belongs to one anchor; the starts of an anchor and the bytes their
strings reach form a region.

1. All texts: anchors, with a hash of each region.
2. Anchors that occur once are settled (nothing repeats), regions that occur
   more than once are settled too (everything repeats): one representative of
   each is kept, so groups of copies shrink to one region before any text moves.
3. What is left is sorted by two-stage suffix sorting: only suffixes smaller
   than their successors are sorted directly, the rest is induced by bucket
   scans. Neighbours with a common prefix of 400 bytes repeat.

An anchor with very many different regions is split by start offset and by the
bytes that its next strings share, which keeps equal strings together; where
those still differ in very many ways at their ends, each string is counted by
its digest. Very frequent regions are few, so every task knows them, and their
rows stay where they are.

Defined results: a null text is empty; texts under 400 bytes keep everything;
repeated rows are copies of each other; a null doc_id is a row as any other;
other columns are ignored; texts are read whole; an empty table gives an empty
one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise, utf8

LENGTH, PIECE = 400, 64
#: Regions of one anchor that are sorted together, and the starts of a slice beyond that.
MOST_REGIONS, SLICE = 1000, 16
#: Slices with the same shared bytes that are sorted together.
MOST_SLICES = 1000
#: Rows of one region that a join may bring together: so many, or their total by MOST_FREQUENT, so that few regions have more.
MOST_ROWS, MOST_FREQUENT = 1000, 100_000
BUCKET_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        p = np.ones(1, _U)
        while len(p) < n:
            p = np.concatenate([p, p * _U(pow(base, len(p), 1 << 64))])
        out.append(p[:n])
    return out[0], out[1]


def piece_hashes(data: np.ndarray, powers: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A 64-bit hash of the PIECE bytes at each position."""
    n = len(data)
    sums = np.zeros(n + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * powers[0][:n], out=sums[1:])
    h = (sums[PIECE:] - sums[: n - PIECE + 1]) * powers[1][: n - PIECE + 1]
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    return h


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w values in a row, in two passes over blocks of w."""
    m = len(x)
    padded = np.full(-(-m // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:m] = x
    blocks = padded.reshape(-1, w)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: m - w + 1], left[w - 1 : m])


def anchors(data: np.ndarray, powers: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """hash, position, first start, last start of every anchor of a text of LENGTH bytes or more."""
    h = piece_hashes(data, powers)
    keys = (h & _U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=_U)  # ties: the leftmost
    at = (sliding_min(keys, LENGTH - PIECE + 1) & _U(0xFFFFFFFF)).astype(np.int64)
    cut = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut - 1, [len(at) - 1]])
    return h[at[first]], at[first], first, last


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2, text: a key for the row, the same for equal rows."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, F.col("text")).alias("k1"), F.coalesce(doc_id, F.lit(-1).cast("long")).alias("k2"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def all_anchors(rows: DataFrame) -> DataFrame:
    """fp, region, k1, k2, off, s1, s2 for each anchor: off is its place from the first start s1."""

    def make():
        import xxhash

        powers = _powers(1 << 16)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            nonlocal powers
            out: list[list[np.ndarray]] = [[] for _ in range(7)]
            for k1, k2, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = utf8(text)
                if len(data) < LENGTH:
                    continue
                if len(data) > len(powers[0]):
                    powers = _powers(2 * len(data))
                fp, at, first, last = anchors(np.frombuffer(data, np.uint8), powers)
                region = np.fromiter((xxhash.xxh3_64_intdigest(data[a : b + LENGTH]) for a, b in zip(first.tolist(), last.tolist(), strict=True)), _U, len(first))
                for x, v in zip(out, (fp.view(np.int64), region.view(np.int64), np.full(len(fp), k1), np.full(len(fp), k2), (at - first).astype(np.int32), first.astype(np.int32), last.astype(np.int32)), strict=True):
                    x.append(v)
            if not out[0]:
                return None
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["fp", "region", "k1", "k2", "off", "s1", "s2"])

        return step

    return map_batches(rows.select("k1", "k2", "text"), make, "fp long, region long, k1 long, k2 long, off int, s1 int, s2 int")


def suffix_order(t: np.ndarray, wanted: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """The positions flagged in ``wanted``, in the order of their suffixes, right to ``depth`` bytes.

    Two stages: suffixes smaller than their successors are sorted directly; the others are
    put in place by one scan over the buckets of first bytes, in ascending order. A bucket
    holds the induced suffixes first, then the sorted ones.
    """
    n = len(t)
    step = np.sign(np.diff(t.astype(np.int16), append=-1))
    # Where two bytes are equal, the next pair that differs decides.
    place = np.where(step != 0, np.arange(n), n - 1)
    step = step[np.minimum.accumulate(place[::-1])[::-1]]
    small = step > 0
    # A larger suffix is induced from its successor, so the set runs on to the next smaller one.
    next_small = np.minimum.accumulate(np.where(small, np.arange(n), n - 1)[::-1])[::-1]
    starts = np.flatnonzero(wanted)
    marks = np.zeros(n + 1, np.int32)
    np.add.at(marks, starts, 1)
    np.add.at(marks, next_small[starts] + 1, -1)
    need = np.cumsum(marks[:n]) > 0

    raw = t.tobytes()
    direct = np.array(sorted(np.flatnonzero(need & small).tolist(), key=lambda i: raw[i : i + depth]), dtype=np.int64)
    heads = np.searchsorted(t[direct], np.arange(257)) if len(direct) else np.zeros(257, np.int64)
    large = need & ~small
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and large[n - 1]:
        induced[t[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        first = induced[c]
        wave = np.concatenate(first) if first else np.empty(0, np.int64)
        waves = [wave]
        while len(wave):  # inside a run of equal bytes the bucket feeds itself
            p = wave[wave > 0] - 1
            wave = p[large[p] & (t[p] == c)]
            waves.append(wave)
        seq = np.concatenate([*waves, direct[heads[c] : heads[c + 1]]])
        if not len(seq):
            continue
        out.append(seq)
        p = seq[seq > 0] - 1
        p = p[large[p] & (t[p] > c)]
        if len(p):
            by = np.argsort(t[p], kind="stable")
            p = p[by]
            bytes_, at = np.unique(t[p], return_index=True)
            for b, part in zip(bytes_.tolist(), np.split(p, at[1:]), strict=True):
                induced[b].append(part)
    order = np.concatenate(out) if out else np.empty(0, np.int64)
    return order[wanted[order]]


def common_prefixes(t: np.ndarray, order: np.ndarray, limit: int = LENGTH, chunk: int = 50) -> np.ndarray:
    """For each suffix but the last in ``order``, bytes in common with the next one, up to ``limit``."""
    a, b = order[:-1], order[1:]
    lcp = np.zeros(len(a), np.int64)
    padded = np.concatenate([t, np.zeros(limit, np.uint8)])
    views = np.lib.stride_tricks.sliding_window_view(padded, chunk)
    live = np.arange(len(a))
    for d in range(0, limit, chunk):
        if not len(live):
            break
        rest = []
        for part in np.array_split(live, -(-len(live) // 20_000)):
            same = views[a[part] + d] == views[b[part] + d]
            whole = same.all(axis=1)
            lcp[part] += np.where(whole, chunk, same.argmin(axis=1))
            rest.append(part[whole])
        live = np.concatenate(rest)
    # A prefix that runs over the end of the buffer ends there.
    return np.minimum(lcp, len(t) - np.maximum(a, b))


def repeated_starts(regions: list[bytes], owned: list[int]) -> list[np.ndarray]:
    """For each region, which of its first ``owned`` starts have a string that another start has."""
    t = np.frombuffer(b"".join(regions), np.uint8)
    offsets = np.cumsum([0] + [len(r) for r in regions])
    wanted = np.zeros(len(t), bool)
    for at, k in zip(offsets[:-1].tolist(), owned, strict=True):
        wanted[at : at + k] = True
    order = suffix_order(t, wanted)
    same = common_prefixes(t, order) >= LENGTH
    hit = np.zeros(len(order), bool)
    hit[:-1] |= same
    hit[1:] |= same
    flags = np.zeros(len(t), bool)
    flags[order[hit]] = True
    return [np.flatnonzero(flags[at : at + k]) for at, k in zip(offsets[:-1].tolist(), owned, strict=True)]


SPANS = "k1 long, k2 long, lo int, hi int"


def _sort_bucket(rows: pa.Table) -> pa.Table:
    """Spans of the rows (k1, k2, s1, text, owned) whose strings repeat among them."""
    k1, k2, s1, text, owned = (rows.column(c).to_pylist() for c in ("k1", "k2", "s1", "text", "owned"))
    out: list[tuple[int, int, int, int]] = []
    for i, starts in enumerate(repeated_starts(text, owned)):
        if len(starts):
            cut = np.flatnonzero(np.diff(starts) > 1)
            for a, b in zip(starts[np.concatenate([[0], cut + 1])].tolist(), starts[np.concatenate([cut, [len(starts) - 1]])].tolist(), strict=True):
                out.append((k1[i], k2[i], s1[i] + a, s1[i] + b + LENGTH))
    cols = list(zip(*out, strict=True)) or [()] * 4
    return pa.table({"k1": pa.array(cols[0], pa.int64()), "k2": pa.array(cols[1], pa.int64()), "lo": pa.array(cols[2], pa.int32()), "hi": pa.array(cols[3], pa.int32())})


_ALL = (1 << 64) - 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _slices(regions: DataFrame) -> DataFrame:
    """Regions of crowded anchors cut into SLICE starts each, keyed by place and by the bytes all of them share."""

    def make():
        import xxhash

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for fp, k1, k2, off, s1, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                owned = len(text) - LENGTH + 1
                # Starts are counted back from the anchor, so equal strings have equal places. The
                # strings of one place share the bytes from its last start to the end of its first string.
                a = 0
                while a < owned:
                    place = (off - a) // SLICE
                    lo = off - place * SLICE
                    b = min(owned, lo + 1)
                    core = xxhash.xxh3_64_intdigest(text[lo : lo - SLICE + 1 + LENGTH], place & 0xFFFFFFFF)
                    piece = text[a : b - 1 + LENGTH]
                    rows.append((_signed(core ^ (fp & _ALL)), _signed(xxhash.xxh3_64_intdigest(piece)), k1, k2, s1 + a, piece, b - a))
                    a = b
            cols = list(zip(*rows, strict=True)) or [()] * 7
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=["core", "piece", "k1", "k2", "s1", "text", "owned"])

        return step

    return map_batches(regions.select("fp", "k1", "k2", "off", "s1", "text"), make, "core long, piece long, k1 long, k2 long, s1 int, text binary, owned int")


def _strings(slices: DataFrame) -> DataFrame:
    """Spans of the LENGTH-byte strings of ``slices`` that start more than once, by their digests."""
    starts = slices.select("core", "k1", "k2", "s1", "text", F.explode(F.sequence(F.lit(0), F.col("owned") - 1)).alias("i"))
    strings = materialise(starts.select("core", F.unhex(F.md5(F.expr(f"substring(text, i + 1, {LENGTH})"))).alias("digest"), "k1", "k2", (F.col("s1") + F.col("i")).alias("lo")), "sub-strings")
    often = materialise(strings.groupBy("core", "digest").agg(F.count("*").alias("m")).where("m > 1").select("core", "digest"), "sub-often-strings")
    return strings.join(often, ["core", "digest"]).select("k1", "k2", "lo", (F.col("lo") + LENGTH).alias("hi"))


def repeated(shared: DataFrame, kinds: DataFrame) -> DataFrame:
    """Rows of ``shared`` whose region occurs more than once by ``kinds`` (fp, region, n)."""
    key = ["fp", "region"]
    most = max(MOST_ROWS, shared.count() // MOST_FREQUENT)
    frequent = F.broadcast(kinds.where(F.col("n") > most).select(key))
    others = shared.join(frequent, key, "left_anti").join(kinds.where(F.col("n").between(2, most)).select(key), key)
    return shared.join(frequent, key).unionByName(others)


def spans(docs: DataFrame) -> DataFrame:
    """k1, k2, lo, hi: stretches of bytes that go, which may overlap."""
    rows = keyed(docs)
    found = materialise(all_anchors(rows), "sub-anchors")
    # Counted into a table of its own: a join of two plain shuffles can be split where one anchor is very frequent.
    often = materialise(found.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp"), "sub-often")
    shared = materialise(found.join(often, "fp"), "sub-shared")
    # One row for each different region of an anchor; equal ones are counted before the shuffle.
    kinds = materialise(shared.groupBy("fp", "region").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "off", "s1", "s2")).alias("rep")), "sub-kinds")
    repeats = repeated(shared, kinds).select("k1", "k2", F.col("s1").alias("lo"), (F.col("s2") + LENGTH).alias("hi"))
    per_fp = materialise(kinds.groupBy("fp").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1").select("fp", "kinds"), "sub-open")
    open_ = kinds.join(per_fp, "fp").select("fp", "n", "kinds", "rep.*")
    lists = open_.groupBy("k1", "k2").agg(F.collect_list(F.struct("fp", "n", "kinds", "off", "s1", "s2")).alias("parts"))

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            cols: list[list] = [[] for _ in range(8)]
            for k1, k2, text, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = utf8(text)
                for p in parts:
                    for x, v in zip(cols, (p["fp"], p["n"], p["kinds"], k1, k2, p["off"], p["s1"], data[p["s1"] : p["s2"] + LENGTH]), strict=True):
                        x.append(v)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["fp", "n", "kinds", "k1", "k2", "off", "s1", "text"])

        return step

    # Equal rows share a key: one of them stands for all.
    once = rows.select("k1", "k2", "text").join(lists, ["k1", "k2"]).groupBy("k1", "k2").agg(F.first("text").alias("text"), F.first("parts").alias("parts"))
    regions = materialise(map_batches(once, make, "fp long, n long, kinds long, k1 long, k2 long, off int, s1 int, text binary"), "sub-regions")
    size = regions.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    buckets = max(1, size // BUCKET_BYTES)
    usual = regions.where(F.col("kinds") <= MOST_REGIONS).select("k1", "k2", "s1", "text", (F.length("text") - LENGTH + 1).alias("owned"), F.pmod("fp", F.lit(buckets)).alias("bucket"))
    by_usual = usual.groupBy("bucket").applyInArrow(_sort_bucket, SPANS)

    # Crowded anchors: slices that occur more than once repeat whole; one of each is sorted with those that share its bytes.
    pieces = materialise(_slices(regions.where(F.col("kinds") > MOST_REGIONS)), "sub-slices")
    same = materialise(pieces.groupBy("core", "piece").agg(F.count("*").alias("m"), F.min(F.struct("k1", "k2", "s1")).alias("rep")), "sub-pieces")
    whole = pieces.join(same.where("m > 1").select("core", "piece"), ["core", "piece"]).select("k1", "k2", F.col("s1").alias("lo"), (F.col("s1") + F.col("owned") - 1 + LENGTH).alias("hi"))
    cores = materialise(same.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1"), "sub-cores")
    left = pieces.join(same.join(cores, "core").select("core", "piece", "rep.*", "kinds"), ["core", "piece", "k1", "k2", "s1"])
    sorted_ = left.where(F.col("kinds") <= MOST_SLICES)
    by_slice = sorted_.select("k1", "k2", "s1", "text", "owned", F.pmod("core", F.lit(buckets)).alias("bucket")).groupBy("bucket").applyInArrow(_sort_bucket, SPANS)
    by_string = _strings(left.where(F.col("kinds") > MOST_SLICES))
    return repeats.union(by_usual).union(whole).union(by_slice).union(by_string)


def _merged(parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(parts):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes) for every row."""
    # Equal rows have equal spans: once each, so that no list grows with the copies of a text.
    gone = spans(docs).distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "hi")).alias("parts"))

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            cols: list[list] = [[] for _ in range(5)]
            for text, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = utf8(text)
                cut = _merged([(p["lo"], p["hi"]) for p in parts or ()])
                kept, at = [], 0
                for lo, hi in cut:
                    kept.append(data[at:lo])
                    at = hi
                rest = b"".join([*kept, data[at:]])
                for x, v in zip(cols, (len(data), len(data) - len(rest), len(cut), hashlib.sha256(rest).hexdigest(), rest), strict=True):
                    x.append(v)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

        return step

    joined = keyed(docs).join(gone, ["k1", "k2"], "left").select("doc_id", "text", "parts")
    return map_batches(joined, make, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
