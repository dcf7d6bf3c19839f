"""Substring search through a positional index of trigrams.

The index is a table: a row for each text and trigram of it with the places where it stands.
Two marks that no text has end each text, so also the last two characters begin a trigram.
A query looks up its rarest trigrams only; texts stay where those stand at the right distance
from each other, and are then confirmed by the text itself. Queries of one or two characters
look up the trigrams that begin with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written

#: Bits of a character; trigrams of a query that are looked up; characters (some 80 bytes of memory each) that a task indexes at a time.
BITS, RAREST, CHARACTERS = 21, 3, 1 << 20


def _pieces(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of rows that have ``most`` characters together, or one row with more."""
    out, start, held = [], 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > most:
            out.append((start, i))
            start, held = i, 0
        held += n
    return out + [(start, len(sizes))] if len(sizes) else out


def _index_of(keys: pa.Array, texts: list[str | None]) -> pa.RecordBatch | None:
    each = [(t or "").encode("utf-32-le", "surrogatepass") for t in texts]
    size = np.fromiter((len(e) // 4 for e in each), np.int64, len(each))
    c = np.frombuffer((b"\0" * 8).join([*each, b""]), np.uint32)
    row = np.repeat(np.arange(len(each), dtype=np.int32), size)
    if not len(row):
        return None
    at = (np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32)
    p = at + np.repeat(np.cumsum(size + 2) - size - 2, size)
    g = c[p].astype(np.int64) << 2 * BITS | c[p + 1].astype(np.int64) << BITS | c[p + 2]
    order = np.lexsort((g, row))
    g, row, at = g[order], row[order], at[order]
    cuts = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (row[1:] != row[:-1])])
    places = pa.ListArray.from_arrays(pa.array(np.r_[cuts, len(order)].astype(np.int32)), pa.array(at))
    return pa.RecordBatch.from_arrays([keys.take(pa.array(row[cuts])), pa.array(g[cuts]), places], names=["k", "gram", "at"])


def grams(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, gram, at: places (from 0) of each trigram of each text; null has none.

    A task holds the trigrams of some ``CHARACTERS`` at a time, or of one text that has more.
    """
    most = CHARACTERS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in _pieces(pc.fill_null(pc.binary_length(batch["t"]), 0).to_numpy(zero_copy_only=False), most):
                part = batch.slice(lo, hi - lo)
                if (found := _index_of(part["k"], part["t"].to_pylist())) is not None:
                    yield found

    kind = dict(texts.dtypes)[key]
    rows = texts.select(F.col(key).alias("k"), F.col(text).alias("t"))
    return rows.mapInArrow(run, f"k {kind}, gram long, at array<int>").withColumnRenamed("k", key)


def find(queries: DataFrame, texts: DataFrame, index: DataFrame, key: str, text: str) -> DataFrame:
    """query, key of every distinct query (column query, not empty) and every text that holds it; ``index`` is :func:`grams` of the same texts.

    What is asked is stored, so that its size is known: where it is small, the index is read past it and not shuffled.
    """
    asked = queries.select("query").where("query <> ''").distinct()
    long = grams(asked.where(F.char_length("query") > 2).withColumn("q", F.col("query")), "query", "q")
    # The two marks at the end belong to no query.
    long = written(long.where((F.col("gram") % (1 << BITS) > 0)).select("query", "gram", F.get("at", F.lit(0)).alias("offset")), "asked")
    wanted = written(long.select("gram").distinct(), "wanted")
    often = written(index.select("gram").join(wanted, "gram").groupBy("gram").agg(F.count("*").alias("often")), "often")
    order = Window.partitionBy("query").orderBy("often", "gram")
    ranked = long.join(often, "gram", "left").withColumn("often", F.coalesce("often", F.lit(0))).withColumn("place", F.row_number().over(order))
    picked = ranked.where(F.col("place") <= RAREST).withColumn("picked", F.count("*").over(Window.partitionBy("query"))).select("query", "gram", "offset", "picked")
    starts = index.join(written(picked, "picked"), "gram").select("query", key, "picked", F.transform("at", lambda p: p - F.col("offset")).alias("starts"))
    met = starts.groupBy("query", key).agg(F.collect_list("starts").alias("all"), F.first("picked").alias("picked")).where(F.size("all") == F.col("picked"))
    met = met.where(F.size(F.aggregate("all", F.get("all", F.lit(0)), lambda a, b: F.array_intersect(a, b))) > 0).select("query", key)
    for n in (1, 2):
        lead = F.shiftright("gram", BITS * (3 - n))
        code = F.lit(0).cast("long")
        for i in range(n):
            code = code * (1 << BITS) + _code(F.substr("query", F.lit(i + 1), F.lit(1)))
        short = written(asked.where(F.char_length("query") == n).select("query", code.alias("lead")), "short")
        met = met.unionByName(index.select(key, lead.alias("lead")).join(short, "lead").select("query", key).distinct())
    held = texts.select(key, F.col(text).alias("_sl_text"))
    return met.distinct().join(held, key).where(F.contains("_sl_text", F.col("query"))).select("query", key)


def _code(c: Column) -> Column:
    """Code point of a character, from its UTF-32 bytes."""
    return F.conv(F.hex(F.encode(c, "UTF-32")), 16, 10).cast("long")
