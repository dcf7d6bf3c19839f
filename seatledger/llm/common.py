"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space that parts words: space and the five controls \x09-\x0D.
SPACES = ("\t", "\n", "\x0b", "\x0c", "\r")

_written: "weakref.WeakKeyDictionary[SparkSession, list[str]]" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder, read by Spark only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where a local session has none, a temporary folder is set once; a cluster's session must
    name one, since executors there cannot see the driver's disk.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
    own = tempfile.mkdtemp(prefix="seatledger-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs in this block drop their shuffle files when they end: what they made is in a table by then."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, held)


def materialise(df: DataFrame, label: str, codec: str = "zstd", **options: str | int) -> DataFrame:
    """Write ``df`` to a table in the shared folder, with ``options`` of the Parquet writer, and read it back.

    It cuts the lineage: a lost executor costs a re-read, not a re-run.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/seatledger/{label}-{uuid.uuid4().hex}"
    with short_shuffles(spark):
        df.write.options(compression=codec, **options).parquet(path)
    _written.setdefault(spark, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the tables that :func:`materialise` wrote in this session."""
    paths = _written.pop(spark, [])
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


@atexit.register
def _release_all() -> None:
    for spark in list(_written):
        try:
            release(spark)
        except Exception:  # the session has ended; its cleaner owns the folder
            pass


def held(key: str, make: Callable[[], object]) -> object:
    """What a worker keeps from task to task, one at a time: functions travel by value, so a module of theirs is new in each."""
    import sys

    store = sys.__dict__.setdefault("_seatledger_held", {})
    if key not in store:
        store.clear()
        store[key] = make()
    return store[key]


def fresh(name: str, columns: list[str]) -> str:
    """``name``, or a longer one that no column begins with."""
    while any(c.lower().startswith(name.lower()) for c in columns):
        name += "_"
    return name


def spaced(text: Column) -> Column:
    """``text`` with every word-parting character turned into a space; null gives ''."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(" "))
    return out


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of ``text`` as an array; null gives an empty one."""
    return F.array_remove(F.split(spaced(text), " "), "")


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.size(words_of(text)).cast("long")


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


#: Bytes of an Arrow batch on its way to a Python worker.
BATCH_BYTES = 4 << 20


def lean_batches(spark: SparkSession) -> None:
    """Arrow batches of BATCH_BYTES at most, one value for all operators, unless the session asks for less."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name, "64m").lower().rstrip("b")
    size = int(now.rstrip("kmg")) << {"k": 10, "m": 20, "g": 30}.get(now[-1:], 0)
    if not 0 < size <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | list[pa.RecordBatch] | None]], schema: str, rows: int = 1000) -> DataFrame:
    """mapInArrow with state for each task: ``make()`` runs once in the worker.

    Spark bounds a batch by its bytes; ``step`` sees slices of ``rows`` rows of it, so what a
    worker holds at once is bounded both ways.
    """
    lean_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = step(batch.slice(at, rows))
                if out is not None:
                    yield from out if isinstance(out, list) else [out]

    return df.mapInArrow(run, schema)
