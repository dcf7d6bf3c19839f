"""Tables in the folder that driver and executors share, written once and read often."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_made: "weakref.WeakKeyDictionary[SparkSession, list[str]]" = weakref.WeakKeyDictionary()


def base(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local session without one gets a temporary folder, a cluster must name it."""
    context = spark.sparkContext
    if found := context.getConf().get("spark.checkpoint.dir"):
        return found.rstrip("/")
    held = context._jsc.sc().getCheckpointDir()
    if held.isEmpty():
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="seatledger-"))
        held = context._jsc.sc().getCheckpointDir()
    return held.get().rstrip("/")


def _at(spark: SparkSession, path: str):
    """The path and its store, whatever store that is."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def put(spark: SparkSession, path: str, data: bytes) -> None:
    """A file in Spark's store that appears whole or not at all: written under a name of its own, then renamed over the old one in one step."""
    jvm = spark.sparkContext._jvm
    at, store = _at(spark, path)
    at = at.makeQualified(store.getUri(), store.getWorkingDirectory())
    own = at.suffix(f".{uuid.uuid4().hex}")
    try:
        stream = store.create(own, True)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
        how = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        over = spark.sparkContext._gateway.new_array(how, 1)
        over[0] = how.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(own, at, over)
    except BaseException:
        store.delete(own, False)
        raise


def exists(spark: SparkSession, path: str) -> bool:
    at, store = _at(spark, path)
    return store.exists(at)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder of any store, sorted; none where it is no folder."""
    at, store = _at(spark, path)
    if not store.exists(at) or not store.getFileStatus(at).isDirectory():
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(at))


def get(spark: SparkSession, path: str) -> bytes | None:
    """A small file of Spark's store, None where there is none."""
    at, store = _at(spark, path)
    if not store.exists(at):
        return None
    stream = store.open(at)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def folder(spark: SparkSession, label: str) -> str:
    """A new folder, deleted with :func:`release` or when Python ends; its path names its store."""
    at, store = _at(spark, f"{base(spark)}/seatledger/{label}-{uuid.uuid4().hex}")
    path = at.makeQualified(store.getUri(), store.getWorkingDirectory()).toString()
    _made.setdefault(spark, []).append(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a stored table: what several branches of a plan read is computed once, and a lost executor costs a re-read."""
    path = folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    for path in _made.pop(spark, []):
        at, store = _at(spark, path)
        store.delete(at, True)


@atexit.register
def _release_all() -> None:
    for spark in list(_made):
        try:
            release(spark)
        except Exception:  # the session has ended
            pass
