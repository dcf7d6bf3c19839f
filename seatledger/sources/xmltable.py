"""Tables as XML documents and back, by Spark's own XML functions: no Python on the way.

For documents that are records, one a row. Prose with markup inside (resolutions) is walked by
``xmldocs``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from .shared import written

CORRUPT = "_corrupt"


def printed(record: Column, tag: str) -> Column:
    """A struct as an XML document with ``tag`` as its root; arrays repeat their element."""
    return F.to_xml(record, {"rowTag": tag})


def parsed(docs: DataFrame, column: str, schema: StructType, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Documents read back: (``keep`` columns with the fields of ``schema``), and those that are no such document (``keep`` with their text).

    PERMISSIVE: a broken document ends up aside, with its text, and stops nothing.
    """
    full = StructType(list(schema)).add(CORRUPT, StringType())
    read = docs.select(*keep, F.col(column).alias("_sl_doc"), F.from_xml(column, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("_sl_x"))
    broken = F.col("_sl_x").isNull() | F.col(f"_sl_x.{CORRUPT}").isNotNull()
    return read.where(~broken).select(*keep, *[F.col(f"_sl_x.{f.name}") for f in schema]), read.where(broken).select(*keep, F.col("_sl_doc").alias("text"))


def files(spark: SparkSession, path: str, tag: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Records (elements ``tag``) of the XML files of a folder, large files in splits; and broken ones. Files are parsed once, into a table."""
    full = StructType(list(schema)).add(CORRUPT, StringType())
    read = spark.read.format("xml").schema(full).option("rowTag", tag).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).load(path)
    read = written(read, "xml")
    broken = F.col(CORRUPT).isNotNull()
    return read.where(~broken).drop(CORRUPT), read.where(broken).select(F.col(CORRUPT).alias("text"))
