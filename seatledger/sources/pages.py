"""A table laid out for paging: range partitions with their counts, so that a page opens the ranges it lies in.

The order is made once, when the table is laid out. What a reader keeps is a count for each
range; a page's first row is found by their running sum, and only its ranges are read,
whatever the page's number.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE = "_sl_range"


@dataclass(frozen=True)
class Pages:
    """A laid-out table: its folder, schema, order, and the rows before each range."""

    spark: SparkSession
    path: str
    schema: object
    order: list[str]
    before: list[int]

    @property
    def rows(self) -> int:
        return self.before[-1]

    def count(self, size: int = 50) -> int:
        """Number of pages; an empty table has one."""
        return max(1, -(-self.rows // size))

    def ranges(self, number: int, size: int = 50) -> list[int]:
        """Ranges that hold rows of page ``number`` (from 1)."""
        lo = (number - 1) * size
        hi = min(lo + size, self.rows)
        return [] if lo >= hi else [r for r in range(bisect_right(self.before, lo) - 1, bisect_right(self.before, hi - 1)) if self.before[r] < self.before[r + 1]]

    def page(self, number: int, size: int = 50) -> DataFrame:
        """The rows of a page in order; none beyond the last."""
        mine = self.ranges(number, size)
        table = self.spark.read.schema(self.schema).parquet(self.path)
        skip = (number - 1) * size - self.before[mine[0]] if mine else 0
        # Ranges follow each other, so sorting those of the page gives its place in them.
        return table.where(F.col(RANGE).isin(mine) if mine else F.lit(False)).orderBy(*_order(self.order)).offset(skip).limit(size).drop(RANGE)


def _order(columns: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def lay_out(df: DataFrame, order: list[str], path: str, rows_in_range: int = 1_000_000) -> Pages:
    """Write ``df`` by ranges of ``order``, of some ``rows_in_range`` rows each, and count them. ``order`` should tell all rows apart."""
    spark = df.sparkSession
    n = max(1, -(-df.count() // rows_in_range))
    ranged = df.repartitionByRange(n, *_order(order)).withColumn(RANGE, F.spark_partition_id())
    ranged.sortWithinPartitions(*_order(order)).write.partitionBy(RANGE).parquet(path)
    table = spark.read.schema(ranged.schema).parquet(path)
    counts = {r[RANGE]: r["n"] for r in table.groupBy(RANGE).agg(F.count("*").alias("n")).collect()}
    each = [counts.get(k, 0) for k in range(max(counts, default=-1) + 1)]
    return Pages(spark, path, table.schema, order, [0, *accumulate(each)])
