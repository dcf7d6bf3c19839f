"""Relational building blocks: ordered picks, cascades, set differences, carry-forward, pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def spread(df: DataFrame) -> DataFrame:
    """``df`` in several tasks for each core, for rows that cost much each: a small file is one task, however many rows it has."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= 4 * cores else df.repartition(4 * cores)


def pick_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``."""
    return df.withColumn("_sl_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_sl_rn = 1").drop("_sl_rn")


def priority(value: Column, order: tuple[str, ...]) -> Column:
    """Place of ``value`` in ``order`` from 1; null where it is not in it."""
    return F.nullif(F.array_position(F.array(*[F.lit(v) for v in order]), value), F.lit(0))


def first_match(items: Column, test) -> Column:
    """The first element that passes, or null."""
    return F.get(F.filter(items, test), F.lit(0))


def skip_if_empty(df: DataFrame, keys: list[str], flag: Column, strict: Column | None = None) -> DataFrame:
    """Rows of a key that pass, or all rows of the key if none does; with ``strict`` none then."""
    hit = F.coalesce(flag, F.lit(False))
    any_ = F.max(hit).over(Window.partitionBy(*keys))
    keep = hit | ~any_ if strict is None else hit | (~any_ & ~strict)
    return df.withColumn("_sl_keep", keep).where("_sl_keep").drop("_sl_keep")


def unique_or_null(value: Column, test: Column | None = None) -> Column:
    """Aggregate: the value where exactly one row passes, else null."""
    t = F.lit(True) if test is None else test
    return F.when(F.count_if(t) == 1, F.min(F.when(t, value)))


def unique_argmin(df: DataFrame, keys: list[str], distance: str, value: str, most: int) -> DataFrame:
    """keys and the value at the least distance, null where the minimum is shared or above ``most``."""
    least = F.min(distance).over(Window.partitionBy(*keys))
    near = df.withColumn("_sl_least", least).where(F.col(distance) == F.col("_sl_least"))
    return near.groupBy(*keys).agg(F.when((F.count("*") == 1) & (F.min(distance) <= most), F.min(value)).alias(value))


def first_wins(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """key, the value that came first, and whether others differ."""
    return df.groupBy(key).agg(F.min_by(value, F.struct(*order)).alias(value), (F.count_distinct(value) > 1).alias("collides"))


def latest_name(df: DataFrame, key: str, name: str, order: list[str]) -> DataFrame:
    """key, the last name by ``order``, and the other names in order."""
    rolled = df.groupBy(key).agg(F.max_by(name, F.struct(*order)).alias("name"), F.array_sort(F.collect_set(name)).alias("_sl_all"))
    return rolled.select(key, "name", F.array_remove("_sl_all", F.col("name")).alias("formerly"))


def carry_forward(new: DataFrame, old: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """``new`` with null values filled from the last old row of the same keys; null keys are equal."""
    mine = old.where(F.coalesce(F.col(value).cast("string"), F.lit("")) != "").groupBy(*keys).agg(F.max_by(value, order).alias("_sl_old"))
    mine = mine.select(*[F.col(k).alias(f"_sl_{k}") for k in keys], "_sl_old")
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_sl_{k}")) for k in keys])
    return new.join(mine, on, "left").withColumn(value, F.coalesce(value, "_sl_old")).drop("_sl_old", *[f"_sl_{k}" for k in keys])


def island_ids(starts: Column, keys: list[str], order: list[Column]) -> Column:
    """Running number of the island a row belongs to: one more at each start."""
    return F.sum(starts.cast("int")).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, order: list[Column], number: int, size: int = 50) -> DataFrame:
    """Page ``number`` from 1."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
