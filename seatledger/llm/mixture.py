"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

Points of the golden-ratio sequence are mapped through the cumulative target
weights, so each slot of the schedule names a source; slots are ranked for each
source, and the k-th slot of a source takes the k-th block of equal token count
from that source's shuffled, repeated stream of documents.

Large groups: no window is partitioned by the source alone over documents or
slots. Both are cut into buckets first (a hash of the row; 4,096 slots in a
row), numbered inside a bucket, and only the bucket totals are summed by source.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; a document of size 0 is never taken; rows with one doc_id are
placed one by one; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, word_count

WEIGHTS = (5, 2, 1)
CAP = 3
SLOT_RUN = 4096
CELLS = 4096
# The golden ratio less one.
GOLDEN = 0.6180339887498949


def _big_step() -> float:
    """frac(2^20 * phi) from integer arithmetic: phi is the limit of Fibonacci quotients."""
    a, b = 0, 1
    for _ in range(180):
        a, b = b, a + b
    return float(((a << 20) % b) / b)


def sources_of(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """source, sid, source_size, weight, target: weights by code point, water-filled under the cap."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.col("sid") - 1, F.lit(len(weights))).cast("int") + 1)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    src = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
        .withColumn("sid", F.row_number().over(order)).withColumn("weight", w)
    )
    everything = Window.partitionBy(F.lit(1))
    # Sources fill up in the order of what they can hold for a unit of weight.
    before = Window.partitionBy(F.lit(1)).orderBy(F.col("source_size") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    held = F.col("source_size") * F.lit(float(cap))
    return (
        src.withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum(held).over(before), F.lit(0.0))) / (F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
        .withColumn("full", held <= F.col("level") * F.col("weight"))
        .withColumn("left_total", F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), held)).over(everything), F.lit(0.0)))
        .withColumn("left_weight", F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything))
        .withColumn("target", F.when(F.col("full"), held).otherwise(F.col("left_total") / F.col("left_weight") * F.col("weight")))
        .select("source", "sid", "source_size", "n_docs", "weight", "target")
    )


def point(n: Column) -> Column:
    """The n-th golden-ratio point in [0, 1), exact enough up to 2^40."""
    high, low = F.shiftright(n, 20).cast("double"), n.bitwiseAND(F.lit((1 << 20) - 1)).cast("double")
    return F.pmod(F.pmod(high * F.lit(_big_step()), F.lit(1.0)) + low * F.lit(GOLDEN) + F.lit(0.5), F.lit(1.0))


def schedule(spark, sources: DataFrame, n_slots: int) -> DataFrame:
    """sid, rank for every slot: which source it goes to and its number among that source's slots."""
    run = Window.partitionBy(F.lit(1)).orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum("target").over(Window.partitionBy(F.lit(1)))
    bounds = (
        sources.where("target > 0").withColumn("hi", F.sum("target").over(run) / total)
        .withColumn("lo", F.coalesce(F.lag("hi").over(Window.partitionBy(F.lit(1)).orderBy("sid")), F.lit(0.0)))
        .withColumn("hi", F.when(F.lead("hi").over(Window.partitionBy(F.lit(1)).orderBy("sid")).isNull(), F.lit(2.0)).otherwise(F.col("hi")))
        .withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * CELLS).cast("int"), F.floor(F.least(F.col("hi"), F.lit(1.0)) * CELLS).cast("int"))))
        .select("sid", "lo", "hi", "cell")
    )
    slots = spark.range(n_slots).select(F.col("id").alias("slot"), point(F.col("id")).alias("x")).withColumn("cell", F.floor(F.col("x") * CELLS).cast("int"))
    named = slots.join(bounds, "cell").where("x >= lo and x < hi").select("slot", "sid", F.shiftright("slot", 12).alias("run"))
    inside = named.withColumn("k", F.row_number().over(Window.partitionBy("sid", "run").orderBy("slot")) - 1)
    counts = named.groupBy("sid", "run").agg(F.count("*").alias("n"))
    offsets = counts.withColumn("first", F.coalesce(F.sum("n").over(Window.partitionBy("sid").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    return inside.join(offsets, ["sid", "run"]).select("sid", (F.col("first") + F.col("k")).alias("rank"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, block_words: int = 1024, least_slots: int = 1 << 16, bucket_rows: int = 4096, seed: int = 11) -> DataFrame:
    """doc_id, source, row_hash, size, source_size, target, taken, for every row of ``docs``.

    A block has ``block_words`` words, or fewer where the mix would have under ``least_slots`` blocks.
    """
    spark = docs.sparkSession
    sized = materialise(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("row_hash")
        ).withColumn("shuffle", F.xxhash64(F.lit(seed), "doc_id", "row_hash", "size")),
        "mix-sizes",
    )
    sources = materialise(sources_of(sized, weights, cap), "mix-sources")
    whole = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("words"), F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs")).first()
    block = max(1, min(block_words, whole["words"] // least_slots))
    n_slots = -(-whole["words"] // block)
    buckets = max(1, whole["docs"] // bucket_rows)

    slots = schedule(spark, sources, n_slots)
    placed = sized.join(sources.select(F.col("source").alias("own"), "sid", "source_size", "target"), F.col("source").eqNullSafe(F.col("own"))).drop("own")
    placed = placed.withColumn("bucket", F.pmod("shuffle", F.lit(buckets)).cast("int"))
    by_row = Window.partitionBy("sid", "bucket").orderBy("shuffle", "doc_id", "row_hash")
    first = placed.groupBy("sid", "bucket").agg(F.sum("size").alias("n")).withColumn(
        "first", F.coalesce(F.sum("n").over(Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("n")
    placed = (
        placed.withColumn("row", F.row_number().over(by_row))
        .withColumn("at", F.coalesce(F.sum("size").over(by_row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .join(first, ["sid", "bucket"]).withColumn("at", F.col("at") + F.col("first"))
    )
    # Where each pass over the source puts the document, and the blocks it lies in there.
    begins = F.col("at") + F.col("pass") * F.col("source_size")
    pieces = (
        placed.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(cap - 1)))).withColumn("begins", begins)
        .withColumn("rank", F.explode(F.sequence(F.floor(F.col("begins") / F.lit(block)), F.floor((F.col("begins") + F.col("size") - 1) / F.lit(block)))))
        .withColumn("words", F.least(F.col("begins") + F.col("size"), (F.col("rank") + 1) * block) - F.greatest(F.col("begins"), F.col("rank") * block))
    )
    taken = pieces.join(slots, ["sid", "rank"]).groupBy("sid", "bucket", "row").agg(F.sum("words").alias("taken"))
    return placed.join(taken, ["sid", "bucket", "row"], "left").select(
        "doc_id", "source", "row_hash", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its words were taken, to the nearest whole copy.

    Null ids, sources and texts are values like others; a row without words goes; columns may
    have any names.

    Whole documents stand for the words taken; rows taken less than half go, rows
    taken twice or three times come as often. Rows that are equal share one count.
    """
    share = mix(docs, **options).where("size > 0").groupBy("doc_id", "source", "row_hash").agg(F.round(F.sum("taken") / F.sum("size")).cast("int").alias("copies")).where("copies > 0")
    # The row travels as one value, so no name of its columns can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.col("source").alias("own"), F.xxhash64("text").alias("hash"))
    on = F.col("id").eqNullSafe(F.col("doc_id")) & F.col("own").eqNullSafe(F.col("source")) & (F.col("hash") == F.col("row_hash"))
    return rows.join(share, on).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
