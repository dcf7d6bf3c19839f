"""Roster history to changes: what each full roster adds and removes against the state before it.

History rows (key columns, seq, is_full, members array<struct<identity, payload>>), or
heads and members as tables of their own; ``seq`` gives the order inside a key. A full roster opens an epoch; rows that
only add belong to the epoch they are in. Per key the work is one window and
joins on (key, epoch, identity), so nothing is folded row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _epochs(heads: DataFrame, keys: list[str]) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return heads.withColumn("epoch", F.sum(F.col("is_full").cast("int")).over(order))


def _exploded(epochs: DataFrame, *columns: str) -> DataFrame:
    return epochs.select(*columns, F.posexplode("members").alias("pos", "m")).select(*columns, "pos", "m.*")


def diff(history: DataFrame, keys: list[str]) -> DataFrame:
    """:func:`changes` of a history whose rows (keys, seq, is_full, members) hold whole rosters."""
    epochs = _epochs(history, keys)
    return _changes(epochs, _exploded(epochs, *keys, "seq", "is_full", "epoch"), keys)


def changes(heads: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """What each roster changes, as :func:`diff`, but no roster is ever one value.

    ``heads`` (keys, seq, is_full) has a row for each roster, empty ones too, ``rows`` (keys, seq, pos,
    identity, payload) one for each member. Rows of no roster, and of null keys, are left out.
    """
    epochs = _epochs(heads.select(*keys, "seq", "is_full"), keys)
    return _changes(epochs, rows.join(epochs, [*keys, "seq"]), keys)


def _changes(epochs: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, seq, change ('addition', 'removal'), identity, payload, pos.

    A full roster adds who was not in the state before and removes who no longer is, also
    when it is empty; repeated members of one roster repeat their addition, with the last
    payload. An adding row always adds. Removals carry the payload of the old state.
    """
    state = rows.groupBy(*keys, "epoch", "identity").agg(F.max_by("payload", F.struct("seq", "pos")).alias("payload"), F.min(F.struct("seq", "pos")).alias("at"))
    old = state.withColumn("epoch", F.col("epoch") + 1)
    on = [*keys, "epoch", "identity"]
    full = rows.where("is_full")
    last = full.groupBy(*keys, "seq", "identity").agg(F.max_by("payload", "pos").alias("payload"))
    out = [*keys, "seq", F.lit("addition").alias("change"), "identity", "payload", "pos"]
    added = full.drop("payload").join(old.select(*on), on, "left_anti").join(last, [*keys, "seq", "identity"]).select(*out)
    singles = rows.where("not is_full").select(*out)
    heads = epochs.where("is_full").select(*keys, "seq", "epoch")
    gone = heads.join(old, [*keys, "epoch"]).join(full.select(*on), on, "left_anti")
    # Places in the order in which the old state came about: rows of several documents may share theirs.
    place = F.row_number().over(Window.partitionBy(*keys, "seq").orderBy("at", "identity")) - 1
    removed = gone.select(*keys, "seq", F.lit("removal").alias("change"), "identity", "payload", place.alias("pos"))
    return added.unionByName(singles).unionByName(removed)


def final_state(history: DataFrame, keys: list[str]) -> DataFrame:
    """keys, identity, payload after the last row of each key."""
    epochs = _newest(_epochs(history, keys), keys)
    return _held(_exploded(epochs, *keys, "seq"), keys)


def state_after(heads: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The same from the tables of :func:`changes`."""
    epochs = _newest(_epochs(heads.select(*keys, "seq", "is_full"), keys), keys)
    return _held(rows.join(epochs.select(*keys, "seq"), [*keys, "seq"]), keys)


def _newest(epochs: DataFrame, keys: list[str]) -> DataFrame:
    return epochs.withColumn("last", F.max("epoch").over(Window.partitionBy(*keys))).where("epoch = last")


def _held(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys, "identity").agg(F.max_by("payload", F.struct("seq", "pos")).alias("payload"))
