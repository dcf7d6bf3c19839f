"""Roster changes and final states as streams, and an ingest cursor over landed files.

State is kept by key in the state store, so each micro-batch touches only the
keys it has rows for. Rows of a key must arrive in their order; rows that are
late are handled by :func:`recompute`, which runs the batch plan on the keys a
micro-batch touches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import roster


def ingest(spark, path: str, schema: str, checkpoint: str, sink: str) -> None:
    """New files of ``path`` appended to ``sink``, once; the checkpoint is the cursor."""
    stream = spark.readStream.schema(schema).json(path)
    stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stateful_changes(history: DataFrame, key: str) -> DataFrame:
    """key, seq, change, identity for a stream (key, seq, is_full, identities) whose rows come in order."""

    def update(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known: set[str] = set(state.get[0]) if state.exists else set()
        out = []
        rows = pd.concat(list(frames)).sort_values("seq")
        for seq, full, ids in zip(rows["seq"], rows["is_full"], rows["identities"], strict=True):
            now = list(ids)
            if full:
                out += [(k[0], seq, "addition", i) for i in now if i not in known]
                out += [(k[0], seq, "removal", i) for i in sorted(known - set(now))]
                known = set(now)
            else:
                out += [(k[0], seq, "addition", i) for i in now]
                known |= set(now)
        state.update((sorted(known),))
        yield pd.DataFrame(out, columns=[key, "seq", "change", "identity"])

    return history.groupBy(key).applyInPandasWithState(update, f"{key} string, seq long, change string, identity string", "known array<string>", "append", GroupStateTimeout.NoTimeout)


def recompute(history_path: str, keys: list[str], sink):
    """A foreachBatch function: adds the batch to the history and hands ``sink`` the changes of the keys it touches.

    A batch has a folder of its own by its number, so one that runs again replaces itself.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{history_path}/batch={number}")
        history = spark.read.parquet(history_path)
        touched = history.where(f"batch = {number}").select(*keys).distinct()
        sink(roster.diff(history.drop("batch").join(touched, keys, "left_semi"), keys))

    return run
