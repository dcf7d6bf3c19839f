"""Roster changes in the order of event time, from rows that come in any order.

State is keyed by roster and bucket of identities, so that a large roster is many keys. Of a
key it holds the rows that wait for their time, one entry for each time, and the members, one
entry for each identity: a row reads the entries of its own members, and all members of the
bucket only where fewer of them are confirmed than are known. A timer at each waiting time
fires when the watermark has passed it, and what waits is then worked off in order. A row from
behind the watermark changes nothing; it goes out marked late, for a table of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A member that no roster has named for so long is forgotten without a removal; off unless asked for.
NO_TTL = None
CHANGES = "roster string, bucket int, at_ms long, change string, identity string, late boolean"


def bucket_of(identity: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(identity), F.lit(buckets)).cast("int")


def by_bucket(rows: DataFrame, heads: DataFrame, buckets: int) -> DataFrame:
    """roster, bucket, at, is_full, identities of member rows (roster, at, identity) and document rows (roster, at, is_full).

    Every document has a row in every bucket, also where no member of it falls there: an empty
    roster removes. Members are gathered by bucket, so no row holds a whole roster.
    """
    gathered = rows.groupBy("roster", "at", bucket_of(F.col("identity"), buckets).alias("bucket")).agg(F.array_sort(F.collect_set("identity")).alias("identities"))
    each = heads.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return each.join(gathered, ["roster", "at", "bucket"], "left").select("roster", "bucket", "at", "is_full", F.coalesce("identities", F.array().cast("array<string>")).alias("identities"))


class RosterState(StatefulProcessor):
    """Members of a bucket of a roster, and rows that wait."""

    def __init__(self, ttl_ms: int | None = NO_TTL):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "at long", "rows array<struct<is_full: boolean, identities: array<string>>>")
        self.members = handle.getMapState("members", "identity string", "since long", self.ttl_ms)
        self.known = handle.getValueState("known", "n long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        for r in rows:
            at, row = r["at_ms"], (r["is_full"], sorted(r["identities"]))
            if at <= mark:
                yield from self._rows(key, [(at, "late", i, True) for i in row[1] or [None]])
            elif self.waiting.containsKey((at,)):
                self.waiting.updateValue((at,), (sorted([tuple(x) for x in self.waiting.getValue((at,))[0]] + [row]),))
            else:
                self.waiting.updateValue((at,), ([row],))
                self.handle.registerTimer(at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """All that waits up to the watermark, in order; timers of what is done by then find nothing."""
        mark = timerValues.getCurrentWatermarkInMs()
        for at in sorted(k[0] for k in self.waiting.keys() if k[0] <= mark):
            for full, ids in self.waiting.getValue((at,))[0]:
                yield from self._rows(key, self._apply(at, full, list(dict.fromkeys(ids))))
            self.waiting.removeKey((at,))

    def _apply(self, at: int, full: bool, ids: list[str]) -> list[tuple]:
        before = self.known.get()[0] if self.known.exists() else 0
        held = {i for i in ids if self.members.containsKey((i,))}
        out = [(at, "addition", i, False) for i in ids if not full or i not in held]
        gone: list[str] = []
        if full and len(held) < before:
            now = set(ids)
            gone = sorted(k[0] for k in self.members.keys() if k[0] not in now)
            for i in gone:
                self.members.removeKey((i,))
            out += [(at, "removal", i, False) for i in gone]
        for i in ids:
            if i not in held or self.ttl_ms is not None:
                self.members.updateValue((i,), (at,))
        self.known.update((len(ids) if full else before + len(ids) - len(held),))
        return out

    def _rows(self, key, rows: list[tuple]) -> Iterator[Row]:
        for at, change, identity, late in rows:
            yield Row(roster=key[0], bucket=key[1], at_ms=at, change=change, identity=identity, late=late)

    def close(self) -> None:
        pass


def changes(stream: DataFrame, delay: str, ttl_ms: int | None = NO_TTL) -> DataFrame:
    """Changes of a stream (roster, bucket, at, is_full, identities) whose rows may be late by ``delay``, and late rows.

    The session needs the RocksDB state store (STATE_STORE), which reads entries of a state one by one.
    """
    # The operator would drop rows from behind the watermark unseen; it does not know the copy of the time that it gets.
    rows = stream.withWatermark("at", delay).select("roster", "bucket", F.unix_millis("at").alias("at_ms"), "is_full", "identities")
    found = rows.groupBy("roster", "bucket").transformWithState(RosterState(ttl_ms), CHANGES, "Append", "EventTime")
    return found.select("roster", "bucket", F.timestamp_millis("at_ms").alias("at"), "change", "identity", "late")


def run(spark, stream: DataFrame, delay: str, out: str, checkpoint: str, ttl_ms: int | None = NO_TTL) -> None:
    """All that the stream has now, into ``out``, a folder for late rows and one for changes; started again, it goes on from the checkpoint."""
    name = "spark.sql.streaming.stateStore.providerClass"
    held = spark.conf.get(name, None)
    spark.conf.set(name, STATE_STORE)
    try:
        query = changes(stream, delay, ttl_ms).writeStream.format("parquet").partitionBy("late").option("path", out).option("checkpointLocation", checkpoint)
        query.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(name, held) if held else spark.conf.unset(name)
