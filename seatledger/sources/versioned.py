"""A table that edits rewrite file by file, with all readers on one version.

A version is a manifest: the files of the table with their least and greatest key. Files of a
version hold ranges of keys that do not overlap. A merge finds the files that its keys fall
into, writes new ones for these alone, and swaps the manifest in one rename; files of older
versions stay for readers who have begun. The manifest remembers the merges it holds, so one
that runs again changes nothing.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import get, put

FILE = "_sl_file"


class Conflict(RuntimeError):
    """Another writer has swapped the manifest meanwhile."""


def _described(df: DataFrame, key: str) -> list[dict]:
    """The files behind ``df`` with their key ranges and rows, in order of keys; a short row for each file."""
    rows = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count("*").alias("rows")).collect()
    return sorted((r.asDict() for r in rows), key=lambda r: r["lo"])


class Table:
    """A table at ``path`` with one row for each value of ``key`` (a number or a string, never null)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @property
    def manifest(self) -> dict:
        return json.loads(get(self.spark, f"{self.path}/manifest.json"))

    def _write(self, df: DataFrame, key: str, files: int) -> list[dict]:
        path = f"{self.path}/data/{uuid.uuid4().hex}"
        df.repartitionByRange(files, key).sortWithinPartitions(key).write.parquet(path)
        return _described(self.spark.read.schema(df.schema).parquet(path), key)

    def create(self, df: DataFrame, key: str, rows_in_file: int = 1_000_000) -> "Table":
        files = self._write(df, key, max(1, -(-df.count() // rows_in_file)))
        self._swap(None, {"version": 0, "key": key, "schema": df.schema.json(), "rows_in_file": rows_in_file, "files": files, "merges": []})
        return self

    def _swap(self, before: dict | None, after: dict) -> None:
        held = get(self.spark, f"{self.path}/manifest.json")
        if (json.loads(held)["version"] if held else None) != (before["version"] if before else None):
            raise Conflict(self.path)
        put(self.spark, f"{self.path}/manifest.json", json.dumps(after).encode())

    def _files(self, manifest: dict, files: list[dict]) -> DataFrame:
        from pyspark.sql.types import StructType

        schema = StructType.fromJson(json.loads(manifest["schema"]))
        return self.spark.read.schema(schema).parquet(*[f["path"] for f in files]) if files else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        """The table as of now."""
        manifest = self.manifest
        return self._files(manifest, manifest["files"])

    def merge(self, edits: DataFrame, merge_id: str, delete: str | None = None) -> dict:
        """Rows of ``edits`` replace those of their key or are added; where the column ``delete`` is true they go. The manifest after it.

        Keys of ``edits`` are distinct. Non-key columns that ``edits`` lacks keep their values, and are null in added rows.
        """
        manifest = self.manifest
        if merge_id in manifest["merges"]:
            return manifest
        key, files = manifest["key"], manifest["files"]
        kind = dict(edits.dtypes)[key]
        lows = [f["lo"] for f in files]

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = [max(0, bisect_right(lows, k) - 1) for k in batch[0].to_pylist()]
                yield pa.RecordBatch.from_arrays([batch[0], pa.array(at, pa.int32())], names=[key, FILE])

        touched = sorted(r[0] for r in edits.select(key).mapInArrow(place, f"{key} {kind}, {FILE} int").select(FILE).distinct().collect())
        if not touched and files:
            self._swap(manifest, after := manifest | {"version": manifest["version"] + 1, "merges": [*manifest["merges"], merge_id]})
            return after
        old = self._files(manifest, [files[k] for k in touched if files])
        mine = [c for c in old.columns if c != key and c in edits.columns]
        gone = F.coalesce(F.col(f"_sl_e.{delete}"), F.lit(False)) if delete else F.lit(False)
        both = old.alias("_sl_o").join(edits.withColumn("_sl_hit", F.lit(True)).alias("_sl_e"), key, "full").where(~gone)
        value = lambda c: F.when(F.col("_sl_e._sl_hit"), F.col(f"_sl_e.{c}")).otherwise(F.col(f"_sl_o.{c}")) if c in mine else F.col(f"_sl_o.{c}")
        new = both.select(*[F.col(key) if c == key else value(c).alias(c) for c in old.columns])
        written = self._write(self.spark.createDataFrame([], old.schema).unionByName(new), key, max(1, len(touched)))
        kept = [f for k, f in enumerate(files) if k not in set(touched)]
        after = manifest | {"version": manifest["version"] + 1, "files": sorted(kept + written, key=lambda f: f["lo"]), "merges": [*manifest["merges"], merge_id]}
        self._swap(manifest, after)
        return after
