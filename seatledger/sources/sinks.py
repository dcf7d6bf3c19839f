"""Sinks: partitioned Parquet inside, ordered JSON files for export."""

from __future__ import annotations

import json
import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.refs import ref_json
from ..schemas import EVENT_FIELDS
from .shared import put, written


def write_events(events: DataFrame, path: str) -> None:
    """The event store, by Congress; only the Congresses in ``events`` are replaced."""
    events.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("congress").parquet(path)


def save_events(events: DataFrame, path: str) -> None:
    """Edited events of a store put back in their place: they are written aside first, since they are read from there."""
    write_events(written(events, "edited"), path)


def write_atomic(path: str, data: bytes, spark: SparkSession | None = None) -> None:
    """A file appears whole or not at all; a path that names a store is written there."""
    if spark is not None and re.match(r"\w+:/", path):
        put(spark, path, data)
        return
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    fd, own = tempfile.mkstemp(dir=folder)
    try:
        with os.fdopen(fd, "wb") as f:
            f.write(data)
        os.replace(own, path)
    except BaseException:
        os.unlink(own)
        raise


def export_events(events: DataFrame, path: str) -> int:
    """One JSON array in document order, for people to read: a Congress has about a thousand events."""
    fields = [F.col(c) for c in EVENT_FIELDS if c != "source_ref"]
    rows = events.orderBy("doc_seq", "block_pos", "member_pos").select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("e"), ref_json().alias("r"))
    out = []
    for r in rows.toLocalIterator():
        event = json.loads(r["e"])
        event["source_ref"] = json.loads(r["r"]) if r["r"] else None
        out.append(event)
    write_atomic(path, json.dumps(out, indent=2, ensure_ascii=False).encode(), events.sparkSession)
    return len(out)


def export_site(path: str, committees: DataFrame, members: DataFrame, site: DataFrame) -> None:
    """The site's data in one compact JSON file."""
    c = {r["key"]: {"name": r["name"], "formerly": r["formerly"]} for r in committees.toLocalIterator()}
    m = {r["bioguide"]: {"name": r["name"], "state": r["state"], "party": r["party"]} for r in members.toLocalIterator()}
    e = [r.asDict() for r in site.toLocalIterator()]
    write_atomic(path, json.dumps({"committees": c, "members": m, "events": e}, separators=(",", ":"), ensure_ascii=False).encode(), site.sparkSession)
