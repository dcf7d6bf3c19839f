"""The source of an event: a tagged struct inside, its own fields outside."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import REF_FIELDS, SOURCE_REF


def make_ref(kind: str, **fields: Column) -> Column:
    kinds = [f.split(":")[0] for f in SOURCE_REF[len("struct<") : -1].split(",")]
    given = {"type": F.lit(kind)} | fields
    return F.struct(*[given.get(k, F.lit(None)).cast("string").alias(k) for k in kinds])


def ref_json(ref: Column | None = None) -> Column:
    """The source reference with the fields of its type only."""
    ref = F.col("source_ref") if ref is None else ref
    out = F.lit(None).cast("string")
    for kind, fields in REF_FIELDS.items():
        out = F.when(ref["type"] == kind, F.to_json(F.struct(*[ref[f].alias(f) for f in fields]), {"ignoreNullFields": "false"})).otherwise(out)
    return out
