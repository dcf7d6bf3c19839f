"""Committee names to system codes, historical names included."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalise_committee
from .relational import first_wins


def records(listed: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """rec_pos, systemCode, name, previous_names from list rows (rec_pos, systemCode, name, parent) and details (systemCode, history).

    Subcommittees and rows without a code go; a committee without detail keeps its name only.
    """
    top = listed.where("parent is null and coalesce(systemCode, '') <> ''").withColumn("name", F.coalesce("name", F.lit("")))
    if details is None:
        return top.select("rec_pos", "systemCode", "name", F.array("name").alias("previous_names"))
    given = lambda n: F.filter(F.array(n["officialName"], n["libraryOfCongressName"]), lambda x: F.coalesce(x, F.lit("")) != "")
    found = details.select("systemCode", F.flatten(F.transform("history", given)).alias("_sl_past"))
    return top.join(found, "systemCode", "left").select("rec_pos", "systemCode", "name", F.concat(F.array("name"), F.coalesce("_sl_past", F.array().cast("array<string>"))).alias("previous_names"))


def index(recs: DataFrame) -> DataFrame:
    """norm_name, system_code, collides: the first record that has a name keeps it."""
    names = recs.where("coalesce(systemCode, '') <> ''").select(
        "rec_pos", F.col("systemCode").alias("system_code"), F.posexplode(F.concat(F.array(F.coalesce("name", F.lit(""))), F.coalesce("previous_names", F.array().cast("array<string>")))).alias("name_pos", "_sl_name")
    )
    keyed = names.withColumn("norm_name", normalise_committee(F.coalesce("_sl_name", F.lit("")))).where("norm_name <> ''")
    return first_wins(keyed, "norm_name", "system_code", ["rec_pos", "name_pos"])


def fill_codes(events: DataFrame, idx: DataFrame) -> DataFrame:
    """``events`` with null system codes looked up by committee name."""
    small = idx.select("norm_name", F.col("system_code").alias("_sl_code"))
    keyed = events.withColumn("norm_name", normalise_committee(F.coalesce("committee", F.lit(""))))
    return keyed.join(small, "norm_name", "left").withColumn("system_code", F.coalesce("system_code", "_sl_code")).drop("norm_name", "_sl_code").select(*events.columns)
