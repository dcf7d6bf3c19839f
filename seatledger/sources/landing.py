"""Readers of landed payloads: JSON pages, renditions, legislators, earlier output, stores."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S


def bills(spark: SparkSession, path: str) -> DataFrame:
    """congress, bill_type, number, title, api_pos, update_date from list pages; api_pos keeps the order over pages."""
    pages = spark.read.schema(S.BILLS_PAGE).json(path)
    rows = pages.select("congress", "bill_type", "page", F.posexplode("bills").alias("pos", "b"))
    return rows.select("congress", "bill_type", F.col("b.number").alias("number"), F.coalesce("b.title", F.lit("")).alias("title"), (F.col("page") * 1_000_000 + F.col("pos")).cast("long").alias("api_pos"), F.col("b.updateDate").alias("update_date"))


def actions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.ACTIONS_PAGE).json(path)


def committee_list(spark: SparkSession, path: str) -> DataFrame:
    """chamber, rec_pos, systemCode, name, parent; rec_pos keeps the order over pages."""
    rows = spark.read.schema(S.COMMITTEES_PAGE).json(path).select("chamber", F.coalesce("page", F.lit(0)).alias("page"), F.posexplode("committees").alias("at", "c"))
    return rows.select("chamber", (F.col("page") * 1_000_000 + F.col("at")).cast("int").alias("rec_pos"), F.col("c.systemCode").alias("systemCode"), F.col("c.name").alias("name"), F.col("c.parent.systemCode").alias("parent"))


def committee_details(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.COMMITTEE_DETAIL).json(path).select("systemCode", F.col("committee.history").alias("history"))


def packages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.PACKAGES_PAGE).json(path).select(F.explode("packages").alias("p")).select("p.packageId", "p.dateIssued")


def granules(spark: SparkSession, path: str) -> DataFrame:
    """packageId, pos, granuleId, title; ``pos`` keeps the order over pages."""
    rows = spark.read.schema(S.GRANULES_PAGE).json(path).select("packageId", F.coalesce("page", F.lit(0)).alias("page"), F.posexplode("granules").alias("at", "g"))
    return rows.select("packageId", (F.col("page") * 1_000_000 + F.col("at")).cast("long").alias("pos"), "g.granuleId", "g.title")


def renditions(spark: SparkSession, path: str) -> DataFrame:
    """Files named BILLS-<congress><type><number><stage>.<xml|htm> in folders by host; the body is UTF-8."""
    files = spark.read.format("binaryFile").load(path)
    name = r"BILLS-(\d+)([hs]res)(\d+)([a-z]+)\.(xml|htm)"
    g = lambda i: F.regexp_extract("path", name, i)
    return files.where(F.col("path").rlike(name)).select(
        g(1).cast("int").alias("congress"), g(2).alias("bill_type"), g(3).alias("number"), F.regexp_extract("path", r"([^/]+)/BILLS-", 1).alias("host"), g(4).alias("stage"),
        F.when(g(5) == "xml", "xml").otherwise("text").alias("format"), F.decode("content", "UTF-8").alias("body"),
    )


def legislators(spark: SparkSession, paths: list[str]) -> DataFrame:
    """YAML files of people as rows, in order (rec_pos); a legislature has some ten thousand, parsed on the driver."""
    import yaml

    rows = []
    for path in paths:
        for r in spark.read.format("binaryFile").load(path).orderBy("path").select("content").toLocalIterator():
            rows += [json.dumps(x, default=str) for x in yaml.safe_load(bytes(r["content"]).decode()) or []]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "rec_pos long, j string")
    return frame.select("rec_pos", F.from_json("j", S.LEGISLATORS).alias("r")).select("rec_pos", "r.*")


def _arrays(spark: SparkSession, path: str) -> DataFrame:
    """Events of exported files with file, file_size and their places: an export is one JSON array, and its order is the events'."""
    fields = ", ".join(c for c in S.EVENTS.split(", ") if not c.startswith(("doc_seq", "block_pos", "member_pos")))
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("file_size"))
    rows = files.select("file", "file_size", F.posexplode(F.from_json("value", f"array<struct<{_nested(fields)}>>")).alias("doc_seq", "e"))
    return rows.select("e.*", F.col("doc_seq").cast("long").alias("doc_seq"), F.lit(0).alias("block_pos"), F.lit(0).alias("member_pos"), "file", "file_size").where("change_type is not null")


def _nested(ddl: str) -> str:
    """Top-level columns of a schema in the form of struct fields."""
    return ",".join(":".join(c.split(" ", 1)) for c in ddl.split(", "))


def previous_events(spark: SparkSession, path: str) -> DataFrame:
    """An earlier output file, in its order; a missing or broken one is empty."""
    try:
        return _arrays(spark, path).drop("file", "file_size")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], S.EVENTS)


#: Names of output files; the site reads those of both chambers, the editor those of the House.
OUTPUT_NAME = r"committee_changes_(?:senate_)?(\d+)\.json"
HOUSE_NAME = r"^committee_changes_(\d+)\.json$"


def congress_files(spark: SparkSession, path: str, names: str = OUTPUT_NAME) -> DataFrame:
    """Events of the output files of a folder, by file name, with the Congress of the name and the file's name and size."""
    number = F.regexp_extract("file", names, 1)
    return _arrays(spark, path).where(F.col("file").rlike(names)).withColumn("congress", number).orderBy("file", "doc_seq")


def store_congresses(spark: SparkSession, path: str) -> DataFrame:
    """congress of every part of an event store, newest first."""
    return spark.read.parquet(path).select(F.col("congress").cast("int").alias("congress")).distinct().orderBy(F.desc("congress"))


def store_events(spark: SparkSession, path: str, congress: int) -> DataFrame:
    """The events of one Congress of a store, in order; only its folder is read."""
    rows = spark.read.schema(S.EVENTS).parquet(path).where(F.col("congress") == str(congress))
    return rows.orderBy("doc_seq", "block_pos", "member_pos")


SITE = (
    "committees map<string,struct<name:string,formerly:array<string>>>, members map<string,struct<name:string,state:string,party:string>>, "
    "events array<struct<c:int,t:string,k:string,n:string,b:string,d:string,r:int,u:string>>"
)


def site_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The site's data as its reports read it: committees, members, events."""
    whole = spark.read.schema(SITE).option("multiLine", True).json(path)
    committees = whole.select(F.explode("committees").alias("key", "v")).select("key", "v.*")
    members = whole.select(F.explode("members").alias("bioguide", "v")).select("bioguide", "v.*")
    return committees, members, whole.select(F.posexplode("events").alias("pos", "e")).select("pos", "e.*")


def cached_records(spark: SparkSession, path: str, fetch) -> DataFrame:
    """Committee records from the table at ``path``; where there is none, or it cannot be read, ``fetch()`` makes them and they are stored."""
    schema = "rec_pos int, systemCode string, name string, previous_names array<string>"
    try:
        held = spark.read.schema(schema).parquet(path)
        if not held.where("systemCode is not null").isEmpty():
            return held
    except Exception as error:  # missing or damaged is mended by fetching; a store that cannot be reached or read is not
        if not any(sign in str(error) for sign in ("PATH_NOT_FOUND", "is not a Parquet file", "CANNOT_READ_FILE_FOOTER", "FAILED_READ_FILE.CANNOT", "CORRUPT")):
            raise
    fetch().select("rec_pos", "systemCode", "name", "previous_names").write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)
