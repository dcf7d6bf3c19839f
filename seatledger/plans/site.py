"""Reports over the event table: rollups, timelines, search, pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.relational import latest_name, page, pick_first, top


def missing(strict: bool = True) -> Column:
    """Nobody identified; ``strict`` asks for a printed name too, as reports do and the run summary does not."""
    none = F.col("bioguide_id").isNull() | (F.col("bioguide_id") == "")
    return none & (F.length(F.coalesce("member_name", F.lit(""))) > 0) if strict else F.col("bioguide_id").isNull()


def committee_key() -> Column:
    return F.coalesce(F.nullif("system_code", F.lit("")), F.concat(F.lit("name:"), T.normalise_committee(F.coalesce("committee", F.lit("")))))


def per_congress(events: DataFrame) -> DataFrame:
    """congress, total, additions, removals, missing; newest first."""
    return events.groupBy(F.col("congress").cast("int").alias("congress")).agg(
        F.count("*").alias("total"), F.count_if(F.col("change_type") == "addition").alias("additions"), F.count_if(F.col("change_type") == "removal").alias("removals"), F.count_if(missing()).alias("missing")
    ).orderBy(F.desc("congress"))


def files_report(files: DataFrame) -> DataFrame:
    """The per-Congress counts with the size of the file that they are from, as a reader downloads it."""
    sizes = files.groupBy(F.col("congress").cast("int").alias("congress")).agg(F.max("file_size").alias("file_size"))
    return per_congress(files).join(sizes, "congress").withColumn("size", T.human_size(F.col("file_size"))).withColumn("term", T.ordinal(F.col("congress"))).orderBy(F.desc("congress"))


def downloads_page(report: DataFrame) -> str:
    """The report as an HTML table; a row for each Congress comes to the driver."""
    import html

    cells = ("term", "total", "additions", "removals", "missing", "size")
    rows = "".join("<tr>" + "".join(f"<td>{html.escape(str(r[c]))}</td>" for c in cells) + "</tr>" for r in report.orderBy(F.desc("congress")).toLocalIterator())
    head = "".join(f"<th>{c}</th>" for c in cells)
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>Membership changes</title></head><body><table><tr>{head}</tr>{rows}</table></body></html>"


def summary(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count("*").alias("total"), F.count_if(F.col("change_type") == "addition").alias("additions"), F.count_if(F.col("change_type") == "removal").alias("removals"), F.count_if(missing(False)).alias("missing"),
        F.count_distinct("congress").alias("congresses"), F.min(F.col("congress").cast("int")).alias("first_congress"), F.max(F.col("congress").cast("int")).alias("last_congress"),
    )


def current_alert(events: DataFrame) -> DataFrame:
    """The newest Congress, if persons are missing in it."""
    return top(per_congress(events), 1, F.desc("congress")).where("missing > 0")


def committees(events: DataFrame) -> DataFrame:
    """key, name (the one of the last event of the newest Congress), formerly (other names in order)."""
    keyed = events.withColumn("key", committee_key()).withColumn("_c", F.col("congress").cast("int")).withColumn("committee", F.coalesce("committee", F.lit("")))
    return latest_name(keyed, "key", "committee", ["_c", "doc_seq", "block_pos", "member_pos"])


def members(events: DataFrame, legislators: DataFrame) -> DataFrame:
    """bioguide, name, state, party of those in the events: the first record of each, its last House term."""
    needed = events.where("coalesce(bioguide_id, '') <> ''").select(F.col("bioguide_id").alias("bioguide")).distinct()
    last = F.try_element_at(F.filter("terms", lambda t: t["type"] == "rep"), F.lit(-1))
    name = F.coalesce(F.nullif("name.official_full", F.lit("")), F.trim(F.concat_ws(" ", "name.first", "name.last")))
    order = F.col("rec_pos") if "rec_pos" in legislators.columns else F.monotonically_increasing_id()
    rows = legislators.select(F.col("id.bioguide").alias("bioguide"), name.alias("name"), last["state"].alias("state"), last["party"].alias("party"), order.alias("_sl_pos"))
    return pick_first(rows.join(needed, "bioguide", "left_semi"), ["bioguide"], [F.col("_sl_pos")]).drop("_sl_pos")


def compact(events: DataFrame) -> DataFrame:
    """Events with the short field names of the site: c, t, k, n, b, d, r, u."""
    return events.select(
        F.col("congress").cast("int").alias("c"), F.when(F.col("change_type") == "addition", "a").otherwise("r").alias("t"), committee_key().alias("k"), F.col("member_name").alias("n"), F.col("bioguide_id").alias("b"),
        F.col("date").alias("d"), F.col("party_rank").alias("r"), F.coalesce(F.nullif("source_ref.congress_gov_url", F.lit("")), F.col("source_ref.url")).alias("u"),
    )


def changes_by_congress(site: DataFrame) -> DataFrame:
    return site.groupBy("c").agg(F.count_if(F.col("t") == "a").alias("additions"), F.count_if(F.col("t") == "r").alias("removals")).orderBy("c")


def removals_by_year(site: DataFrame) -> DataFrame:
    return site.where("t = 'r' and coalesce(d, '') <> ''").groupBy(F.substring("d", 1, 4).alias("year")).count().orderBy("year")


def most(site: DataFrame, key: str, n: int, removals: bool = False) -> DataFrame:
    """The ``n`` keys with the most events, or removals; ties by key."""
    rows = site.where(F.col(key).isNotNull())
    return top((rows.where("t = 'r'") if removals else rows).groupBy(key).agg(F.count("*").alias("n")), n, F.desc("n"), F.col(key))


def named(site: DataFrame, members_: DataFrame, committees_: DataFrame) -> DataFrame:
    """Events with display names; what is unknown keeps its own."""
    m = members_.select(F.col("bioguide").alias("b"), F.col("name").alias("_m"))
    c = committees_.select(F.col("key").alias("k"), F.col("name").alias("_c"))
    return site.join(m, "b", "left").join(c, "k", "left").withColumn("member", F.coalesce("_m", "n")).withColumn("committee", F.coalesce("_c", "k")).drop("_m", "_c")


def timeline(site: DataFrame, key: str) -> DataFrame:
    """Events of one committee by Congress, each with its place in the term."""
    rows = site.where(F.col("k") == key).withColumn("at", T.date_fraction(F.col("c"), F.col("d")))
    return rows.groupBy("c").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("d", F.lit("")).alias("d"), "t", "n", "at"))).alias("events")).orderBy("c")


def event_log(site: DataFrame, key: str) -> DataFrame:
    return site.where(F.col("k") == key).orderBy(F.coalesce("d", F.lit("")).desc())


def member_history(site: DataFrame, bioguide: str) -> DataFrame:
    rows = site.where(F.col("b") == bioguide)
    return rows.groupBy("c").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("d", F.lit("")).alias("d"), "t", "k", "r", "u"))).alias("events")).orderBy(F.desc("c"))


def picker(site: DataFrame, committees_: DataFrame) -> DataFrame:
    """Committees by number of events."""
    counts = site.groupBy(F.col("k").alias("key")).agg(F.count("*").alias("n"))
    return committees_.join(counts, "key").orderBy(F.desc("n"), "name")


def browse(events: DataFrame, number: int = 1, only_missing: bool = True, query: str = "", size: int = 50) -> DataFrame:
    """A page of events, with those whose name or committee holds ``query``."""
    rows = events.where(missing()) if only_missing else events
    if query:
        has = lambda c: F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(query.lower()))
        rows = rows.where(has("member_name") | has("committee"))
    return page(rows, [F.col("doc_seq"), F.col("block_pos"), F.col("member_pos")], number, size)


def search_people(legislators: DataFrame, query: str, n: int = 200) -> DataFrame:
    """People whose folded name holds the folded query."""
    name = F.coalesce(F.nullif("name.official_full", F.lit("")), F.concat_ws(" ", "name.first", "name.last"))
    rows = legislators.select(F.col("id.bioguide").alias("bioguide"), name.alias("name"))
    return rows.where(F.contains(T.fold(F.col("name"), False), T.fold(F.lit(query), False))).orderBy("name", "bioguide").limit(n)


def search_members(members_: DataFrame, query: str, n: int = 25) -> DataFrame:
    """As a reader types: nothing under two letters."""
    if len(query.strip()) < 2:
        return members_.limit(0)
    return members_.where(F.contains(T.fold(F.col("name"), False), T.fold(F.lit(query.strip()), False))).orderBy("name", "bioguide").limit(n)
