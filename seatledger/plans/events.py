"""From landed tables to the event table: House, Senate, letters, merge."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T
from ..functions.refs import make_ref
from ..operators import blocks, classify, committees, letters, members, resolve, roster
from ..operators.relational import carry_forward, pick_first, priority, union_all
from ..schemas import EVENT_FIELDS
from ..sources import urls
from ..sources.shared import written

log = logging.getLogger(__name__)
BILL = ["congress", "bill_type", "number"]
#: What tells an event from all others: a number in the list is one of a Congress, chamber and source only.
EVENT_KEY = ["congress", "chamber", "source", "doc_seq", "block_pos", "member_pos"]


@dataclass(frozen=True)
class Landed:
    """Input tables. What is None is missing: names stay unresolved, codes unfilled, branches empty.

    bills (congress, bill_type, number, title, api_pos, update_date), actions (congress, bill_type, number,
    actions), renditions (see schemas), packages (packageId, dateIssued), granules (packageId, granuleId,
    title, pos), summaries and texts by granuleId, legislators, committee records.
    """

    bills: DataFrame | None = None
    actions: DataFrame | None = None
    renditions: DataFrame | None = None
    packages: DataFrame | None = None
    granules: DataFrame | None = None
    summaries: DataFrame | None = None
    texts: DataFrame | None = None
    legislators: DataFrame | None = None
    committees: DataFrame | None = None


def best_rendition(renditions: DataFrame, stages: tuple[str, ...]) -> DataFrame:
    """One rendition for each bill: XML before text, the first host before the second, stages in order."""
    ranked = renditions.withColumn("stage_rank", priority(F.col("stage"), stages)).where("stage_rank is not null")
    ranked = ranked.withColumn("format_rank", F.when(F.col("format") == "xml", 0).otherwise(1)).withColumn("host_rank", F.when(F.col("host") == "govinfo", 0).otherwise(1))
    usable = ranked.where("format_rank = 1 or host_rank = 0")
    return pick_first(usable, BILL, [F.col("format_rank"), F.col("host_rank"), F.col("stage_rank")]).drop("stage_rank", "format_rank", "host_rank")


def _since(bills: DataFrame, since: str | None) -> DataFrame:
    return bills if since is None else bills.where(F.col("update_date") >= since)


def _documents(bills: DataFrame, landed: Landed, stages: tuple[str, ...], must_agree: bool) -> DataFrame:
    """Bills with their best rendition and agreed date; bodies are joined last, after every filter on titles and dates."""
    agreed = landed.actions.select(*BILL, classify.agreed_date(F.col("actions")).alias("agreed"))
    dated = bills.join(agreed, BILL, "left")
    dated = dated.where("agreed is not null") if must_agree else dated
    return dated.join(best_rendition(landed.renditions, stages), BILL)


def house(landed: Landed, congress: int, since: str | None = None) -> DataFrame:
    """Events of House resolutions that were agreed to."""
    bills = classify.house_bills(_since(landed.bills.where((F.col("congress") == congress) & (F.col("bill_type") == "hres")), since))
    docs = _documents(bills, landed, P.HOUSE_STAGES, True).withColumnRenamed("stage", "rendition_stage")
    own = ["congress", "bill_type", "number", "title", "change_type", "api_pos", "agreed", "rendition_stage", "host", "format", "body"]
    xml = blocks.house_xml(docs.where("format = 'xml'").select(*[c for c in own if c not in ("title", "change_type")]))
    # XML carries its own title; where it tells nothing, the change counts as an addition.
    xml = xml.where("error is null").withColumn("change_type", F.coalesce(classify.house_change(F.col("title")), F.lit("addition"))).withColumn("doc_date", T.compact_date(F.col("doc_date")))
    text = blocks.house_text(docs.where("format <> 'xml'").select(*own)).withColumn("stage", F.col("rendition_stage"))
    kept = ["congress", "number", "change_type", "api_pos", "agreed", "stage", "host", "rendition_stage", "format", "doc_date", "block_pos", "committee", "code", "pairs", "ranked"]
    both = xml.select(*kept).unionByName(text.select(*kept))
    window = F.col("ranked") & T.in_organizing_window(F.col("congress"), F.col("doc_date"))
    rows = members.member_rows(both, in_window=window)
    return _resolution_events(rows, landed, "house")


def _resolution_events(rows: DataFrame, landed: Landed, chamber: str) -> DataFrame:
    package = urls.package_id(F.col("congress"), F.col("number"), F.col("rendition_stage"), "hres" if chamber == "house" else "sres")
    source = urls.html_url(F.when(F.col("host") == "govinfo", package).otherwise(urls.congress_text_url(F.col("congress"), F.col("number"), F.col("rendition_stage"), "hres" if chamber == "house" else "sres")))
    if chamber == "house":
        source = F.when(F.col("format") == "xml", urls.xml_url(package)).otherwise(source)
    ref = make_ref("resolution", number=F.col("number"), stage=F.coalesce("stage", "rendition_stage"), agreed_to_date=F.col("agreed"), congress_gov_url=urls.bill_url(F.col("congress"), F.col("number"), chamber), govinfo_xml_url=source)
    date = F.coalesce("agreed", "doc_date")
    out = rows.select(
        F.col("congress").cast("string").alias("congress"), F.lit(chamber).alias("chamber"), "change_type", "committee", F.lit(None).cast("string").alias("system_code"), F.col("code").alias("gpo_code"), "member_name",
        "member_name_raw", F.col("party_rank").cast("int").alias("party_rank"), date.alias("date"), F.lit("resolution").alias("source"), ref.alias("source_ref"), F.col("agreed").alias("on_date"),
        F.col("api_pos").cast("long").alias("doc_seq"), F.col("block_pos").cast("int").alias("block_pos"), F.col("member_pos").cast("int").alias("member_pos"),
        *(["bioguide_id"] if "bioguide_id" in rows.columns else []),
    )
    return _identified(out, landed, chamber)


def _identified(events: DataFrame, landed: Landed, chamber: str, printed: str = "member_name") -> DataFrame:
    """The event table's columns, with persons (unless the rows bring them) and committee codes."""
    if "bioguide_id" in events.columns:
        pass
    elif landed.legislators is not None:
        events = resolve.attach(events, resolve.candidates(landed.legislators, chamber), printed, "on_date")
    else:
        events = events.withColumn("bioguide_id", F.lit(None).cast("string"))
    if landed.committees is not None:
        events = committees.fill_codes(events, committees.index(landed.committees))
    return events.select(*EVENT_FIELDS, "doc_seq", "block_pos", "member_pos")


def senate_history(landed: Landed, congress: int, since: str | None = None) -> DataFrame:
    """Roster rows by committee and party, in the order in which they took effect; members carry their identity."""
    bills = classify.senate_bills(_since(landed.bills.where((F.col("congress") == congress) & (F.col("bill_type") == "sres")), since))
    docs = _documents(bills, landed, P.SENATE_STAGES, False).withColumnRenamed("stage", "rendition_stage").drop("update_date")
    xml = blocks.senate_xml(docs.where("format = 'xml'").drop("title")).where("error is null").withColumn("single", F.lit(False)).withColumn("doc_date", T.compact_date(F.col("doc_date")))
    text = blocks.senate_text(docs.where("format <> 'xml'")).withColumn("doc_date", F.lit(None).cast("string")).withColumn("stage", F.col("rendition_stage"))
    kept = ["congress", "number", "party", "api_pos", "agreed", "stage", "rendition_stage", "host", "format", "doc_date", "block_pos", "committee", "code", "pairs", "single"]
    both = xml.select(*kept).unionByName(text.select(*kept)).withColumn("on_date", F.col("agreed"))
    # Undated resolutions come first; equal dates keep the order of the list; blocks keep theirs.
    both = both.withColumn("seq", F.struct(F.coalesce("agreed", F.lit("")).alias("d"), F.col("api_pos").cast("long").alias("a"), F.col("block_pos").alias("b")))
    rows = both.select("*", F.posexplode_outer("pairs").alias("pos", "pair")).withColumn("printed", F.col("pair.clean"))
    if landed.legislators is not None:
        rows = resolve.attach(rows, resolve.candidates(landed.legislators, "senate"), "printed", "on_date")
    else:
        rows = rows.withColumn("bioguide_id", F.lit(None).cast("string"))
    identity = F.coalesce("bioguide_id", F.concat(F.lit("name:"), F.lower("printed")))
    payload = F.struct(F.col("pair.clean").alias("clean"), F.col("pair.raw").alias("raw"), F.col("bioguide_id").alias("bioguide"))
    member = F.when(F.col("pos").isNotNull(), F.struct("pos", identity.alias("identity"), payload.alias("payload")))
    doc = ["congress", "committee", "party", "seq", "number", "stage", "rendition_stage", "host", "format", "doc_date", "agreed", "code", "single", "api_pos", "block_pos"]
    grouped = rows.groupBy(*doc).agg(F.array_sort(F.collect_list(member)).alias("ordered"))
    return grouped.withColumn("members", F.transform("ordered", lambda m: F.struct(m["identity"].alias("identity"), m["payload"].alias("payload")))).withColumn("is_full", ~F.col("single")).drop("ordered")


def senate(landed: Landed, congress: int, since: str | None = None) -> DataFrame:
    """Events of Senate rosters: what each one adds and removes, with the person that the roster named."""
    # The diff reads the history several times; documents are parsed and names resolved once.
    history = written(senate_history(landed, congress, since), "senate-history")
    keys = ["congress", "committee", "party"]
    changes = roster.diff(history.select(*keys, "seq", "is_full", "members"), keys).withColumnRenamed("change", "change_type")
    docs = history.drop("members", "is_full", "single")
    removals_last = F.when(F.col("change_type") == "removal", F.lit(1 << 20)).otherwise(0) + F.col("pos")
    rows = changes.join(docs, [*keys, "seq"]).select(
        *[c for c in docs.columns if c != "seq"], "change_type", removals_last.alias("member_pos"), F.col("payload.clean").alias("member_name"), F.col("payload.raw").alias("member_name_raw"),
        F.col("payload.bioguide").alias("bioguide_id"), F.lit(None).cast("int").alias("party_rank"),
    )
    return _resolution_events(rows, landed, "senate")


def discovered(landed: Landed, start: str, end: str) -> DataFrame:
    """Granules of packages issued from ``start`` up to ``end`` whose title tells of a resignation; titles decide before any text is read."""
    packages = landed.packages.where((F.col("dateIssued") >= start) & (F.col("dateIssued") < end))
    return packages.join(landed.granules.where(classify.is_resignation(F.col("title"))), "packageId")


#: Letters follow all resolutions, by day of issue and place in it.
LETTERS = 10**18


def letter_seq(package: Column, pos: Column) -> Column:
    day = F.coalesce(F.replace(T.issue_date(package), F.lit("-"), F.lit("")).cast("long"), F.lit(0))
    return F.lit(LETTERS) + day * F.lit(10**9) + F.coalesce(pos.cast("long"), F.lit(0))


def record(landed: Landed, congress: int, start: str, end: str) -> DataFrame:
    """Events of letters of resignation; letters of several signers are left out."""
    found = discovered(landed, start, end).where(~classify.has_several_signers(F.col("title")))
    read = found.join(landed.texts.select("granuleId", F.col("body").alias("text_body")), "granuleId", "left")
    if landed.summaries is not None:
        read = read.join(landed.summaries.select("granuleId", F.col("detailsLink").alias("link")), "granuleId", "left")
    else:
        read = read.withColumn("link", F.lit(None).cast("string"))
    text = F.coalesce(F.when(F.col("text_body").isNotNull(), T.pre_text(F.col("text_body"))), F.lit(""))
    parsed = read.withColumn("_sl_text", text).withColumn("p", letters.parse(F.col("title"), F.col("_sl_text"))).withColumn("on_date", T.issue_date(F.col("packageId"))).withColumn("printed", T.signer_name(F.col("p.member_name")))
    # Names are resolved through a join of these rows with themselves: letters are parsed once, and the plan stays small.
    parsed = written(parsed.select("packageId", "granuleId", "pos", "link", "p", "on_date", "printed"), "parsed-letters")
    url = F.coalesce(F.nullif("link", F.lit("")), urls.package_url(F.col("packageId")))
    ref = make_ref("record", page=F.nullif(F.regexp_extract("granuleId", r"Pg([A-Z]\d+)", 1), F.lit("")), granule_id=F.col("granuleId"), signed_date=F.col("p.signed_date"), url=url)
    # A letter without a committee is still one event.
    rows = parsed.select("*", F.posexplode_outer("p.committees").alias("block_pos", "one"))
    events = rows.select(
        F.lit(str(congress)).alias("congress"), F.lit("house").alias("chamber"), F.lit("removal").alias("change_type"), F.coalesce("one", F.lit("")).alias("committee"), F.lit(None).cast("string").alias("system_code"),
        F.lit(None).cast("string").alias("gpo_code"), F.col("p.member_name").alias("member_name"), F.lit(None).cast("string").alias("member_name_raw"), F.lit(None).cast("int").alias("party_rank"), F.col("on_date").alias("date"),
        F.lit("congressional_record").alias("source"), ref.alias("source_ref"), "on_date", "printed", letter_seq(F.col("packageId"), F.col("pos")).alias("doc_seq"), F.coalesce("block_pos", F.lit(0)).cast("int").alias("block_pos"), F.lit(0).alias("member_pos"),
    )
    return _identified(events, landed, "house", printed="printed")


def merge_ids(new: DataFrame, previous: DataFrame) -> DataFrame:
    """``new`` with null persons filled from the last previous event of the same change, committee, member and document."""
    key = lambda d: d.withColumn("_t", F.col("source_ref.type")).withColumn("_r", F.coalesce(F.nullif("source_ref.number", F.lit("")), F.col("source_ref.granule_id")))
    old = key(previous).withColumn("_sl_seq", F.struct("doc_seq", "block_pos", "member_pos"))
    return carry_forward(key(new), old, ["change_type", "committee", "member_name", "_t", "_r"], "bioguide_id", "_sl_seq").drop("_t", "_r")


def collect(landed: Landed, congress: int, chamber: str = "house", source: str = "all", since: str | None = None, previous: DataFrame | None = None) -> DataFrame:
    """The event table of a Congress: resolutions, letters or both, with corrections of the previous run."""
    span = (f"{1789 + (congress - 1) * 2}-01-03", f"{1789 + congress * 2}-01-03")
    if chamber == "senate":
        parts = [senate(landed, congress, since)]
    else:
        parts = [house(landed, congress, since)] if source in ("resolution", "all") else []
        if source in ("record", "all") and landed.packages is not None:
            try:
                # Letters are the lesser source: where reading them fails, the resolutions still go out.
                parts.append(written(record(landed, congress, since or span[0], span[1]), "letters"))
            except Exception as error:
                if not parts:
                    raise
                log.warning("letters of Congress %s left out: %s", congress, str(error)[:500])
    events = union_all(parts)
    return events if previous is None else merge_ids(events, previous)


def corrected(events: DataFrame, edits: DataFrame) -> DataFrame:
    """``events`` with row edits (the columns of ``EVENT_KEY``, field, value): a blank committee is ignored,
    a blank rank is null and one that is no number ignored, other blanks are null."""
    key = EVENT_KEY
    edits = edits.withColumn("congress", F.col("congress").cast("string"))
    fields = ("committee", "member_name", "bioguide_id", "party_rank", "date")
    picked = edits.groupBy(*key).agg(*[F.max(F.when(F.col("field") == f, F.struct(F.trim("value").alias("v")))).alias(f"_e_{f}") for f in fields])
    out = events.join(picked, key, "left")
    for f in fields:
        edit, v = F.col(f"_e_{f}"), F.col(f"_e_{f}.v")
        if f == "committee":
            new = F.when(v != "", v).otherwise(F.col(f))
        elif f == "party_rank":
            new = F.when(v == "", F.lit(None)).when(v.rlike(r"^[+-]?\d+$"), v.try_cast("int")).otherwise(F.col(f))
        else:
            new = F.nullif(v, F.lit(""))
        out = out.withColumn(f, F.when(edit.isNotNull(), new).otherwise(F.col(f)))
    return out.select(*events.columns)
