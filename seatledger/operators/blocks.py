"""Committee blocks of a document: from XML blocks or from plain text, one row for each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import notes as N
from ..functions import patterns as P
from ..functions import text as T
from ..schemas import PAIRS
from ..sources import xmldocs
from . import members as M

BLOCK = f"array<struct<committee:string,code:string,pairs:{PAIRS},ranked:boolean>>"


def _block(committee: Column, pairs: Column, code: Column | None = None, ranked: bool = True) -> Column:
    code = F.lit(None).cast("string") if code is None else code
    return F.struct(committee.alias("committee"), code.alias("code"), pairs.alias("pairs"), F.lit(ranked).alias("ranked"))


def _segments(text: Column, start: str) -> Column:
    """``text`` cut before each place where ``start`` matches, without what stands before the first."""
    return F.filter(F.split(text, f"(?={start})"), lambda s: s.rlike(f"^{start}"))


def _parted(segment: Column, mark: str) -> Column:
    """Header and body of a segment: what stands before and after the first mark; a null body without one."""
    return T.let(F.split(segment, mark, 2), lambda parts: F.struct(F.trim(F.get(parts, F.lit(0))).alias("head"), F.trim(F.get(parts, F.lit(1))).alias("body")))


def _told(parts: Column) -> Column:
    """The parted segments that have a body."""
    return F.filter(parts, lambda p: F.coalesce(p["body"], F.lit("")) != "")


def _before(text: Column, mark: str) -> Column:
    return F.get(F.split(text, mark, 2), F.lit(0))


#: What follows the last member of a document. Like the header below, it begins with one character, which most places fail at once.
END = r"(?i)[a<](?:(?<=\ba)ttest\s*:|(?<=<)all>)"
HEADER = r"C(?<=\bC)(?:ommittee|OMMITTEE)\s+[A-Za-z]"


def _positioned(df: DataFrame) -> DataFrame:
    """A row for each block with a committee; block_pos keeps the order of the document.

    Outer, and without what is null: of an inner explode the optimizer makes a test that the array is not empty, which
    parses each document once more.
    """
    kept = [c for c in df.columns if c != "blocks"]
    return df.select(*kept, F.posexplode_outer("blocks").alias("block_pos", "_sl_b")).select(*kept, "block_pos", "_sl_b.*").where("committee <> ''")


def house_xml(docs: DataFrame) -> DataFrame:
    """Blocks of House XML: appointment paragraphs, then joint committees, then enumerated paragraphs."""
    read = xmldocs.read(docs)
    pairs = lambda b: F.flatten(F.transform(b["texts"], M.split_with_notes))
    return _positioned(read.withColumn("blocks", F.transform("blocks", lambda b: _block(T.clean_committee(b["header"]), pairs(b), b["code"]))))


def senate_xml(docs: DataFrame) -> DataFrame:
    """Rosters of Senate XML, empty ones included."""
    read = xmldocs.read(docs)
    own = F.filter("blocks", lambda b: b["kind"] == xmldocs.APPOINTMENT)
    return _positioned(read.withColumn("blocks", F.transform(own, lambda b: _block(T.clean_committee(b["header"], title=False), M.split_senate(F.get(b["texts"], F.lit(0))), b["code"]))))


def without_provisos(text: Column) -> Column:
    """``text`` without the sentences that provide how a chair's powers are exercised: they name a committee and appoint nobody."""

    def told(piece: Column) -> Column:
        known = F.lit(False)
        for words in P.PROVISOS:
            known = known | F.lower(piece).startswith(words)
        return F.when(known, F.coalesce(F.get(F.split(piece, r"\.", 2), F.lit(1)), F.lit(""))).otherwise(F.concat(F.lit(" Provided, That "), piece))

    whole = lambda pieces: F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), told), ""))
    cut = T.let(F.split(text, r"(?i)\s*:?\s*\bProvided,\s+That\s+"), whole)
    return F.when(F.contains(F.lower(text), F.lit("provided,")), cut).otherwise(text)


def _rank_sentence(text: Column) -> Column:
    """committee, name, raw of a text (without what follows its end) that is one sentence on a member's rank; null otherwise.

    The committee stands before the member ("on the Committee on X, Mr. Y shall rank after Z")
    or behind the rank ("Mr. Y shall rank after Z on the Committee on X").
    """
    on = r"(?i)\s*\bon\s+the\s+Committee\s+on\s+"

    def read(p: Column) -> Column:
        """p: whether the committee stands first, the committee, the rest."""
        at = N.rank_at(p["raw"])
        whole = (at > 1) & (p["first"] | (T.has_honorific(p["raw"]) & ~F.contains(p["committee"], F.lit("."))))
        return F.when(whole, F.struct(p["committee"].alias("committee"), T.clean_member(F.substr(p["raw"], F.lit(1), at - 1)).alias("name"), T.clean_member(p["raw"]).alias("raw")))

    def parted(parts: Column) -> Column:
        before, after = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
        behind = F.split(after, ",", 2)
        first = before == ""
        return F.struct(first.alias("first"), F.when(first, F.get(behind, F.lit(0))).otherwise(after).alias("committee"), F.trim(F.when(first, F.get(behind, F.lit(1))).otherwise(before)).alias("raw"))

    said = F.trim(F.rtrim(F.trim(F.regexp_replace(text, r"(?i)^Resolved,\s*That\s+", "")), F.lit(".")))
    return F.when(~F.contains(text, F.lit(":")), T.let(said, lambda s: T.let(F.split(s, on, 2), lambda parts: T.let(parted(parts), read))))


def house_text_blocks(body: Column) -> Column:
    """Blocks of a House text: a lone rank sentence, or joint committees, or committee blocks; the first kind found counts."""
    whole = T.let(T.flat_text(body), T.operative)
    return T.let(whole, lambda flat: T.let(without_provisos(flat), lambda op: T.let(_before(op, END), lambda text: _blocks_of(op, text))))


def _blocks_of(op: Column, text: Column) -> Column:
    """Blocks of the operative text; ``text`` is it without what follows its end. Patterns run where a word of theirs stands."""
    rank_block = lambda r: F.array(_block(T.clean_committee(F.concat(F.lit("Committee on "), r["committee"])), F.array(F.struct(r["name"].alias("clean"), r["raw"].alias("raw"))), ranked=False))

    # (a) Joint Committee on X.--The following Members are hereby elected to it: (1) A. (2) B.
    letters = F.transform(_segments(text, r"\([a-z]\)\s*(?i:Joint\s+Committee)\b"), lambda s: _parted(s, r"\.--"))
    letters = F.filter(letters, lambda p: F.contains(F.lower(F.coalesce(p["body"], F.lit(""))), F.lit("hereby elected to")) & F.contains(p["body"], F.lit(":")))
    lettered = lambda found: F.transform(found, lambda p: _block(T.clean_committee(F.regexp_replace(p["head"], r"^\([a-z]\)\s*", "")), M.split_numbered(F.get(F.split(p["body"], ":", 2), F.lit(1)))))
    # Joint Committee on X: A, B.
    joint = _told(F.transform(_segments(text, r"\b(?i:Joint\s+Committee\s+(?:on|of)\s)"), lambda s: _parted(s, ":")))
    inline = lambda found: F.transform(found, lambda p: _block(T.clean_committee(p["head"]), M.split_any(p["body"])))

    # Committee on X: A, B. The header ends at a colon, at a period, or at a period and a dash.
    headed = F.transform(_segments(text, HEADER), lambda s: _parted(s, r"\.--|[:.]"))
    name = lambda p: F.concat(F.lit("Committee on "), F.regexp_replace(p["head"], r"(?i)^committee\s+(?:on\s+)?", ""))
    # Another clause or sentence ends the members; the number of the next header is none of them.
    ended = lambda b: F.when(F.contains(b, F.lit("Resolved,")) | F.contains(b, F.lit("lieu")), _before(b, r"Resolved,\s*That\b|In\s+lieu\s+of\b")).otherwise(b)
    listed = lambda p: T.let(F.trim(F.regexp_replace(ended(p["body"]), r"\(\d+\)\s*$", "")), N.without_group_note)
    usual = F.transform(_told(headed), lambda p: _block(T.clean_committee(name(p)), T.let(listed(p), M.split_any)))
    jointly = lambda found: F.when(F.contains(F.lower(text), F.lit("joint")), found).otherwise(F.array().cast("array<struct<head:string,body:string>>"))
    elects = F.contains(F.lower(op), F.lit("elected to the following"))
    return T.let(
        F.struct(_rank_sentence(text).alias("rank"), jointly(letters).alias("letters"), jointly(joint).alias("joint")),
        lambda r: F.when(r["rank"].isNotNull(), rank_block(r["rank"])).when(F.size(r["letters"]) > 0, lettered(r["letters"])).when(F.size(r["joint"]) > 0, inline(r["joint"])).when(elects, usual).otherwise(F.array().cast(BLOCK)),
    )


def house_text(docs: DataFrame) -> DataFrame:
    """Blocks of House text documents, with doc_date from the dateline."""
    read = docs.withColumn("blocks", house_text_blocks(F.col("body"))).withColumn("doc_date", T.text_date(T.flat_text(F.col("body"))))
    return _positioned(read.drop("body"))


def senate_text(docs: DataFrame) -> DataFrame:
    """Rosters of Senate text documents; ``single`` marks one added senator instead of a roster, ``until_date`` how long."""
    op = T.operative(T.flat_text(F.col("body"), rejoin=False))
    # "... the following Senator shall be added to the ... membership on the Committee on X for the ...: A."
    added = F.split(op, r"(?i)\bthe\s+following\s+Senator\s+shall\s+be\s+added\s+to\s+the\s+", 2)
    told = _parted(F.get(added, F.lit(1)), ":")
    single = F.coalesce(told["body"], F.lit("")) != ""
    committee = _before(F.get(F.split(told["head"], r"(?i)\bmembership\s+on\s+the\s+(?:Senate\s+)?", 2), F.lit(1)), r"(?i)\s+for\s+the\s")
    raw = T.clean_member(_before(told["body"], END))
    name = T.clean_member(N.without_senate_roles(raw))
    until = F.nullif(F.regexp_extract(told["head"], r"(?i)\buntil\s+([a-z]+\s+\d{1,2},?\s*\d{4})", 1), F.lit(""))
    one = F.array(_block(T.clean_committee(committee, title=False), F.array(F.struct(name.alias("clean"), F.when(raw != name, raw).alias("raw"))), ranked=False))
    headed = _told(F.transform(_segments(_before(op, END), r"\b(?i:Committee\s+on\s+[a-z])"), lambda s: _parted(s, ":")))
    rosters = F.transform(headed, lambda p: _block(T.clean_committee(p["head"], title=False), M.split_senate(p["body"])))
    found = F.when(single & committee.isNotNull(), one).when(~single, rosters).otherwise(F.array().cast(BLOCK))
    return _positioned(docs.withColumn("blocks", found).withColumn("single", single).withColumn("until_date", F.when(single, until)).drop("body"))
