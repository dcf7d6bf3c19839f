"""Member lists: from printed text to (clean, raw) pairs with ranks. All inside the row."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import notes as N
from ..functions import patterns as P
from ..functions.text import clean, clean_member, let

COMMA_STATE = r"(?i),\s*(?:" + "|".join(re.escape(s) for s in sorted(P.STATES, key=lambda s: (-len(s), s))) + r")\s*(?:[;.(]|$)"

#: A word (of letters, digits, underscores, periods) that begins with an honorific, in lower case.
HONORIFIC = r"(?:{0})\.(?<![\p{{L}}\p{{N}}_.](?:{0})\.)".format("|".join(P.GENDERS))


def _fragments(text: Column, pattern: str) -> Column:
    return F.filter(F.transform(F.split(clean(text), pattern), F.trim), lambda f: f != "")


def _member_fragments(text: Column) -> Column:
    """Text between breaks that stand outside parentheses: those with no parenthesis after them that closes first.

    Cut behind each parenthesis, so that no break looks ahead to the end of a long text. Clean text has no line feed.
    """
    def broken(piece: Column) -> Column:
        # A comma, a semicolon, or an "and" between spaces.
        return F.regexp_replace(piece, f"[,; ](?:(?<! )|(?:{'|'.join(P.ANDS)}) )", "\n")

    pieces = F.split(clean(text), r"(?<=[()])")
    marked = F.transform(pieces, lambda p: F.when(p.endswith(")"), p).otherwise(broken(p)))
    return F.filter(F.transform(F.split(F.array_join(marked, ""), "\n"), lambda f: F.trim(f)), lambda f: f != "")


def _bare(x: Column) -> Column:
    """Without an "and" that begins it."""
    bare = lambda first: F.trim(F.when(F.contains(x, F.lit(" ")) & first.isin(*P.ANDS), F.substr(x, F.length(first) + 2)).otherwise(x))
    return let(F.lower(F.substring_index(x, " ", 1)), bare)


def _pair(name: Column, raw: Column) -> Column:
    return F.struct(name.alias("clean"), F.when(raw != name, raw).alias("raw"))


def _named(pairs: Column) -> Column:
    return F.filter(pairs, lambda p: p["clean"] != "")


def split_plain(text: Column) -> Column:
    """Names between commas."""
    return F.filter(F.transform(F.split(clean(text), ","), lambda p: clean_member(_bare(F.trim(p)))), lambda m: m != "")


def split_with_notes(text: Column) -> Column:
    """Names with honorifics; a fragment that is only a note goes back to the name before it."""

    def merged(frags: Column) -> Column:
        # Where names begin: the first fragment, and each that is no note. Slices between them copy a fragment once.
        starts = F.filter(F.transform(frags, lambda f, i: F.when((i == 0) | ~let(_bare(f), N.continues), i)), lambda i: i.isNotNull())
        return let(starts, lambda s: F.transform(s, lambda i, k: F.array_join(F.slice(frags, i + 1, F.coalesce(F.get(s, k + 1), F.size(frags)) - i), ", ")))

    def noted(r: Column) -> Column:
        return let(clean_member(N.without_notes(r)), lambda name: _pair(name, F.rtrim(r, F.lit(".,;"))))

    def pair(raw: Column) -> Column:
        # Pieces of clean text are clean; most hold no word of a note.
        return let(_bare(raw), lambda r: F.when(N.may_hold_note(r), noted(r)).otherwise(_pair(F.rtrim(r, F.lit(".,;")), F.lit(None).cast("string"))))

    return _named(F.transform(let(_member_fragments(text), merged), pair))


def split_name_state(text: Column) -> Column:
    """'Full Name, State;' lists: the last part is the state, a closing parenthesis or role a note."""

    def told(f: Column) -> Column:
        def named(name: Column, bare: Column) -> Column:
            parts = F.transform(F.split(name, ","), F.trim)
            person = lambda p: F.when(F.size(p) >= 2, clean_member(F.concat(F.array_join(F.slice(p, 1, F.size(p) - 1), ", "), F.lit(" of "), F.element_at(p, -1)))).otherwise("")
            noted = f.rlike(P.NAME_STATE_NOTE) | (name != F.trim(bare))
            return F.struct(let(parts, person).alias("clean"), F.when(noted, clean_member(f)).alias("raw"))

        return let(F.rtrim(F.regexp_replace(f, P.NAME_STATE_NOTE, "")), lambda bare: let(F.trim(N.without_notes(bare)), lambda name: named(name, bare)))

    def pair(f: Column) -> Column:
        return let(F.trim(F.rtrim(F.regexp_replace(_bare(f), r"^\*+\s*", ""), F.lit("."))), told)

    return _named(F.transform(_fragments(text, r";\s*"), pair))


def split_numbered(text: Column) -> Column:
    """'(1) A. (2) B.' lists."""
    items = F.transform(F.split(F.coalesce(text, F.lit("")), r"\(\d+\)\s*"), clean_member)
    return F.transform(F.filter(items, lambda m: m != ""), lambda m: F.struct(m.alias("clean"), F.lit(None).cast("string").alias("raw")))


def split_senate(text: Column) -> Column:
    """Senate rosters: roles in parentheses are notes, blank seats are none."""

    def pair(raw: Column) -> Column:
        raw = clean_member(_bare(raw))
        return _pair(F.when(raw.rlike("^_+$"), "").otherwise(clean_member(N.without_senate_roles(raw))), raw)

    return _named(F.transform(_member_fragments(text), pair))


def is_name_state(text: Column) -> Column:
    """A comma before a state anywhere, or no honorific at all."""
    return text.rlike(COMMA_STATE) | ~F.lower(text).rlike(HONORIFIC)


def split_any(text: Column) -> Column:
    return F.when(is_name_state(text), split_name_state(text)).otherwise(split_with_notes(text))


def rank_offset(pairs: Column, in_window: Column) -> Column:
    """Rank of the first member: 1 if it is a named chair, else 2 where there are several; null outside the window."""
    chair = F.coalesce(N.names_a_chair(F.get(pairs, F.lit(0))["raw"]), F.lit(False))
    return F.when(in_window & chair, F.lit(1)).when(in_window & (F.size(pairs) > 1), F.lit(2))


def member_rows(blocks: DataFrame, pairs: str = "pairs", in_window: Column | None = None) -> DataFrame:
    """A row for each member: member_pos, member_name, member_name_raw, party_rank."""
    offset = rank_offset(F.col(pairs), F.lit(False) if in_window is None else in_window)
    keep = [c for c in blocks.columns if c != pairs]
    return blocks.withColumn("_sl_offset", offset).select(*keep, "_sl_offset", F.posexplode(pairs).alias("member_pos", "_sl_pair")).select(
        *keep, "member_pos", F.col("_sl_pair.clean").alias("member_name"), F.col("_sl_pair.raw").alias("member_name_raw"), (F.col("member_pos") + F.col("_sl_offset")).alias("party_rank")
    )
