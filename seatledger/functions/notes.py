"""Notes that stand with a name: rank, role, not yet sworn. Told by their first words, which come from the word lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P
from .text import let


def any_of(phrases: tuple[str, ...]) -> str:
    """A pattern for one of ``phrases``, longest first, whatever the space between their words."""
    return "(?:" + "|".join(r"\s+".join(p.split()) for p in sorted(set(phrases), key=lambda p: (-len(p), p))) + ")"


#: The first words of a rank note, such as "shall rank immediately after".
RANK_OPENING = any_of(tuple(f"{verb} {how}{place}" for verb in P.RANK_VERBS for how in ("", "immediately ") for place in P.RANK_PLACES) + ("after", "ahead of"))
ROLE = any_of(P.CHAIRS + P.RANKING_MEMBERS)
#: The first words of a note on several members, such as "both of whom will rank in order following".
GROUP_OPENING = any_of(tuple(
    f"{who}{whom} {verb} rank in {order}order {place}" for who in ("both", "all") for whom in ("", " of whom") for verb in ("to", "will", "shall") for order in ("", "the ", "the named ", "named ") for place in P.RANK_PLACES
))

#: In lower case, words of which every note on a name holds one: a cheap test before any pattern.
CUES = ("rank", "chair", "after", "ahead")


def may_hold_note(x: Column) -> Column:
    """Whether ``x`` holds a bracket or a word of a note; where not, no pattern of this module changes it."""

    def cued(lowered: Column) -> Column:
        found = F.contains(lowered, F.lit("("))
        for cue in CUES:
            found = found | F.contains(lowered, F.lit(cue))
        return found

    return let(F.lower(x), cued)


def is_note(x: Column) -> Column:
    """Nothing but a note."""
    return F.rtrim(x, F.lit(". ")).rlike(rf"(?i)^(?:{RANK_OPENING}\s.+|{ROLE})$")


def continues(x: Column) -> Column:
    """A piece that belongs to the name before it: a note, or the generation that a comma cut off."""
    return (may_hold_note(x) & is_note(x)) | x.rlike(rf"(?i)^{any_of(P.GENERATIONS)}\.?\s+of\s+.")


def names_a_chair(x: Column) -> Column:
    return x.rlike(rf"(?i)\b{any_of(P.CHAIRS)}\b")


def rank_at(x: Column) -> Column:
    """Where the first rank note begins, from 1; 0 where there is none."""
    return F.regexp_instr(x, F.lit(rf"(?i)\b{RANK_OPENING}\s"))


def without_brackets(x: Column, drops) -> Column:
    """``x`` without the parentheses whose inside ``drops``."""
    found = F.filter(F.regexp_extract_all(x, F.lit(r"\([^()]*\)"), F.lit(0)), lambda p: drops(F.trim(F.substring(p, 2, F.length(p) - 2))))
    return F.when(F.contains(x, F.lit("(")), F.aggregate(found, x, lambda text, p: F.replace(F.replace(text, F.concat(F.lit(" "), p), F.lit("")), p, F.lit("")))).otherwise(x)


def without_notes(x: Column) -> Column:
    """The name alone: bracketed notes go, and what follows the first words of a note at its end."""
    bare = without_brackets(x, lambda inside: is_note(inside) | (F.lower(inside) == P.NOT_YET))
    return F.regexp_replace(bare, rf"(?i)(?:^|[,\s]+)(?:{RANK_OPENING}\s.+|{ROLE}[.\s]*)$", "")


def without_senate_roles(x: Column) -> Column:
    roles = [r.lower() for r in P.SENATE_ROLES]
    return without_brackets(x, lambda inside: F.lower(F.regexp_replace(inside, r"\s+", " ")).isin(roles))


def without_group_note(x: Column) -> Column:
    """A list of members without the note on their common rank."""
    return F.when(F.contains(F.lower(x), F.lit("rank")), F.regexp_replace(x, rf"(?i)[,;\s]*\b{GROUP_OPENING}\s.*$", "")).otherwise(x)
