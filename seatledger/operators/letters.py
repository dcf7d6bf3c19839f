"""Letters of resignation: committees from the title, signer and date from the text. All inside the row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import text as T

LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\u0085  ]"


def committees(title: Column) -> Column:
    """Committees named after 'resignation as member of'; empty where the title has none.

    One begins behind a comma or an AND with the word COMMITTEE or HOUSE, or with what a committee can be before it.
    """
    def behind_opening(whole: Column) -> Column:
        at = F.locate(P.LETTER_OPENING, F.upper(whole))
        return F.trim(F.when(at > 0, F.substr(whole, at + len(P.LETTER_OPENING))).otherwise(""))

    def cut(words: Column) -> Column:
        def starts(w: Column, i: Column) -> Column:
            behind = F.coalesce((F.get(words, i - 1) == "AND") | F.endswith(F.get(words, i - 1), F.lit(",")), F.lit(False))
            from_here = F.slice(words, i + F.when(w == "THE", 2).otherwise(1), len(P.COMMITTEE_KINDS) + 1)
            noun = F.get(F.filter(from_here, lambda x: ~x.isin(*P.COMMITTEE_KINDS)), F.lit(0))
            return (i == 0) | (behind & F.coalesce(F.regexp_replace(noun, r"\W.*$", "").isin(*P.COMMITTEE_WORDS), F.lit(False)))

        def piece(i: Column, end: Column) -> Column:
            own = F.slice(words, i + 1, end - i)
            own = F.when((i > 0) & (F.get(own, F.lit(0)) == "THE"), F.slice(own, 2, F.size(own))).otherwise(own)
            last = F.element_at(own, -1)
            return F.rtrim(F.array_join(F.when((end < F.size(words)) & (last == "AND"), F.slice(own, 1, F.size(own) - 1)).otherwise(own), " "), F.lit(", "))

        found = F.filter(F.transform(words, lambda w, i: F.when(starts(w, i), i)), lambda i: i.isNotNull())
        return T.let(found, lambda f: F.transform(f, lambda i, k: piece(i, F.coalesce(F.get(f, k + 1), F.size(words)))))

    named = lambda tail: F.when(tail == "", F.array().cast("array<string>")).otherwise(F.transform(F.filter(T.let(F.split(tail, " "), cut), lambda p: p != ""), T.titlecase))
    return T.let(T.let(T.clean(title), behind_opening), named)


def signed_date(text: Column) -> Column:
    """The first date behind the dateline's place; months are written with a capital here and nowhere otherwise."""
    months = F.array(*[F.lit(m.capitalize()) for m in P.MONTHS])

    def read(words: Column) -> Column:
        month, day, year = (F.coalesce(F.get(words, F.lit(k)), F.lit("")) for k in range(3))
        dated = month.rlike("^[A-Z][a-z]+$") & day.rlike(r"^\d\d?,$") & year.rlike(r"^\d{4}")
        return F.when(dated, F.struct(T.iso_date(F.substring(year, 1, 4), F.array_position(months, month).cast("int"), F.rtrim(day, F.lit(","))).alias("d")))

    def first(pieces: Column) -> Column:
        dates = F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1))), lambda piece: T.let(F.split(F.trim(piece), " ", 4), read))
        return F.get(F.filter(dates, lambda d: d.isNotNull()), F.lit(0))["d"]

    return T.let(F.split(T.clean(text), P.DATELINE), first)


def _closes(said: Column) -> Column:
    """Whether clean text in lower case holds words of the closing sentence."""
    found = F.lit(False)
    for words in P.LETTER_CLOSINGS:
        found = found | F.contains(said, F.lit(words))
    return found


def _last(lines: Column, test) -> Column:
    """Index of the last line that passes, or null."""
    return F.array_max(F.filter(F.transform(lines, lambda x, i: F.when(test(x, i), i)), lambda i: i.isNotNull()))


_KNOWN = (*P.OFFICES, *P.LEADERS, *(r.lower() for r in P.CHAIRS + P.RANKING_MEMBERS))


def tells_office(line: Column) -> Column:
    """A line that begins with an office, a role or a district, and not with a name."""
    spelt = F.regexp_replace(line, r"(?i)^U\.?\s?S\.?\s+", "United States ")
    office = F.lower(F.trim(F.regexp_replace(F.get(F.split(spelt, "[.,]"), F.lit(0)), r"\s+", " "))).isin(list(_KNOWN))
    # Patterns run where the first letters are those of an office, or the word District stands.
    district = line.rlike(r"(?i)^[a-z][a-z-]*\s+District,\s+[a-z ]+(?:[.,]|\s*$)")
    begins = lambda low: F.substring(low, 1, 1).isin("u") | F.substring(low, 1, 2).isin(sorted({k[:2] for k in _KNOWN}))
    return T.let(F.lower(line), lambda low: (begins(low) & office) | (F.contains(low, F.lit("district,")) & district))


def signer(text: Column) -> Column:
    """The line above the last role line before the closing sentence, or above that sentence, or the last line."""

    def lines_of(t: Column) -> Column:
        anyhow = F.transform(F.split(t, LINE_BREAK), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
        stripped = F.when(t.rlike(r"[^\n -~]"), anyhow).otherwise(F.transform(F.split(t, "\n"), lambda x: F.trim(x)))
        return F.filter(stripped, lambda x: (x != "") & ~(x.startswith("_") & x.rlike("^_+$")))

    def upto_note(lines: Column) -> Column:
        noted = lambda x: F.contains(x, F.lit("=")) & F.contains(F.regexp_replace(F.lower(x), r"\s", ""), F.lit(P.NOTE_MARKER))
        at = F.array_min(F.filter(F.transform(lines, lambda x, i: F.when(noted(x), i)), lambda i: i.isNotNull()))
        return T.let(at, lambda n: F.when(n.isNull(), lines).otherwise(F.slice(lines, F.lit(1), F.greatest(n, F.lit(0)))))

    def closing(lines: Column) -> Column:
        # Where a closing sentence begins; it may break between two lines.
        def begins(x: Column) -> Column:
            found = F.lit(False)
            for words in P.LETTER_CLOSINGS:
                found = found | F.contains(x, F.lit(words.split()[0]))
            return found

        def test(x: Column, i: Column) -> Column:
            return begins(F.lower(x)) & T.let(F.lower(T.clean(F.concat_ws(" ", x, F.get(lines, i + 1)))), _closes)

        return _last(lines, test)

    def above(lines: Column, end: Column) -> Column:
        role = F.array_max(F.filter(F.transform(lines, lambda x, i: F.when((i < end) & tells_office(x), i)), lambda i: i.isNotNull()))
        return F.coalesce(role, end) - 1

    def name(lines: Column) -> Column:
        signed = lambda at: F.when((F.size(lines) > 0) & (at >= 0), F.regexp_replace(T.clean(F.get(lines, at)), r"[.,;]$", ""))
        return T.let(F.coalesce(closing(lines), F.size(lines)), lambda end: T.let(above(lines, end), signed))

    return T.let(F.coalesce(text, F.lit("")), lambda t: T.let(lines_of(t), lambda a: T.let(upto_note(a), name)))


def parse(title: Column, text: Column) -> Column:
    return F.struct(committees(title).alias("committees"), signer(text).alias("member_name"), signed_date(text).alias("signed_date"))
