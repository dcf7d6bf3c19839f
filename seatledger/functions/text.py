"""Text and date functions as columns; all stay in the JVM but :func:`unescape`."""

from __future__ import annotations

import html as _html
import json
import unicodedata
from collections.abc import Callable
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import patterns as P


def _map(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it; plans stay small."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def clean(x: Column) -> Column:
    """White space of any kind folded to one space, none at the ends; null gives ''."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)\s+", " "))


def clean_member(x: Column) -> Column:
    return F.rtrim(clean(x), F.lit(".,;"))


def titlecase(x: Column) -> Column:
    """Capital after every non-letter, the small words on, of, and, the lowered, the first letter a capital."""
    t = F.array_join(F.transform(F.split(clean(x), r"(?<=[^\p{L}])"), F.initcap), "")
    # A pattern runs where its letters stand at all.
    lowered = lambda w: lambda v: F.when(F.contains(v, F.lit(w)), F.regexp_replace(v, rf"(?U)\b{w}\b", w.lower())).otherwise(v)
    for small in ("On", "Of", "And", "The"):
        t = let(t, lowered(small))
    return let(t, lambda v: F.concat(F.upper(F.substring(v, 1, 1)), F.substr(v, F.lit(2))))


def clean_committee(x: Column, title: bool = True) -> Column:
    """A committee header without its closing marks; in title case for the House."""
    c = F.trim(F.rtrim(clean(x), F.lit(":.—–")))
    return titlecase(c) if title else c


def normalise_committee(x: Column) -> Column:
    """The words that tell committees apart, in lower case."""
    n = F.regexp_replace(F.lower(x), r"\bcommittee\b|\bhouse\b|\bon\b|\bthe\b|\bof\b", " ")
    return clean(F.regexp_replace(n, r"[^a-z0-9 ]", " "))


@cache
def _marks() -> tuple[str, str, dict[str, str]]:
    """From Unicode's compatibility decomposition, by rule: characters that become one character, those that go, and those that become several.

    Syllables of Hangul, which come apart by arithmetic and into letters of their own, stay whole.
    """
    one, gone, several = {}, [], {}
    for code in range(0x80, 0x30000):
        c = chr(code)
        if 0xAC00 <= code < 0xD7A4 or 0xD800 <= code < 0xE000:
            continue
        bare = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if not bare:
            gone.append(c)
        elif len(bare) > 1:
            several[c] = bare
        elif bare != c:
            one[c] = bare
    return "".join(one) + "".join(gone), "".join(one.values()), several


def strip_marks(x: Column) -> Column:
    """Compatibility decomposition without combining marks, as look-ups in the JVM."""
    source, target, several = _marks()
    expanded = F.from_json(F.lit(json.dumps(several)), "map<string,string>")  # one literal, however many entries
    rare = F.array_join(F.transform(F.split(x, ""), lambda c: F.coalesce(F.try_element_at(expanded, c), c)), "")
    # Removing them tells whether there are any: a class of thousands of characters would be tried one by one.
    whole = F.when(F.translate(x, "".join(several), "") != x, rare).otherwise(x)
    return F.when(x.rlike(r"[^\x00-\x7F]"), F.translate(whole, source, target)).otherwise(x)


@F.pandas_udf(StringType())
def unescape(x: pd.Series) -> pd.Series:
    """Character references decoded."""
    return x.map(lambda t: None if t is None else _html.unescape(t) if "&" in t else t)


def fold(x: Column, punctuation: bool = True) -> Column:
    """Lower case without accents; with ``punctuation`` one kind of apostrophe and spaces for hyphens."""
    f = F.lower(strip_marks(F.coalesce(x, F.lit(""))))
    return F.replace(F.translate(f, P.APOSTROPHES, "'" * len(P.APOSTROPHES)), F.lit("-"), F.lit(" ")) if punctuation else f


def strip_tags(x: Column, decoded: Callable[[Column], Column] = unescape) -> Column:
    return decoded(F.regexp_replace(F.coalesce(x, F.lit("")), r"<[^>]+>", ""))


def pre_text(body: Column, decoded: Callable[[Column], Column] = unescape) -> Column:
    """Text of the first ``pre`` element, or of the whole page; ``decoded`` does its references."""
    inner = F.regexp_extract(body, r"(?is)<pre[^>]*>(.*?)</pre>", 1)
    return strip_tags(F.when(body.rlike(r"(?is)<pre[^>]*>.*?</pre>"), inner).otherwise(body), decoded)


def flat_text(body: Column, rejoin: bool = True) -> Column:
    """A text document on one line: tags and references gone, words broken at a hyphen joined."""
    t = strip_tags(body)
    return clean(F.regexp_replace(t, r"-\s*\n\s*", "-") if rejoin else t)


def operative(flat: Column) -> Column:
    """From the resolving clause on, or all of it."""
    at = F.instr(flat, "Resolved,")
    return F.substr(flat, F.greatest(at, F.lit(1)))


def month_number(name: Column) -> Column:
    return F.array_position(F.array(*[F.lit(m) for m in P.MONTHS]), F.lower(name)).cast("int")


def iso_date(year: Column, month: Column, day: Column) -> Column:
    """yyyy-mm-dd, or null where the month is none."""
    return F.when(F.coalesce(month, F.lit(0)) > 0, F.format_string("%s-%02d-%02d", year, month, day.cast("int")))


def extracted(x: Column, pattern: str, group: int) -> Column:
    """A group of the first match, null where nothing matches."""
    return F.when(x.rlike(pattern), F.regexp_extract(x, pattern, group))


def written_date(x: Column, pattern: str) -> Column:
    """The date in the groups month, day, year of ``pattern``."""
    g = [F.regexp_extract(x, pattern, i) for i in (1, 2, 3)]
    return F.when(x.rlike(pattern), iso_date(g[2], month_number(g[0]), g[1]))


def text_date(flat: Column) -> Column:
    """The date that follows the first naming of the House, with nothing but marks and "U.S." between."""
    tail = F.get(F.split(flat, r"(?i)\bHouse\s+of\s+Representatives\b(?=[\s,.US]*[A-Z][a-z]+\s+\d)", 2), F.lit(1))
    begun = F.regexp_replace(tail, r"^[\s,.]*(?:U\.?\s*S\.?[\s,.]*)?", "")
    return let(begun, lambda x: written_date(x, r"^([A-Za-z]+)\s+(\d{1,2}),\s*(\d{4})"))


def compact_date(x: Column) -> Column:
    """yyyymmdd as yyyy-mm-dd; anything else null."""
    return F.when(x.rlike(r"^\d{8}$"), F.concat_ws("-", F.substring(x, 1, 4), F.substring(x, 5, 2), F.substring(x, 7, 2)))


def issue_date(package_id: Column) -> Column:
    return F.nullif(F.concat_ws("-", *[F.nullif(F.regexp_extract(F.coalesce(package_id, F.lit("")), r"CREC-(\d{4})-(\d{2})-(\d{2})", i), F.lit("")) for i in (1, 2, 3)]), F.lit(""))


def congress_start(congress: Column) -> Column:
    """First year of a Congress; the first one began in 1789."""
    return (F.lit(1789) + (congress.cast("int") - 1) * 2).cast("int")


def congress_span(congress: Column) -> tuple[Column, Column]:
    y = congress_start(congress)
    return F.format_string("%d-01-03", y), F.format_string("%d-01-03", y + 2)


def in_organizing_window(congress: Column, date: Column) -> Column:
    y = congress_start(congress)
    return F.coalesce(date.between(F.format_string("%d-01-03", y), F.format_string("%d-01-31", y)), F.lit(False))


def date_fraction(congress: Column, date: Column) -> Column:
    """How far into its Congress a date lies, from 0 to 1."""
    lo, hi = (F.to_date(x) for x in congress_span(congress))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.datediff(F.to_date(date), lo) / F.datediff(hi, lo)))


def ordinal(n: Column) -> Column:
    last, teen = n % 10, (n % 100).between(11, 13)
    suffix = F.when(teen, "th").when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), suffix)


def human_size(n: Column) -> Column:
    """Bytes as B, KB, MB or GB with one decimal from KB on."""
    kb, mb, gb = n / 1024.0, n / 1024.0**2, n / 1024.0**3
    return F.when(n < 1024, F.format_string("%d B", n.cast("long"))).when(kb < 1024, F.format_string("%.1f KB", kb)).when(mb < 1024, F.format_string("%.1f MB", mb)).otherwise(F.format_string("%.1f GB", gb))


def state_code(value: Column) -> Column:
    """USPS code of a state name or code; a name within two edits of exactly one state counts as it."""
    v = F.trim(value)
    low = F.lower(v)
    states, codes = _map(P.STATES), F.array(*[F.lit(c) for c in sorted(set(P.STATES.values()))])
    listed = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(c).alias("c")) for n, c in P.STATES.items()])
    near = F.transform(listed, lambda s: F.struct(F.levenshtein(low, s["n"]).alias("d"), s["c"].alias("c")))
    least = F.array_min(F.transform(near, lambda s: s["d"]))
    best = F.filter(near, lambda s: (s["d"] == least) & (s["d"] <= 2))
    fuzzy = F.when(F.size(best) == 1, F.get(best, F.lit(0))["c"])
    return F.when(F.coalesce(value, F.lit("")) == "", F.lit(None).cast("string")).when((F.length(v) == 2) & F.array_contains(codes, F.upper(v)), F.upper(v)).otherwise(
        F.coalesce(F.try_element_at(states, low), F.when(low.startswith("the "), F.try_element_at(states, F.substr(low, F.lit(5)))), fuzzy)
    )


def _honorific(printed: Column) -> Column:
    """The word before the first period if it is an honorific, in lower case; null otherwise."""
    head = F.lower(F.trim(F.substring_index(printed, ".", 1)))
    return F.when(F.contains(printed, F.lit(".")) & head.isin(*P.GENDERS), head)


def has_honorific(printed: Column) -> Column:
    return _honorific(printed).isNotNull()


def without_honorific(printed: Column) -> Column:
    rest = lambda name: F.when(_honorific(name).isNotNull(), F.substr(name, F.length(F.substring_index(name, ".", 1)) + 2)).otherwise(name)
    return F.trim(let(F.coalesce(printed, F.lit("")), rest))


def honorific_gender(printed: Column) -> Column:
    return F.try_element_at(_map(P.GENDERS), _honorific(F.coalesce(printed, F.lit(""))))


def without_generation(name: Column) -> Column:
    """Without Jr, Sr or a numeral as the last word."""

    def kept(words: Column) -> Column:
        known = F.lower(F.rtrim(F.element_at(words, -1), F.lit("."))).isin([g.lower() for g in P.GENERATIONS])
        return F.when((F.size(words) > 1) & known, F.regexp_replace(F.array_join(F.slice(words, F.lit(1), F.size(words) - 1), " "), ",$", "")).otherwise(F.array_join(words, " "))

    return let(F.split(F.rtrim(name), r"\s+"), kept)


def _state_parts(name: Column) -> Column:
    """name, code, state: the code in parentheses at the end, or what stands behind "of" (printed "or" at times) and is nothing but a name."""
    inside = F.trim(F.rtrim(F.substring_index(name, "(", -1), F.lit(")")))
    coded = F.endswith(name, F.lit(")")) & F.contains(name, F.lit("(")) & inside.rlike("^[A-Z]{2}$")

    def of(words: Column) -> Column:
        rest = lambda i: F.array_join(F.slice(words, i + 2, F.size(words)), " ")
        at = F.array_min(F.filter(F.transform(words, lambda w, i: F.when((i > 0) & F.lower(w).isin("of", "or") & rest(i).rlike("^[A-Za-z .]+$"), i)), lambda i: i.isNotNull()))
        parted = lambda i: F.struct(F.when(i.isNotNull(), F.array_join(F.slice(words, F.lit(1), F.coalesce(i, F.lit(0))), " ")).alias("name"), F.when(i.isNotNull(), rest(i)).alias("state"))
        return let(at, parted)

    bracketed = F.struct(F.trim(F.substr(name, F.lit(1), F.length(name) - F.length(F.substring_index(name, "(", -1)) - 1)).alias("name"), inside.alias("code"), F.lit(None).cast("string").alias("state"))
    plain = let(let(F.split(name, r"\s+"), of), lambda o: F.struct(F.trim(F.coalesce(o["name"], name)).alias("name"), F.lit(None).cast("string").alias("code"), o["state"].alias("state")))
    return F.when(coded, bracketed).otherwise(plain)


def bare_name(printed: Column) -> Column:
    """Without honorific and state."""
    return let(without_honorific(printed), _state_parts)["name"]


def printed_state(printed: Column) -> Column:
    return let(let(without_honorific(printed), _state_parts), lambda p: F.coalesce(p["code"], state_code(p["state"])))


def surname_and_state(printed: Column) -> Column:
    """Last word of the bare name in lower case, and the state."""
    words = F.split(bare_name(printed), r"\s+")
    return F.struct(F.rtrim(F.lower(F.element_at(words, -1)), F.lit(".,")).alias("surname"), printed_state(printed).alias("state"))


def first_names_match(a: Column, b: Column) -> Column:
    """Equal, one begins the other, or a known short form; both folded."""
    nick = _map(P.NICKNAMES)
    return (a == b) | a.startswith(b) | b.startswith(a) | F.coalesce(F.try_element_at(nick, a) == b, F.lit(False)) | F.coalesce(F.try_element_at(nick, b) == a, F.lit(False))


def signer_name(full: Column) -> Column:
    """A signer's name before the first comma, without title, district, and closing titles of honour."""

    def untitled(words: Column) -> Column:
        titled = (F.size(words) > 1) & F.lower(F.rtrim(F.get(words, F.lit(0)), F.lit("."))).isin(*P.SIGNER_TITLES)
        return F.slice(words, F.when(titled, 2).otherwise(1), F.size(words))

    def unseated(words: Column) -> Column:
        """A district, as in (OH-3), ends a name."""
        seat = F.split(F.translate(F.element_at(words, -1), "()", ""), "-")
        district = F.element_at(words, -1).rlike(r"^\(.*\)$") & (F.size(seat) == 2) & F.get(seat, F.lit(0)).rlike("^[A-Z]{2}$") & F.get(seat, F.lit(1)).rlike(r"^\d+$")
        return F.slice(words, F.lit(1), F.size(words) - F.when((F.size(words) > 1) & district, 1).otherwise(0))

    def ended(words: Column) -> Column:
        """The last word that is no suffix, or else the first word, ends the name."""
        known = F.array(*[F.lit(s) for s in P.SIGNER_SUFFIXES])
        ends = F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: ~F.array_contains(known, F.lower(F.replace(F.element_at(words, i), F.lit("."), F.lit("")))))
        return F.array_join(F.slice(words, 1, F.greatest(F.lit(1), F.coalesce(F.array_max(ends), F.lit(1)))), " ")

    base = F.split(F.trim(F.get(F.split(clean(full), ","), F.lit(0))), " ")
    return let(let(let(base, untitled), unseated), ended)


def guess_surname(name: Column) -> Column:
    """For a search box: the last word without honorific, generational suffix and state; '' where none is left."""

    def before_state(tokens: Column) -> Column:
        of = F.array_min(F.filter(F.transform(tokens, lambda w, i: F.when((i > 0) & (i < F.size(tokens) - 1) & F.lower(w).isin("of", "or"), i)), lambda i: i.isNotNull()))
        return F.array_join(F.slice(tokens, F.lit(1), F.coalesce(of, F.size(tokens))), " ")

    n = let(F.split(without_generation(without_honorific(name)), r"\s+"), before_state)
    words = F.filter(F.split(clean(F.replace(n, F.lit(","), F.lit(" "))), " "), lambda w: w != "")
    return let(words, lambda w: F.coalesce(F.try_element_at(w, F.lit(-1)), F.lit("")))
