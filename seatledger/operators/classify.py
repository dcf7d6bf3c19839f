"""Titles: which documents change memberships, and how."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.text import let


def _words(title: Column) -> Column:
    return F.split(F.lower(F.coalesce(title, F.lit(""))), r"[^\p{L}\p{N}_]+")


def _places(words: Column, test) -> Column:
    """Indexes of the words that pass ``test`` (word, index)."""
    return F.filter(F.transform(words, lambda w, i: F.when(test(w, i), i)), lambda i: i.isNotNull())


def _begins(*stems: str):
    def test(w: Column, i: Column) -> Column:
        found = F.lit(False)
        for stem in stems:
            found = found | F.startswith(w, F.lit(stem))
        return found

    return test


def _phrase(words: Column, *sets: tuple[str, ...]):
    """Words in a row, each out of its set."""

    def test(w: Column, i: Column) -> Column:
        found = w.isin(*sets[0])
        for k, members in enumerate(sets[1:], 1):
            found = found & F.coalesce(F.get(words, i + k).isin(*members), F.lit(False))
        return found

    return test


def _before_committee(words: Column, test) -> Column:
    """A word that passes, and a word on committees behind it."""
    return F.coalesce(F.array_min(_places(words, test)) < F.array_max(_places(words, _begins("committee"))), F.lit(False))


def house_change(title: Column) -> Column:
    """'removal', 'addition' or null; removals are tested first."""

    def told(words: Column) -> Column:
        between = _places(words, lambda w, i: (w == "membership") & (i > F.coalesce(F.array_min(_places(words, _begins("designat"))), F.size(words))))
        designates = F.coalesce(F.array_min(between) < F.array_max(_places(words, _begins("committee"))), F.lit(False))
        elects = _before_committee(words, lambda w, i: (w == "electing") | _phrase(words, ("election",), ("of",))(w, i))
        return F.when(_before_committee(words, _begins(*P.REMOVAL_STEMS)), "removal").when(elects | designates, "addition")

    return let(_words(title), told)


def senate_party(title: Column) -> Column:
    """'minority', 'majority' or null."""
    side = lambda words, name: F.size(_places(words, _phrase(words, (name,), ("party",)))) > 0
    return let(_words(title), lambda words: F.when(side(words, "minority"), "minority").when(side(words, "majority"), "majority"))


def is_resignation(title: Column) -> Column:
    """'Resignation as member of', and a committee behind it."""

    def told(words: Column) -> Column:
        at = F.array_min(_places(words, _phrase(words, P.RESIGNATIONS, ("as",), P.MEMBER_WORDS, ("of",))))
        return F.coalesce(at + 3 < F.array_max(_places(words, lambda w, i: F.contains(w, F.lit("committee")))), F.lit(False))

    return let(_words(title), told)


def has_several_signers(title: Column) -> Column:
    return F.array_contains(_words(title), P.RESIGNATIONS[1])


def house_bills(bills: DataFrame) -> DataFrame:
    return bills.withColumn("change_type", house_change(F.col("title"))).where("change_type is not null")


def senate_bills(bills: DataFrame) -> DataFrame:
    return bills.withColumn("party", senate_party(F.col("title"))).where("party is not null")


def agreed_date(actions: Column) -> Column:
    """Date of the first action, in the order of the list, whose text has 'agreed to'; null if that one has none."""
    return F.get(F.filter(actions, lambda a: F.contains(F.lower(F.coalesce(a["text"], F.lit(""))), F.lit("agreed to"))), F.lit(0))["actionDate"]
