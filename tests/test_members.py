"""Text functions and member lists on self-written examples."""

from __future__ import annotations

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from seatledger.functions import notes as N
from seatledger.functions import text as T
from seatledger.operators import classify, letters
from seatledger.operators import members as M
from seatledger.plans import queries


def one(spark, f, *values):
    """``f`` over one row of string columns."""
    names = [f"c{i}" for i in range(len(values))]
    row = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names)).select(f(*[F.col(n) for n in names]).alias("out")).first()["out"]
    return [tuple(x) if hasattr(x, "asDict") else x for x in row] if isinstance(row, list) else row


@pytest.mark.parametrize("text,want", [
    ("Mr. Oak, Ms. Elm of Ohio, and Mrs. Ash.", [("Mr. Oak", None), ("Ms. Elm of Ohio", None), ("Mrs. Ash", None)]),
    ("Mr. Oak (to rank immediately after Mr. Fir), Mr. Elm.", [("Mr. Oak", "Mr. Oak (to rank immediately after Mr. Fir)"), ("Mr. Elm", None)]),
    ("Mr. Oak of Iowa, to rank after Ms. Elm.", [("Mr. Oak of Iowa", "Mr. Oak of Iowa, to rank after Ms. Elm")]),
    ("Ms. Elm, Chair; Mr. Oak; and Mrs. Ash.", [("Ms. Elm", "Ms. Elm, Chair"), ("Mr. Oak", None), ("Mrs. Ash", None)]),
    ("Mr. Oak (when sworn) and Mr. Elm", [("Mr. Oak", "Mr. Oak (when sworn)"), ("Mr. Elm", None)]),
    ("Mr. John Oak, Jr. of Illinois, Mr. Elm", [("Mr. John Oak, Jr. of Illinois", None), ("Mr. Elm", None)]),
    ("Mr. Oak shall rank immediately following Mr. Elm", [("Mr. Oak", "Mr. Oak shall rank immediately following Mr. Elm")]),
    ("Mr. Oak, Mr. Elm (to rank immediately after Ms. Fir).", [("Mr. Oak", None), ("Mr. Elm", "Mr. Elm (to rank immediately after Ms. Fir)")]), ("Mr. Rafter of Ohio", [("Mr. Rafter of Ohio", None)]),
    ("", []), (None, []),
])
def test_split_with_notes(spark, text, want):
    assert one(spark, M.split_with_notes, text) == want


@pytest.mark.parametrize("text,want", [
    ("Ann Oak, Texas; Bob Elm, Jr., California; and Cy Ash, Louisiana.", [("Ann Oak of Texas", None), ("Bob Elm, Jr. of California", None), ("Cy Ash of Louisiana", None)]),
    ("*Dee Fir, D.C. (Delegate); [vacancy]", [("Dee Fir of D.C", "Dee Fir, D.C. (Delegate)")]),
    ("Ed Yew, Ohio, Ranking Minority Member; Flo Bay, Guam, (When Sworn)", [("Ed Yew of Ohio", "Ed Yew, Ohio, Ranking Minority Member"), ("Flo Bay of Guam", "Flo Bay, Guam, (When Sworn)")]),
])
def test_split_name_state(spark, text, want):
    assert one(spark, M.split_name_state, text) == want


def test_other_splitters(spark):
    assert one(spark, M.split_numbered, "(1) Mr. Oak. (2) Ms. Elm. ") == [("Mr. Oak", None), ("Ms. Elm", None)]
    assert one(spark, M.split_plain, "Mr. Oak, and Ms. Elm.") == ["Mr. Oak", "Ms. Elm"]
    assert one(spark, M.split_senate, "Mr. Oak (Chair), _______, Mr. Elm (FL), Ms. Ash (ex officio).") == [("Mr. Oak", "Mr. Oak (Chair)"), ("Mr. Elm (FL)", None), ("Ms. Ash", "Ms. Ash (ex officio)")]
    assert one(spark, M.is_name_state, "Ann Oak, Texas; Bob Elm, Ohio") and one(spark, M.is_name_state, "Mr. Oak, Michigan; and Mr. Elm, Alabama.")
    assert not one(spark, M.is_name_state, "Mr. Oak of Michigan, Mr. Elm")


@pytest.mark.parametrize("text,want", [("AGRICULTURE", "Agriculture"), ("committee ON ways AND means", "Committee on Ways and Means"), ("the children's diaz-balart", "The Children'S Diaz-Balart"), ("é COMITÉ of 2nd", "É Comité of 2Nd")])
def test_titlecase(spark, text, want):
    assert one(spark, T.titlecase, text) == want


def test_text_functions(spark):
    assert one(spark, T.clean, "  a  b\n c ") == "a b c"
    assert one(spark, T.clean_committee, "Committee on Ethics.—") == "Committee on Ethics"
    assert one(spark, T.normalise_committee, "House Committee on the Judiciary, Permanent") == "judiciary permanent"
    assert one(spark, T.fold, "Velázquez-D’Esposito") == "velazquez d'esposito"
    assert [one(spark, T.state_code, x) for x in ("tx", "Texas", "the Virgin Islands", "Tennnesse", "D.C.", "Zzzz", "", None)] == ["TX", "TX", "VI", "TN", "DC", None, None, None]
    assert [one(spark, T.printed_state, x) for x in ("Mr. Oak of Ohio", "Ms. Elm or Oregon", "Mr. Fir (FL)", "Mr. Ash")] == ["OH", "OR", "FL", None]
    assert [one(spark, T.bare_name, x) for x in ("Mr.Oak of Ohio", "Mr. Fir (FL)", "Ann Oak")] == ["Oak", "Fir", "Ann Oak"]
    assert [one(spark, T.honorific_gender, x) for x in ("Mr. A", "Mrs. B", "C", None)] == ["M", "F", None, None]
    assert [one(spark, T.signer_name, x) for x in ("Rep. Ann B. Oak, MD, MBA", "Bob Elm M.D.", "Cy Ash Jr.", "Dee Fir (CA-44)", "Jr", None)] == ["Ann B. Oak", "Bob Elm", "Cy Ash", "Dee Fir", "Jr", ""]
    assert [one(spark, T.guess_surname, x) for x in ("Mr. Oak of Ohio", "Ann Elm, Jr.", "")] == ["Oak", "Elm", ""]
    assert [one(spark, T.compact_date, x) for x in ("20250103", "2025", None)] == ["2025-01-03", None, None]
    assert [one(spark, T.issue_date, x) for x in ("CREC-2001-02-08-pt1", "x", None)] == ["2001-02-08", None, None]
    assert one(spark, lambda c: T.pre_text(c), "<html><PRE class='x'>A &amp; <b>B</b>\nC</PRE> tail</html>") == "A & B\nC"
    row = spark.range(1).select(T.in_organizing_window(F.lit("119"), F.lit("2025-01-31")), T.in_organizing_window(F.lit("119"), F.lit("2025-02-01")), T.ordinal(F.lit(111)), T.ordinal(F.lit(103)), T.human_size(F.lit(2048.0))).first()
    assert tuple(row) == (True, False, "111th", "103rd", "2.0 KB")


def test_titles(spark):
    rows = [("Electing a Member to certain standing committees", "addition"), ("Removing a Member, electing another to the committee", "removal"), ("Designating majority membership on certain standing committees", "addition"), ("Naming a post office", None), (None, None)]
    assert [one(spark, classify.house_change, t) for t, _ in rows] == [k for _, k in rows]
    assert [one(spark, classify.senate_party, t) for t in ("To constitute the majority party's membership", "Making minority party appointments", "Other", None)] == ["majority", "minority", None, None]
    assert [one(spark, classify.is_resignation, t) for t in ("RESIGNATION AS MEMBER OF COMMITTEE ON RULES", "x", None)] == [True, False, False]


def test_agreed_date(spark):
    a = spark.createDataFrame([([("2025-01-02", "Introduced", "I"), (None, "On motion Agreed to without objection", "F"), ("2025-01-04", "agreed to", "F")],)], "a array<struct<actionDate:string,text:string,type:string>>")
    assert a.select(classify.agreed_date(F.col("a")).alias("d")).first()["d"] is None


LETTER = """House of Representatives,

Washington, DC, February 8, 2001.
Hon. Dennis Speaker,
Speaker of the House of Representatives.
Dear Mr. Speaker: I resign.
  Sincerely,
                    Ann B. Oak, Jr.,
                    Member of Congress.
  The SPEAKER pro tempore. Without objection, the resignation is
accepted.
  There was no objection.
"""


def test_letters(spark):
    p = one(spark, lambda t, x: letters.parse(t, x), "RESIGNATION AS MEMBER OF COMMITTEE ON SCIENCE, SPACE, AND TECHNOLOGY AND COMMITTEE ON RULES", LETTER)
    assert p["committees"] == ["Committee on Science, Space, and Technology", "Committee on Rules"]
    assert (p["member_name"], p["signed_date"]) == ("Ann B. Oak, Jr.", "2001-02-08")
    assert one(spark, letters.signer, "Sincerely,\nBob Elm.\n____\n") == "Bob Elm"
    assert one(spark, letters.signer, "Sincerely,\nBob Elm.\n=== NOTE ===\nWithout objection") == "Bob Elm"
    assert one(spark, letters.signer, "") is None and one(spark, letters.signer, None) is None
    assert one(spark, letters.committees, "RESIGNATION AS MEMBER OF PERMANENT SELECT COMMITTEE ON A, COMMITTEE ON B, AND HOUSE COMMITTEE ON C") == ["Permanent Select Committee on A", "Committee on B", "House Committee on C"]
    assert one(spark, letters.committees, "OTHER") == []


RANKS = [f"{v} {h}{p} " for v in ("to rank", "shall rank", "will rank", "who shall rank", "who will rank") for h in ("", "immediately ") for p in ("after", "ahead of", "following")] + ["after ", "ahead of "]
ROLES = ("chair", "chairman", "chairwoman", "vice chair", "vice chairman", "vice chairwoman", "ranking member", "ranking minority member")


def test_every_note_holds_a_cue(spark):
    """The cheap test before the patterns passes over no note, in any case and in brackets; a plain name has none."""
    whole = [r + "Mr. Fir" for r in RANKS] + list(ROLES)
    notes = [form for n in whole for form in (n, n.upper(), n.title() + ".", f"Mr. Oak, {n}", f"Mr. Oak ({n})")] + ["Mr. Oak (when sworn)"]
    rows = spark.createDataFrame([(i, n) for i, n in enumerate([*notes, "Mr. Oak of Ohio", "", None])], "i int, n string")
    found = {r["i"]: r["cued"] for r in rows.select("i", N.may_hold_note(F.col("n")).alias("cued")).collect()}
    assert all(found[i] for i in range(len(notes))) and [found[len(notes) + k] for k in range(3)] == [False, False, None]


def is_note(s):
    low = s.rstrip(". ").lower()
    return low in ROLES or any(low.startswith(r) and len(low) > len(r) for r in RANKS)


def name_alone(raw):
    """Word by word: the first word from which on the rest is a note ends the name."""
    for p in re.findall(r"\([^()]*\)", raw):
        if is_note(p[1:-1].strip()) or p[1:-1].strip().lower() == "when sworn":
            raw = raw.replace(" " + p, "").replace(p, "")
    for i in range(len(raw)):
        if (i == 0 or raw[i - 1] in ", ") and raw[i] not in ", " and (any(raw[i:].lower().startswith(r) and raw[i + len(r) :] for r in RANKS) or raw[i:].rstrip(". ").lower() in ROLES):
            return raw[:i].rstrip(", ")
    return raw


def brute_split(text):
    """Character by character: breaks outside parentheses, notes back to the name before, notes off the clean name."""
    text = " ".join((text or "").split())
    inside = [False] * (len(text) + 1)  # True where the next parenthesis closes
    for i in range(len(text) - 1, -1, -1):
        inside[i] = {"(": False, ")": True}.get(text[i], inside[i + 1])
    frags, at, i = [], 0, 0
    while i < len(text):
        word = next((w for w in (" and ", " & ") if text.startswith(w, i)), text[i] if text[i] in ",;" else "")
        if word and not inside[i + len(word)]:
            frags.append(text[at:i])
            at = i = i + len(word)
        else:
            i += 1
    bare = lambda s: re.sub(r"(?i)^(?:and|&)\s+", "", s).strip()
    names = []
    for f in [f.strip() for f in [*frags, text[at:]] if f.strip()]:
        if names and (is_note(bare(f)) or re.match(r"(?i)(?:jr|sr|ii|iii|iv)\.? of .", bare(f))):
            names[-1] += ", " + f
        else:
            names.append(f)
    pairs = []
    for raw in map(bare, names):
        name = " ".join(name_alone(raw).split()).rstrip(".,;")
        raw = raw.rstrip(".,;")
        if name:
            pairs.append((name, raw if raw != name else None))
    return pairs


def test_split_members_notes_reads_whole_texts(spark, tmp_path):
    rng = random.Random(5)
    parts = ["Mr. Oak", "Ms. Elm of Ohio", "Mrs. Ash (to rank after Mr. Fir, and Ms. Yew)", "Chair", "to rank after Mr. Fir", "Jr. of Iowa", "and", "(when sworn)", "Ranking Member.", ")", "(", "é ß.", ""]
    texts = ["".join(rng.choice(parts) + rng.choice([", ", "; ", " and ", "\n", ",\n", " & ", "\n\n "]) for _ in range(rng.randrange(30))) for _ in range(300)]
    texts += ["Mr. Oak,\nMs. Elm, Chair", "Mr. Oak\n(to rank after\nMr. Fir)", "\nMs. Elm", "", None, "\n", ", ".join(f"Mr. Oak{i}, Chair" if i % 3 else "to rank after Ms. Elm" for i in range(20_000))]
    if os.path.isdir("/root/testdata/sf0.001"):
        texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in queries.QUERIES["split_members_notes"](spark, str(tmp_path)).collect())
    want = [(i, k, *pair) for i, t in enumerate(texts) for k, pair in enumerate(brute_split(t))]
    assert [g[:3] for g in got] == [w[:3] for w in want] and got == want
