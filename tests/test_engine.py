"""Documents to events, name resolution, rosters, reports, sources and sinks."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from seatledger import schemas as S
from seatledger.operators import blocks, committees, resolve, roster
from seatledger.plans import events as E
from seatledger.plans import site
from seatledger.sources import landing, sinks, xmldocs

XML = """<?xml version="1.0"?>
<!DOCTYPE resolution PUBLIC "-//X//DTD" "res.dtd">
<resolution resolution-stage="Engrossed-in-House"><metadata xmlns:dc="http://purl.org/dc/elements/1.1/"><dublinCore><dc:title>119 HRES 7 EH: Electing Members</dc:title></dublinCore></metadata>
<form><action><action-date date="20250110">January 10, 2025</action-date></action><official-title>Electing Members to certain standing committees.</official-title></form>
<resolution-body><section><text>Resolved, That the following named Members be, and are hereby, elected:</text>
<committee-appointment-paragraph><header><committee-name committee-id="HAG00">Committee on AGRICULTURE</committee-name>:</header><text>Mr. Oak of Ohio, Chairman; Ms. Elm&nbsp;of Texas, Mr. Fir.</text></committee-appointment-paragraph>
<committee-appointment-paragraph><header>Committee on Rules.—</header><text>Mr. Ash <committee-name>wrong</committee-name></text></committee-appointment-paragraph>
<committee-appointment-paragraph><header>Committee on Ethics:</header><text>Mr. Bay, Mrs. Yew</text></committee-appointment-paragraph>
<paragraph><enum>(1)</enum><header>Committee on Budget</header><text>Mr. Box</text></paragraph>
</section><subsection><header>Joint Committee on Printing</header><text>The following are elected:</text><paragraph><enum>1</enum><text>Mr. Oak</text></paragraph><paragraph><text>Ms. Elm</text></paragraph></subsection>
</resolution-body></resolution>"""

TEXT = """<html><body><pre>
[Congressional Bills 109th Congress]
In the House of Representatives, U.S.,

January 6, 2005.
  Resolved, That the following Members be, and are hereby, elected to the following standing committees of the House of Representatives:
  Committee on Agriculture: Mr. Oak of Ohio, Chairman; Mr. Diaz-
Elm; Ms. Fir.
  (2) Committee Resources: Mr. Ash and Mr. Bay, both to rank in the named order following Mr. Yew.
  Attest: Clerk. </pre></body></html>"""


def legislators(spark):
    term = lambda k, st, a, b: (k, st, a, b, "P")
    rows = [
        ("O1", "Sam", "Oak", "M", None, [term("rep", "OH", "2001-01-03", None)]), ("O2", "Una", "Oak", "F", None, [term("rep", "TX", "2001-01-03", None)]),
        ("E1", "Ann", "Elm", "F", ["Pine"], [term("rep", "TX", "2003-01-03", "2009-01-03")]), ("E2", "Bob", "Elm", "M", None, [term("rep", "TX", "1991-01-03", "1999-01-03")]),
        ("W1", "Debbie", "Wasser Elm", "F", None, [term("rep", "FL", "2005-01-03", None)]), ("J1", "Eddie", "Johnson", "F", None, [term("rep", "TX", "1993-01-03", None)]),
        ("J2", "Sam", "Johnson", "M", None, [term("rep", "TX", "1991-01-03", None)]), ("V1", "Nydia", "Velázquez", "F", ["Velazquez"], [term("rep", "NY", "1993-01-03", None)]),
        ("S1", "Ann", "Elm", "F", None, [term("sen", "FL", "2001-01-03", None)]), ("D1", "Thomas", "Davis", "M", None, [term("rep", "VA", "1995-01-03", None)]), ("D2", "James", "Davis", "M", None, [term("rep", "VA", "1995-01-03", None)]),
        (None, "No", "Id", "M", None, [term("rep", "VA", "1995-01-03", None)]),
    ]
    data = [((b,), (f, None, last, f"{f} {last}"), (g,), [(a, None) for a in al] if al else None, t) for b, f, last, g, al, t in rows]
    return spark.createDataFrame(data, S.LEGISLATORS)


@pytest.mark.parametrize("printed,state,date,want", [
    ("Mr. Oak of Ohio", None, None, "O1"), ("Mr. Oak", None, None, "O1"), ("Ms. Oak", None, None, "O2"), ("Oak", None, None, None), ("Oak", "Texas", None, "O2"), ("Mr. Oak of Maine", None, None, "O1"),
    ("Elm", None, "2005-01-01", "E1"), ("Mr. Elm of Texas", None, "1995-05-05", "E2"), ("Elm", None, "1980-01-01", None), ("Ms. Pine of Texas", None, "2005-01-01", "E1"),
    ("Ms. Wasser Elm of Florida", None, None, "W1"), ("Debbie Wasser Elm", None, None, "W1"), ("Ms. Johnson of Texas", None, None, "J1"), ("Mr. Sam Johnson of Texas", None, None, "J2"),
    ("Ms. Eddie Bernice-Johnson of Texas", None, None, "J1"), ("Ms. Christian-Johnson of Ohio", None, None, None), ("Mr. Tom Davis of Virginia", None, None, "D1"), ("Mr. Davis of Virginia", None, None, None),
    ("Thomas Davis, Jr. of Virginia", None, None, "D1"), ("Velazquez", None, None, None), ("Mr. Nobody", None, None, None), ("", None, None, None), (None, None, None, None),
])
def test_lookup(spark, printed, state, date, want):
    names = spark.createDataFrame([(1, printed, state, date)], "name_id long, printed string, state string, on_date string")
    found = resolve.lookup(names, resolve.candidates(legislators(spark))).collect()
    assert (found[0]["bioguide"] if found else None) == want


def test_lookup_full_name(spark):
    names = spark.createDataFrame([(1, "Tom", "Davis", "2000-01-01"), (2, "Zed", "Davis", "2000-01-01"), (3, "Zed", "Elm", "2005-01-01"), (4, "Ann", "Elm", "1980-01-01")], "name_id long, first string, last string, on_date string")
    assert {r["name_id"]: r["bioguide"] for r in resolve.lookup_full_name(names, resolve.candidates(legislators(spark))).collect()} == {1: "D1", 3: "E1"}


def test_senate_candidates(spark):
    assert [r["bioguide"] for r in resolve.candidates(legislators(spark), "senate").collect()] == ["S1"]


def test_xml_walk():
    d = xmldocs.walk(XML)
    assert (d["xml_congress"], d["xml_type"], d["xml_number"], d["doc_date"], d["stage"], d["error"]) == ("119", "HRES", "7", "20250110", "Engrossed-in-House", None)
    assert [b["kind"] for b in d["blocks"]] == [0, 0, 0, 1, 2] and d["blocks"][3]["texts"] == ["Mr. Oak", "Ms. Elm"]
    assert xmldocs.walk("<a><b></a>")["error"] and xmldocs.walk(None)["error"]
    assert xmldocs.walk("<resolution><form><congress>111th</congress><legis-num>H. RES. 80</legis-num></form></resolution>")["xml_number"] == "80"


def landed(spark):
    bills = [(119, "hres", "7", "Electing Members to committees", 0, "2025-01-11"), (119, "hres", "8", "Electing a Member to the committee", 1, "2025-03-01"), (119, "hres", "9", "Naming a bridge", 2, "2025-03-01"), (109, "hres", "6", "Electing Members to standing committees", 0, "2005-01-07"), (119, "hres", "5", "Electing to committee, bad document", 3, "2025-03-01")]
    actions = [(119, "hres", "7", [("2025-01-10", "Agreed to", "F")]), (119, "hres", "8", [("2025-03-01", "Referred", "F")]), (109, "hres", "6", [("2005-01-06", "On agreeing: agreed to", "F")]), (119, "hres", "5", [("2025-03-02", "agreed to", "F")])]
    rend = [(119, "hres", "7", "govinfo", "ih", "xml", XML.replace("AGRICULTURE", "Wrong stage")), (119, "hres", "7", "govinfo", "eh", "xml", XML), (119, "hres", "7", "congress", "eh", "text", TEXT), (119, "hres", "8", "govinfo", "eh", "xml", XML), (109, "hres", "6", "congress", "eh", "text", TEXT), (119, "hres", "5", "govinfo", "eh", "xml", "<broken")]
    return E.Landed(
        bills=spark.createDataFrame(bills, "congress int, bill_type string, number string, title string, api_pos long, update_date string"), actions=spark.createDataFrame(actions, S.ACTIONS_PAGE), renditions=spark.createDataFrame(rend, S.RENDITIONS), legislators=legislators(spark),
        committees=spark.createDataFrame([(0, "hsag00", "Agriculture Committee", []), (1, "hsru00", "Rules", ["House Committee on Rules"]), (2, "other", "Committee on Rules", [])], "rec_pos int, systemCode string, name string, previous_names array<string>"),
        packages=spark.createDataFrame([("CREC-2005-02-08", "2005-02-08"), ("CREC-2007-01-03", "2007-01-03")], "packageId string, dateIssued string"),
        granules=spark.createDataFrame([("CREC-2005-02-08", 0, "CREC-2005-02-08-pt1-PgH228", "RESIGNATION AS MEMBER OF COMMITTEE ON RULES AND COMMITTEE ON AGRICULTURE"), ("CREC-2005-02-08", 1, "g2", "RESIGNATIONS AS MEMBERS OF COMMITTEE ON RULES"), ("CREC-2005-02-08", 2, "g3", None), ("CREC-2005-02-08", 3, "g4", "RESIGNATION AS MEMBER OF (TEMPORARY) COMMITTEE"), ("CREC-2007-01-03", 0, "g5", "RESIGNATION AS MEMBER OF COMMITTEE ON RULES")], "packageId string, pos int, granuleId string, title string"),
        texts=spark.createDataFrame([("CREC-2005-02-08-pt1-PgH228", "<html><pre>Washington, DC, February 7, 2005.\nSincerely,\nAnn Elm,\nMember of Congress.\nWithout objection, the resignation is accepted.</pre></html>")], S.GRANULE_TEXT),
    )


def test_house_xml_events(spark):
    rows = E.house(landed(spark), 119).orderBy("doc_seq", "block_pos", "member_pos").collect()
    got = [(r["committee"], r["member_name"], r["member_name_raw"], r["party_rank"], r["bioguide_id"]) for r in rows]
    assert got == [
        ("Committee on Agriculture", "Mr. Oak of Ohio", "Mr. Oak of Ohio, Chairman", 1, "O1"), ("Committee on Agriculture", "Ms. Elm of Texas", None, 2, "E1"), ("Committee on Agriculture", "Mr. Fir", None, 3, None),
        ("Committee on Rules", "Mr. Ash wrong", None, None, None), ("Committee on Ethics", "Mr. Bay", None, 2, None), ("Committee on Ethics", "Mrs. Yew", None, 3, None),
        ("Joint Committee on Printing", "Mr. Oak", None, 2, "O1"), ("Joint Committee on Printing", "Ms. Elm", None, 3, "E1"), ("Committee on Budget", "Mr. Box", None, None, None),
    ]
    assert {r["system_code"] for r in rows if r["committee"] == "Committee on Rules"} == {"hsru00"} and rows[0]["gpo_code"] == "HAG00"
    assert rows[0]["date"] == "2025-01-10" and rows[0]["source_ref"]["govinfo_xml_url"].endswith("/BILLS-119hres7eh/xml/BILLS-119hres7eh.xml")
    assert E.house(landed(spark), 119, since="2025-02-01").count() == 0


def test_house_text_events(spark):
    rows = E.house(landed(spark), 109).orderBy("block_pos", "member_pos").collect()
    assert [(r["committee"], r["member_name"], r["party_rank"]) for r in rows] == [("Committee on Agriculture", "Mr. Oak of Ohio", 1), ("Committee on Agriculture", "Mr. Diaz-Elm", 2), ("Committee on Agriculture", "Ms. Fir", 3), ("Committee on Resources", "Mr. Ash", 2), ("Committee on Resources", "Mr. Bay", 3)]
    assert rows[0]["source_ref"]["govinfo_xml_url"] == "https://www.congress.gov/109/bills/HRES6/BILLS-hres6eh.htm"


@pytest.mark.parametrize("body,want", [
    ("Resolved, That on the Committee on Resources, Mr. Oak of Ohio shall rank after Mr. Elm of Texas. Attest: Clerk", [("Committee on Resources", "Mr. Oak of Ohio", "Mr. Oak of Ohio shall rank after Mr. Elm of Texas")]),
    ("Resolved, That Mr. Oak of Ohio shall rank after Mr. Elm on the Committee on Rules. Attest:", [("Committee on Rules", "Mr. Oak of Ohio", "Mr. Oak of Ohio shall rank after Mr. Elm")]),
    ("Resolved, (a) Joint Committee on Printing.--The following Members are hereby elected to the Joint Committee on Printing: (1) Mr. Oak. (2) Ms. Elm. (b) Joint Committee of Congress on the Library.--The following Members are hereby elected to it: (1) Mr. Fir. Attest:", [("Joint Committee on Printing", "Mr. Oak", None), ("Joint Committee on Printing", "Ms. Elm", None), ("Joint Committee of Congress on the Library", "Mr. Fir", None)]),
    ("Electing the Joint Committee on X: y. Resolved, That the following are elected to the following joint committees, to serve with the Committee on House Administration: Joint Committee on Printing: Mr. Oak, Ms. Elm. Joint Committee of Congress on the Library: Mr. Fir. &lt;all&gt;", [("Joint Committee on Printing", "Mr. Oak", None), ("Joint Committee on Printing", "Ms. Elm", None), ("Joint Committee of Congress on the Library", "Mr. Fir", None)]),
    ("Resolved, That the rules provide how chairmen are elected. STANDING COMMITTEE CHAIRMEN. More text.", []),
    ("Resolved, elected to the following: COMMITTEE ON RULES: Ann Oak, Texas; Bob Elm, Ohio: Provided, That the powers and duties conferred upon the chairman of the Committee on Rules by the House rules shall be exercised by the vice chairman thereof until otherwise ordered by the House. COMMITTEE ON BUDGET: Cy Ash, Guam. Attest:", [("Committee on Rules", "Ann Oak of Texas", None), ("Committee on Rules", "Bob Elm of Ohio", None), ("Committee on Budget", "Cy Ash of Guam", None)]),
])
def test_text_schemas(spark, body, want):
    rows = blocks.house_text(spark.createDataFrame([(body,)], "body string")).select("block_pos", "committee", F.posexplode("pairs").alias("p", "m")).orderBy("block_pos", "p").collect()
    assert [(r["committee"], r["m"]["clean"], r["m"]["raw"]) for r in rows] == want


def test_record_events(spark):
    rows = E.record(landed(spark), 109, "2005-01-03", "2007-01-03").orderBy("committee").collect()
    assert [(r["committee"], r["member_name"], r["bioguide_id"], r["date"], r["system_code"]) for r in rows] == [("(Temporary) Committee", None, None, "2005-02-08", None), ("Committee on Agriculture", "Ann Elm", "E1", "2005-02-08", "hsag00"), ("Committee on Rules", "Ann Elm", "E1", "2005-02-08", "hsru00")]
    ref = rows[-1]["source_ref"]
    assert (ref["type"], ref["page"], ref["signed_date"], ref["url"]) == ("record", "H228", "2005-02-07", "https://www.govinfo.gov/app/details/CREC-2005-02-08")


def senate_doc(*rosters):
    paras = "".join(f"<committee-appointment-paragraph><header>{c}:</header><text>{m}</text></committee-appointment-paragraph>" for c, m in rosters)
    return f"<resolution><resolution-body>{paras}</resolution-body></resolution>"


def test_senate_events(spark):
    bills = [(119, "sres", "1", "majority party's membership", 2, "x"), (119, "sres", "2", "majority party membership", 1, "x"), (119, "sres", "3", "minority party appointments", 0, "x"), (119, "sres", "4", "majority party membership", 3, "x")]
    actions = [(119, "sres", "1", [("2025-01-05", "agreed to", "F")]), (119, "sres", "2", [("2025-02-01", "agreed to", "F")]), (119, "sres", "3", [("2025-01-05", "agreed to", "F")]), (119, "sres", "4", [("2025-03-01", "agreed to", "F")])]
    single = "<pre>Resolved, That the following Senator shall be added to the majority party's membership on the Committee on Rules for the 119th Congress until March 1, 2025: Mr. Yew.</pre>"
    rend = [(119, "sres", "1", "govinfo", "ats", "xml", senate_doc(("Committee on Rules", "Mr. Oak (Chair), Mr. Elm, ____"), ("Committee on Budget", "Mr. Ash"))), (119, "sres", "2", "govinfo", "ats", "xml", senate_doc(("Committee on Rules", "Mr. Elm, Mr. Fir"), ("Committee on Budget", ""))), (119, "sres", "3", "govinfo", "ats", "xml", senate_doc(("Committee on Rules", "Mr. Bay"))), (119, "sres", "4", "govinfo", "ats", "text", single)]
    given = E.Landed(bills=spark.createDataFrame(bills, "congress int, bill_type string, number string, title string, api_pos long, update_date string"), actions=spark.createDataFrame(actions, S.ACTIONS_PAGE), renditions=spark.createDataFrame(rend, S.RENDITIONS))
    rows = E.collect(given, 119, "senate").orderBy("date", "doc_seq", "block_pos", "member_pos").collect()
    assert sorted(((r["date"], r["committee"], r["change_type"], r["member_name"], r["member_name_raw"]) for r in rows), key=str) == sorted([
        ("2025-01-05", "Committee on Rules", "addition", "Mr. Bay", None), ("2025-01-05", "Committee on Rules", "addition", "Mr. Oak", "Mr. Oak (Chair)"), ("2025-01-05", "Committee on Rules", "addition", "Mr. Elm", None), ("2025-01-05", "Committee on Budget", "addition", "Mr. Ash", None),
        ("2025-02-01", "Committee on Rules", "addition", "Mr. Fir", None), ("2025-02-01", "Committee on Rules", "removal", "Mr. Oak", "Mr. Oak (Chair)"), ("2025-02-01", "Committee on Budget", "removal", "Mr. Ash", None), ("2025-03-01", "Committee on Rules", "addition", "Mr. Yew", None),
    ], key=str)
    assert all(r["chamber"] == "senate" for r in rows)


@pytest.mark.parametrize("seed", range(4))
def test_roster_diff_is_a_fold(spark, seed):
    rng = random.Random(seed)
    history, want, state = [], [], {}
    for seq in range(40):
        key, full = rng.choice("ab"), rng.random() < 0.7
        ids = [rng.choice("uvwxyz") for _ in range(rng.randint(0, 5) if full else 1)]
        rows = [(i, f"{i}{seq}.{n}") for n, i in enumerate(ids)]
        history.append((key, seq, full, rows))
        now, old = dict(rows), state.get(key, {})
        if full:
            want += [(key, seq, "addition", i, now[i]) for i, _ in rows if i not in old]
            want += [(key, seq, "removal", i, p) for i, p in old.items() if i not in now]
            state[key] = now
        else:
            want += [(key, seq, "addition", i, p) for i, p in rows]
            state[key] = {**old, **now}
    df = spark.createDataFrame(history, "key string, seq long, is_full boolean, members array<struct<identity:string,payload:string>>")
    got = [tuple(r) for r in roster.diff(df, ["key"]).select("key", "seq", "change", "identity", "payload").collect()]
    assert sorted(got) == sorted(want)
    assert sorted(tuple(r) for r in roster.final_state(df, ["key"]).collect()) == sorted((k, i, p) for k, s in state.items() for i, p in s.items())


def test_committee_index(spark):
    listed = spark.createDataFrame([(0, "a", "Agriculture Committee", None), (1, "b", "Sub", "a"), (2, None, "No code", None), (3, "c", "Farm Committee", None)], "rec_pos int, systemCode string, name string, parent string")
    details = spark.createDataFrame([("a", [("Committee on Farming", None), (None, "Agriculture (Library)")]), ("c", [("Committee on Agriculture", "")])], "systemCode string, history array<struct<officialName:string,libraryOfCongressName:string>>")
    idx = {r["norm_name"]: (r["system_code"], r["collides"]) for r in committees.index(committees.records(listed, details)).collect()}
    assert idx == {"agriculture": ("a", True), "farming": ("a", False), "agriculture library": ("a", False), "farm": ("c", False)}


def test_merge_and_corrections(spark):
    new = E.house(landed(spark), 119).cache()
    old = new.where("member_name = 'Mr. Fir'").withColumn("bioguide_id", F.lit("X9"))
    merged = E.merge_ids(new, old)
    assert merged.count() == new.count() and {r["bioguide_id"] for r in merged.where("member_name = 'Mr. Fir'").collect()} == {"X9"}
    k = new.where("member_name = 'Mr. Fir'").first()
    edits = spark.createDataFrame([("119", "house", "resolution", k["doc_seq"], k["block_pos"], k["member_pos"], f, v) for f, v in (("party_rank", ""), ("committee", " "), ("bioguide_id", "Z1"), ("date", ""))], "congress string, chamber string, source string, doc_seq long, block_pos int, member_pos int, field string, value string")
    # The same numbers in another Congress are another event.
    other = new.withColumn("congress", F.lit("118"))
    both = E.corrected(new.unionByName(other), edits)
    assert both.where("bioguide_id = 'Z1'").select("congress").collect() == [("119",)] and both.where("congress = '118'").exceptAll(other).count() == 0
    r = E.corrected(new, edits).where("member_name = 'Mr. Fir'").first()
    assert (r["party_rank"], r["committee"], r["bioguide_id"], r["date"]) == (None, "Committee on Agriculture", "Z1", None)


def test_site_and_sinks(spark, tmp_path):
    given = landed(spark)
    events = E.collect(given, 119).unionByName(E.collect(given, 109)).cache()
    per = {r["congress"]: r for r in site.per_congress(events).collect()}
    assert per[119]["total"] == 9 and per[109]["total"] == 8 and per[109]["removals"] == 3
    assert site.summary(events).first()["total"] == 17 and site.current_alert(events).first()["congress"] == 119
    com = {r["key"]: (r["name"], r["formerly"]) for r in site.committees(events).collect()}
    assert com["hsag00"] == ("Committee on Agriculture", [])
    people = site.members(events, given.legislators)
    assert {r["bioguide"]: r["state"] for r in people.collect()}.keys() >= {"O1", "E1"}
    compact = site.compact(events).cache()
    assert {r["c"]: (r["additions"], r["removals"]) for r in site.changes_by_congress(compact).collect()} == {119: (9, 0), 109: (5, 3)}
    assert [tuple(r) for r in site.removals_by_year(compact).collect()] == [("2005", 3)]
    assert site.most(compact, "k", 1).first()["k"] == "hsag00"
    assert site.timeline(compact, "hsag00").count() == 2 and site.member_history(compact, "O1").count() == 2
    assert site.named(compact, people, site.committees(events)).count() == 17 and site.picker(compact, site.committees(events)).first()["key"] == "hsag00"
    assert site.browse(events, query="rules", only_missing=False).count() >= 2 and site.event_log(compact, "hsag00").count() >= 6
    assert [r["bioguide"] for r in site.search_people(given.legislators, "velaz").collect()] == ["V1"] and site.search_members(people, "o").count() == 0 and site.search_members(people, "oak").count() == 1
    out = str(tmp_path / "deep" / "committee_changes_119.json")
    assert sinks.export_events(events.where("congress = '119'"), out) == 9
    data = json.load(open(out))
    assert set(data[0]) == set(S.EVENT_FIELDS) and set(data[0]["source_ref"]) == set(S.REF_FIELDS["resolution"])
    assert landing.congress_files(spark, str(tmp_path / "deep")).where("congress = '119'").count() == 9
    assert landing.previous_events(spark, out).count() == 9 and landing.previous_events(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "bad.json").write_text("{broken")
    assert landing.previous_events(spark, str(tmp_path / "bad.json")).count() == 0
    sinks.write_events(events, str(tmp_path / "store"))
    sinks.write_events(events.where("congress = '119'"), str(tmp_path / "store"))
    assert spark.read.parquet(str(tmp_path / "store")).count() == 17
    sinks.export_site(str(tmp_path / "site.json"), site.committees(events), people, compact)
    assert len(json.load(open(tmp_path / "site.json"))["events"]) == 17 and not [f for f in os.listdir(tmp_path) if f.startswith("tmp")]


def test_landing(spark, tmp_path):
    for k, page in enumerate([{"congress": 119, "bill_type": "hres", "page": 0, "bills": [{"number": "1", "title": "a"}, {"number": "2"}], "pagination": {"next": "u"}}, {"congress": 119, "bill_type": "hres", "page": 1, "bills": [{"number": "3", "title": "c"}], "pagination": {}}, {"bills": []}]):
        (tmp_path / f"{k}.json").write_text(json.dumps(page))
    rows = landing.bills(spark, str(tmp_path)).orderBy("api_pos").collect()
    assert [(r["number"], r["title"]) for r in rows] == [("1", "a"), ("2", ""), ("3", "c")]
    (tmp_path / "govinfo").mkdir()
    (tmp_path / "govinfo" / "BILLS-119hres7eh.xml").write_text(XML)
    r = landing.renditions(spark, str(tmp_path / "govinfo" / "*.xml")).first()
    assert (r["congress"], r["bill_type"], r["number"], r["host"], r["stage"], r["format"]) == (119, "hres", "7", "govinfo", "eh", "xml") and r["body"] == XML
    (tmp_path / "l.yaml").write_text("- id: {bioguide: A1}\n  name: {first: Ann, last: Oak}\n  terms:\n  - {type: rep, state: OH, start: 2001-01-03, end: '2003-01-03', party: P}\n")
    p = landing.legislators(spark, [str(tmp_path / "l.yaml")]).first()
    assert p["id"]["bioguide"] == "A1" and p["terms"][0]["start"] == "2001-01-03"


def test_command_line(spark, tmp_path, capsys):
    from seatledger.__main__ import main

    def put(folder, name, data):
        os.makedirs(tmp_path / folder, exist_ok=True)
        (tmp_path / folder / name).write_text(data if isinstance(data, str) else json.dumps(data))

    assert main(["--congress", "119", "--landing", str(tmp_path)], spark) == 2
    put("bills", "0.json", {"congress": 119, "bill_type": "hres", "page": 0, "bills": [{"number": "7", "title": "Electing Members to committees"}]})
    put("actions", "0.json", {"congress": 119, "bill_type": "hres", "number": "7", "actions": [{"actionDate": "2025-01-10", "text": "Agreed to", "type": "F"}]})
    put("renditions/govinfo", "BILLS-119hres7eh.xml", XML)
    put("committees", "0.json", {"chamber": "house", "committees": [{"systemCode": "hsag00", "name": "Agriculture Committee"}]})
    out = str(tmp_path / "out.json")
    assert main(["--congress", "119", "--landing", str(tmp_path), "--output", out], spark) == 0
    assert capsys.readouterr().out.startswith("9 events: 9 additions, 0 removals, 9 without a person")
    data = json.load(open(out))
    assert main(["--congress", "119", "--landing", str(tmp_path), "--out", str(tmp_path / "bare.json"), "--no-committee-codes", "--no-bioguide", "-v"], spark) == 0
    assert {e["system_code"] for e in json.load(open(tmp_path / "bare.json"))} == {None} and {e["system_code"] for e in data} == {None, "hsag00"}
    data[0]["bioguide_id"] = "H1"
    json.dump(data, open(out, "w"))
    (tmp_path / "legislators-x.yaml").write_text("- id: {bioguide: A1}\n  name: {first: Ann, last: Fir}\n  terms:\n  - {type: rep, state: OH, start: 2001-01-03, end: '2033-01-03', party: P}\n")
    assert main(["--congress", "119", "--landing", str(tmp_path), "--output", out], spark) == 0
    people = {e["member_name"]: e["bioguide_id"] for e in json.load(open(out))}
    assert people["Mr. Oak of Ohio"] == "H1" and people["Mr. Fir"] == "A1"
    os.makedirs(tmp_path / "people")
    (tmp_path / "people" / "legislators-y.yaml").write_text("- id: {bioguide: B1}\n  name: {first: Ann, last: Fir}\n  terms:\n  - {type: rep, state: OH, start: 2001-01-03, end: '2033-01-03', party: P}\n")
    assert main(["--congress", "119", "--landing", str(tmp_path), "--out", str(tmp_path / "own.json"), "--legislators-path", str(tmp_path / "people")], spark) == 0
    assert {e["member_name"]: e["bioguide_id"] for e in json.load(open(tmp_path / "own.json"))}["Mr. Fir"] == "B1"


def test_senate_removal_after_single_add(spark):
    """A roster, a senator added alone, and a roster without two of them: each removal has its own person."""
    bills = [(119, "sres", str(k), "majority party's membership", k, "x") for k in (1, 2, 3)]
    actions = [(119, "sres", str(k), [(f"2025-0{k}-05", "agreed to", "F")]) for k in (1, 2, 3)]
    single = "<pre>Resolved, That the following Senator shall be added to the majority party's membership on the Committee on Rules for the 119th Congress: Mr. Yew.</pre>"
    rend = [(119, "sres", "1", "govinfo", "ats", "xml", senate_doc(("Committee on Rules", "Mr. Oak, Mr. Elm"))), (119, "sres", "2", "govinfo", "ats", "text", single), (119, "sres", "3", "govinfo", "ats", "xml", senate_doc(("Committee on Rules", "Mr. Elm")))]
    people = [((b,), ("Sam", None, last, last), ("M",), None, [("sen", "OH", "2001-01-03", None, "P")]) for b, last in (("O1", "Oak"), ("E1", "Elm"), ("Y1", "Yew"))]
    given = E.Landed(bills=spark.createDataFrame(bills, "congress int, bill_type string, number string, title string, api_pos long, update_date string"), actions=spark.createDataFrame(actions, S.ACTIONS_PAGE), renditions=spark.createDataFrame(rend, S.RENDITIONS), legislators=spark.createDataFrame(people, S.LEGISLATORS))
    rows = E.collect(given, 119, "senate").orderBy("date", "doc_seq", "block_pos", "member_pos").collect()
    assert [(r["date"], r["change_type"], r["member_name"], r["bioguide_id"]) for r in rows] == [
        ("2025-01-05", "addition", "Mr. Oak", "O1"), ("2025-01-05", "addition", "Mr. Elm", "E1"), ("2025-02-05", "addition", "Mr. Yew", "Y1"), ("2025-03-05", "removal", "Mr. Oak", "O1"), ("2025-03-05", "removal", "Mr. Yew", "Y1"),
    ]
    assert len({(r["doc_seq"], r["block_pos"], r["member_pos"]) for r in rows}) == len(rows)


def test_letters_follow_resolutions(spark, tmp_path):
    given = landed(spark)
    rows = E.collect(given, 109).orderBy("doc_seq", "block_pos", "member_pos").collect()
    assert [r["source"] for r in rows] == ["resolution"] * 5 + ["congressional_record"] * 3
    assert [r["committee"] for r in rows[5:]] == ["Committee on Rules", "Committee on Agriculture", "(Temporary) Committee"]
    sinks.export_events(E.collect(given, 109), str(tmp_path / "committee_changes_109.json"))
    back = landing.congress_files(spark, str(tmp_path)).collect()
    assert [r["committee"] for r in back] == [r["committee"] for r in rows] and [r["doc_seq"] for r in back] == list(range(8))
    # A rename in the last event of the newest Congress names the committee.
    late = landing.congress_files(spark, str(tmp_path)).withColumn("committee", F.when(F.col("doc_seq") == 6, "Farms").otherwise(F.col("committee")))
    assert {r["key"]: r["name"] for r in site.committees(late).collect()}["hsag00"] == "Farms"


def test_a_failing_letter_source_is_left_out(spark, caplog):
    given = landed(spark)
    bad = E.Landed(**{**given.__dict__, "texts": given.texts.withColumn("body", F.raise_error(F.lit("bad letter")).cast("string"))})
    assert {r["source"] for r in E.collect(bad, 109).collect()} == {"resolution"} and "left out" in caplog.text
    with pytest.raises(Exception, match="bad letter"):
        E.collect(bad, 109, source="record")


def test_recompute_runs_a_batch_again(spark, tmp_path):
    from seatledger.streaming.rosters import recompute

    schema = "key string, seq long, is_full boolean, members array<struct<identity:string,payload:string>>"
    batch = lambda *rows: spark.createDataFrame(list(rows), schema)
    seen = []
    run = recompute(str(tmp_path / "history"), ["key"], lambda changes: seen.append(sorted(tuple(r)[:5] for r in changes.select("key", "seq", "change", "identity", "payload").collect())))
    first, late = batch(("a", 2, True, [("x", "p"), ("y", "p")]), ("b", 1, True, [("z", "p")])), batch(("a", 1, True, [("y", "q")]))
    for number, rows in ((0, first), (1, late), (1, late)):
        run(rows, number)
    assert seen[1] == seen[2] == [("a", 1, "addition", "y", "q"), ("a", 2, "addition", "x", "p")]
    assert spark.read.parquet(str(tmp_path / "history")).count() == 3


def test_store_site_and_cache(spark, tmp_path):
    given = landed(spark)
    events = E.collect(given, 119).unionByName(E.collect(given, 109))
    store = str(tmp_path / "store")
    sinks.write_events(events, store)
    assert [r["congress"] for r in landing.store_congresses(spark, store).collect()] == [119, 109]
    held = landing.store_events(spark, store, 109)
    assert held.count() == 8
    edits = spark.createDataFrame([("109", "house", "resolution", 0, 0, 0, "bioguide_id", "N1")], "congress string, chamber string, source string, doc_seq long, block_pos int, member_pos int, field string, value string")
    sinks.save_events(E.corrected(held, edits), store)
    assert [r["bioguide_id"] for r in landing.store_events(spark, store, 109).collect()][0] == "N1" and spark.read.parquet(store).count() == 17
    compact, people, named = site.compact(events), site.members(events, given.legislators), site.committees(events)
    sinks.export_site(str(tmp_path / "site.json"), named, people, compact)
    c, m, e = landing.site_tables(spark, str(tmp_path / "site.json"))
    assert e.count() == 17 and {r["key"] for r in c.collect()} == {r["key"] for r in named.collect()} and m.count() == people.count()
    calls = []

    def fetch():
        calls.append(1)
        return given.committees

    cache = str(tmp_path / "cache")
    for _ in range(2):
        assert landing.cached_records(spark, cache, fetch).count() == 3
    assert len(calls) == 1
    for f in os.listdir(cache):
        os.remove(os.path.join(cache, f))
    open(os.path.join(cache, "part-0.parquet"), "w").write("broken")
    assert landing.cached_records(spark, cache, fetch).count() == 3 and len(calls) == 2
    sinks.export_events(E.collect(given, 119), str(tmp_path / "out" / "committee_changes_119.json"))
    report = site.files_report(landing.congress_files(spark, str(tmp_path / "out")))
    assert report.first()["total"] == 9 and report.first()["size"].endswith("KB") and "<td>119th</td>" in site.downloads_page(report)


def test_live_source(spark):
    """Offset pages in parallel, pages with an address of the next in turn, from a server of our own."""
    import http.server
    import threading
    from urllib.parse import parse_qs, urlsplit

    from seatledger.sources import api

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            url, q = urlsplit(self.path), {k: v[0] for k, v in parse_qs(urlsplit(self.path).query).items()}
            if q.get("api_key") != "k" or url.path == "/gone":
                self.send_response(302 if url.path == "/gone" else 403)
                self.send_header("Location", "/bills?api_key=k")
                self.end_headers()
                return
            if url.path == "/bills":
                a, n = int(q["offset"]), int(q["limit"])
                page = {"bills": [{"number": str(i)} for i in range(a, min(7, a + n))], "pagination": {"count": 7, "next": "x"}}
            else:
                k = int(q.get("mark", 0))
                page = {"granules": [{"granuleId": f"g{k}"}] if k < 3 else [], "nextPage": f"http://127.0.0.1:{port}/granules?mark={k + 1}"}
            body = json.dumps(page).encode()
            self.send_response(200)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    port = server.server_address[1]
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        spark.dataSource.register(api.ApiSource)
        read = lambda **o: spark.read.format("congress_api").options(key="k", **o).load().orderBy("page", "pos").collect()
        rows = read(url=f"http://127.0.0.1:{port}/bills", items="bills", pageSize="3")
        assert [(r["page"], r["pos"], json.loads(r["item"])["number"]) for r in rows] == [(i // 3, i % 3, str(i)) for i in range(7)]
        rows = read(url=f"http://127.0.0.1:{port}/granules", items="granules", paging="cursor")
        assert [json.loads(r["item"])["granuleId"] for r in rows] == ["g0", "g1", "g2"]
        assert api.get_or_none(f"http://127.0.0.1:{port}/gone?api_key=k") is None
    finally:
        server.shutdown()
    assert api.key_of("govinfo", {"GOVINFO_API_KEY": "g"}) == "g" and api.key_of("congress", {"CONGRESS_GOV_API_KEY": "c"}) == "c"
    with pytest.raises(ValueError):
        api.key_of("congress", {})
    assert api.bills_url(119, since="2025-01-01").endswith("fromDateTime=2025-01-01T00%3A00%3A00Z") and "offsetMark=%2A" in api.granules_url("CREC-2005-02-08")
