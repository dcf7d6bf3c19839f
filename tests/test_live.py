"""A run against services of our own: what is asked for, in which order, and what comes of it."""

from __future__ import annotations

import http.server
import json
import threading
from urllib.parse import parse_qs, urlsplit

import pytest

from seatledger.__main__ import main
from seatledger.sources import api, live
from tests.test_engine import TEXT, XML

LETTER = "<html><pre>Washington, DC, February 7, 2025.\nSincerely,\nAnn Fir,\nMember of Congress.\nWithout objection, the resignation is accepted.</pre></html>"
PERSON = "- id: {bioguide: %s}\n  name: {first: Ann, last: %s}\n  terms:\n  - {type: rep, state: OH, start: 2001-01-03, end: '2033-01-03', party: P}\n"
BILLS = [("7", "Electing Members to committees"), ("8", "Electing a Member to the committee"), ("9", "Naming a bridge"), ("10", "Electing Members to standing committees")]
AGREED = [{"actionDate": "2025-01-10", "text": "Agreed to", "type": "F"}]


@pytest.fixture
def services(monkeypatch):
    """The mirrors of all services, and the paths that were asked for; ``gone`` holds paths that fail."""
    asked, gone = [], set()

    def page(path, q, root):
        here = f"{root}{path}"
        if path == "/api/bill/119/hres":
            some = BILLS[int(q["offset"]): int(q["offset"]) + int(q["limit"])]
            return {"bills": [{"number": n, "title": t, "updateDate": "2025-03-01", "extra": 1} for n, t in some], "pagination": {"count": len(BILLS)}}
        if path.endswith("/actions"):
            return {"actions": AGREED if path.split("/")[-2] in ("7", "10") else [{"actionDate": "2025-01-09", "text": "Referred", "type": "F"}]}
        if path == "/api/committee/house":
            rows = [{"systemCode": "hsag00", "name": "Farms"}, {"systemCode": "hsag01", "name": "Sub", "parent": {"systemCode": "hsag00"}}]
            return {"committees": rows[int(q["offset"]): int(q["offset"]) + int(q["limit"])], "pagination": {"count": 2}}
        if path == "/api/committee/house/hsag00":
            return {"committee": {"history": [{"officialName": "Committee on Agriculture"}]}}
        if path.startswith("/gov/published/"):
            if "mark" in q:
                return {"packages": [{"packageId": "CREC-2025-02-08", "dateIssued": "2025-02-08"}], "nextPage": None}
            return {"packages": [{"packageId": "CREC-2027-01-03", "dateIssued": "2027-01-03"}], "nextPage": f"{here}?mark=1"}
        if path.endswith("/granules"):
            return {"granules": [{"granuleId": "x-PgH228", "title": "RESIGNATION AS MEMBER OF COMMITTEE ON AGRICULTURE"}, {"granuleId": "x-PgH9", "title": "PRAYER"}, {"granuleId": "x-PgH10", "title": "RESIGNATIONS AS MEMBERS OF COMMITTEE ON RULES"}]}
        if path.endswith("/summary"):
            return {"detailsLink": "https://d/x", "download": {"txtLink": f"{root}/letter"}}
        return {"/letter": LETTER, "/pkg/BILLS-119hres7eh/xml/BILLS-119hres7eh.xml": XML, "/cg/119/bills/HRES10/BILLS-hres10ath.htm": TEXT, "/people/legislators-current.yaml": PERSON % ("A1", "Fir"), "/people/legislators-historical.yaml": PERSON % ("B1", "Ash")}.get(path)

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            url = urlsplit(self.path)
            q = {k: v[0] for k, v in parse_qs(url.query).items()}
            asked.append(url.path)
            keyed = url.path.startswith(("/api", "/gov", "/letter"))
            found = None if url.path in gone or (keyed and q.get("api_key") != "k") else page(url.path, q, root)
            body = (found if isinstance(found, str) else json.dumps(found)).encode()
            self.send_response(302 if found is None else 200)
            self.send_header("Location", "/letter?api_key=k")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    root = f"http://127.0.0.1:{server.server_address[1]}"
    threading.Thread(target=server.serve_forever, daemon=True).start()
    monkeypatch.setenv("CONGRESS_GOV_API_KEY", "k")
    monkeypatch.delenv("CONGRESS_LEGISLATORS_PATH", raising=False)
    from seatledger.sources import urls

    yield {api.CONGRESS_API: f"{root}/api", api.GOVINFO_API: f"{root}/gov", urls.GOVINFO: f"{root}/pkg", urls.CONGRESS: f"{root}/cg", live.PEOPLE: f"{root}/people"}, asked, gone
    server.shutdown()


def run(spark, tmp_path, mirrors, *more):
    out = tmp_path / "out.json"
    code = main(["--congress", "119", "--cache", str(tmp_path / "cache"), "--out", str(out), *more], spark, mirrors)
    return code, json.loads(out.read_text()) if out.exists() else None


def test_a_live_run(spark, tmp_path, services, caplog):
    mirrors, asked, gone = services
    code, events = run(spark, tmp_path, mirrors)
    assert code == 0
    xml, text, letter = [e for e in events if e["source_ref"].get("number") == "7"], [e for e in events if e["source_ref"].get("number") == "10"], [e for e in events if e["source_ref"]["type"] == "record"]
    assert len(xml) == 9 and len(text) == 5 and events == xml + text + letter
    assert {e["member_name"]: e["bioguide_id"] for e in xml}["Mr. Fir"] == "A1" and {e["system_code"] for e in xml if e["committee"] == "Committee on Agriculture"} == {"hsag00"}
    assert [(e["committee"], e["member_name"], e["bioguide_id"], e["date"], e["source_ref"]["url"]) for e in letter] == [("Committee on Agriculture", "Ann Fir", "A1", "2025-02-08", "https://d/x")]
    # Titles and dates decide before documents are asked for; the stages of a bill in turn until one is there.
    assert not [p for p in asked if "2027" in p.split("/")[-2] or "hres9" in p or p.endswith("/9/actions") or "hres8" in p or "hsag01" in p or p.endswith("x-PgH9/summary") or p.endswith("x-PgH10/summary")]
    assert [p for p in asked if "hres7" in p] == ["/pkg/BILLS-119hres7eh/xml/BILLS-119hres7eh.xml"]
    tried = [p for p in asked if "res10" in p.lower() and "actions" not in p]
    stages = ["eh", "ath", "enr", "rh", "ih"]
    assert tried == [f"/pkg/BILLS-119hres10{s}/xml/BILLS-119hres10{s}.xml" for s in stages] + [f"/pkg/BILLS-119hres10{s}/html/BILLS-119hres10{s}.htm" for s in stages] + [f"/cg/119/bills/HRES10/BILLS-hres10{s}.htm" for s in stages[:2]]
    # Again: people and committees are kept, all else is asked for again.
    before = len(asked)
    assert run(spark, tmp_path, mirrors, "--source", "resolution")[1] == [{**e} for e in xml + text]
    assert not [p for p in asked[before:] if "people" in p or "committee" in p or "published" in p]


def test_what_fails_is_left_out(spark, tmp_path, services, caplog):
    mirrors, asked, gone = services
    gone |= {"/people/legislators-current.yaml", "/api/committee/house", "/gov/packages/CREC-2025-02-08/granules/x-PgH228/summary"}
    code, events = run(spark, tmp_path, mirrors)
    assert code == 0 and len(events) == 14 and {e["bioguide_id"] for e in events} == {None} == {e["system_code"] for e in events}
    assert all(f"no {what}" in caplog.text for what in ("people", "committees", "letters"))
    with pytest.raises(Exception, match="HTTP Error"):
        run(spark, tmp_path, mirrors, "--source", "record")
    gone.add("/api/bill/119/hres/7/actions")
    with pytest.raises(Exception, match="HTTP Error"):
        run(spark, tmp_path, mirrors, "--source", "resolution")


def test_a_letter_without_text_is_an_event(spark, tmp_path, services):
    mirrors, _, gone = services
    gone.add("/letter")
    events = run(spark, tmp_path, mirrors, "--source", "record", "--no-bioguide", "--no-committee-codes")[1]
    assert [(e["committee"], e["source_ref"]["granule_id"]) for e in events] == [("Committee on Agriculture", "x-PgH228")]


def test_no_key(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.delenv("CONGRESS_GOV_API_KEY", raising=False)
    monkeypatch.setenv("GOVINFO_API_KEY", "g")
    assert run(spark, tmp_path, {})[0] == 2
    assert "CONGRESS_GOV_API_KEY" in capsys.readouterr().err
