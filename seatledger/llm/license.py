"""License scans by ordered signature rules.

Several hundred regular expressions (:mod:`license_rules`), each with a keyword
and a priority. Texts are lowered in A-Z and white space is folded, a run of it
to one space, or to one line break if it holds one. One Aho-Corasick pass finds
the keywords; a rule runs only if its keyword occurs, and only around it: every
rule but the one for SPDX tags has a bounded width, below ``REACH``, so the
windows hold all that a scan of the whole text would find. An SPDX tag is read
to the end of its line, whatever its length. Detections that another one
contains are dropped when that one has at least their priority.

Beside the rules, the base phrases (consecutive words) are looked up exactly.

Defined results: null and empty texts have no words, no detections, score 0;
repeated rows are scanned one by one; other columns are ignored. Texts are
scanned whole, whatever their length.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, utf8
from .license_rules import FAMILIES, SENTENCES

# Word characters: digits, a-z and everything from \x80 on; A-Z is lowered; the rest parts words.
_TABLE = bytes((c + 32) if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

# The base phrases and their labels.
BASE_PHRASES = ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl"))

#: No rule matches more characters of folded text; a test holds every pattern to it.
REACH = 400
SPDX_TAG = "spdx-license-identifier:"
_RUN = re.compile(r"[ \t\n\x0b\x0c\r]{2,}|[\t\x0b\x0c\r]")
_IDENTIFIER = re.compile(r"[a-z0-9][-.+a-z0-9]*")


@dataclass(frozen=True)
class Signature:
    label: str
    keyword: str
    pattern: str
    priority: int
    weight: float


def spdx_ids() -> dict[str, str]:
    """Label of each SPDX identifier, in lower case."""
    return {spdx.lower(): label for label, ids, _, _ in FAMILIES for spdx in ids.split()}


def signatures() -> tuple[Signature, ...]:
    """The rules in order of priority; forms of one family differ in how sure they are."""
    version = r"(?:,? (?:version |v\.? ?)?\d{1,3}(?:\.\d{1,3}){0,3})?"
    out = [Signature(label, spdx, rf"(?<![-.\w]){re.escape(spdx)}(?![-\w])(?!\.\w)", 70, 0.9) for spdx, label in spdx_ids().items() if "-" in spdx]
    for label, _, names, address in FAMILIES:
        out.append(Signature(label, address, re.escape(address), 80, 0.95))
        out.append(Signature(label, "licen", rf"\b(?:{names})[ \-]licen[sc]e\b{version}", 60, 0.85))
        out.append(Signature(label, "licen", rf"\b(?:licen[sc]ed|released|distributed|available|published) under (?:the |an? )?(?:terms of the )?(?:{names})\b(?: licen[sc]e)?{version}", 65, 0.9))
        out.append(Signature(label, "licen", rf"\blicen[sc]e ?[:=] ?[\"']?(?:the )?(?:{names})\b", 62, 0.85))
    for label, keyword, pattern in SENTENCES:
        own = label not in ("copyright", "proprietary", "public-domain")
        out.append(Signature(label, keyword, pattern, 75 if own else 20, 0.95 if own else 0.3))
    return tuple(sorted(out, key=lambda s: (-s.priority, s.label, s.pattern)))


def flexible(pattern: str) -> str:
    """``pattern`` with each space standing for folded white space of either kind."""
    parts = re.split(r"(\[(?:\\.|[^\]\\])*\])", pattern)
    return "".join(p.replace(" ", "\n ") if k % 2 else p.replace("\\ ", " ").replace(" ", "[ \n]") for k, p in enumerate(parts))


def matcher():
    """The compiled rules, the automaton of their keywords, and the SPDX identifiers."""
    import ahocorasick

    rules = [(s, re.compile(flexible(s.pattern))) for s in signatures()]
    auto, by_keyword = ahocorasick.Automaton(), {SPDX_TAG: [-1]}
    for i, (s, _) in enumerate(rules):
        # A keyword may be broken at the end of a line, so its longest word finds it.
        by_keyword.setdefault(max(s.keyword.split(" "), key=len), []).append(i)
    for keyword, ids in by_keyword.items():
        auto.add_word(keyword, ids)
    auto.make_automaton()
    return rules, auto, spdx_ids()


class Folded:
    """A text lowered in A-Z with white space folded, and the way back to the places of the text."""

    def __init__(self, text: str):
        self.lower = utf8(text).lower().decode("utf-8", "surrogatepass")
        self.text = _RUN.sub(lambda m: "\n" if "\n" in m[0] else " ", self.lower)
        self._ends: list[int] | None = None

    def place(self, at: int) -> int:
        """Where the character ``at`` of the folded text stands in the text."""
        if self._ends is None:
            self._ends, self._lost, lost = [], [], 0
            for m in _RUN.finditer(self.lower):
                if len(m[0]) > 1:
                    lost += len(m[0]) - 1
                    self._ends.append(m.end() - lost)
                    self._lost.append(lost)
        k = bisect_right(self._ends, at)
        return at + (self._lost[k - 1] if k else 0)


Found = tuple[int, int, str, int, float]


def _tagged(text: str, starts: list[int], ids: dict[str, str]) -> Iterator[Found]:
    """Known identifiers behind an SPDX tag, up to the end of its line."""
    done = 0
    for at in starts:
        if at < done:
            continue
        # The expression may begin on the line after the tag.
        end = text.find("\n", at + (text[at : at + 1] == "\n"))
        done = len(text) if end < 0 else end
        for m in _IDENTIFIER.finditer(text, at, done):
            name = m[0] if m[0] in ids else m[0].rstrip("+.-")
            if name in ids:
                yield m.start(), m.start() + len(name), ids[name], 90, 1.0


def candidates(text: str, tools) -> list[Found]:
    """Every match of every rule in the folded ``text``."""
    rules, auto, ids = tools
    windows: dict[int, list[list[int]]] = {}
    tags = []
    for end, own_rules in auto.iter(text):
        lo, hi = max(0, end - REACH), end + REACH
        for i in own_rules:
            if i < 0:
                tags.append(end + 1)
                continue
            own = windows.setdefault(i, [])
            if own and lo <= own[-1][1]:
                own[-1][1] = hi
            else:
                own.append([lo, hi])
    found = list(_tagged(text, tags, ids))
    for i, spans in windows.items():
        s, rx = rules[i]
        for lo, hi in spans:
            found += [(m.start(), m.end(), s.label, s.priority, s.weight) for m in rx.finditer(text, lo, min(hi, len(text)))]
    return found


def suppress(found: list[Found]) -> list[Found]:
    """What stands, by start: a detection goes if one that contains it has its priority or more, or one that it contains has more."""
    # By start, longer first: whatever contains a detection comes before it.
    found = sorted(found, key=lambda d: (d[0], -d[1], -d[3], d[2]))
    kept: list[Found] = []
    open_: list[Found] = []
    for d in found:
        open_ = [o for o in open_ if o[1] > d[0]]
        if not any(o[1] >= d[1] and o[3] >= d[3] for o in open_):
            kept.append(d)
            open_.append(d)
    inside = lambda d: kept[bisect_left(kept, (d[0],)) : bisect_right(kept, (d[1],))]
    return [d for d in kept if not any(o is not d and d[0] <= o[0] and o[1] <= d[1] and o[3] > d[3] for o in inside(d))]


def detect(text: str, tools) -> list[Found]:
    """start, end, label, priority, weight of what stands after suppression, by start, in characters of ``text``."""
    folded = Folded(text)
    return [(folded.place(d[0]), folded.place(d[1] - 1) + 1, *d[2:]) for d in suppress(candidates(folded.text, tools))]


def phrases(words: list[bytes]) -> tuple[list[int], set[str]]:
    """Starts of the base phrases, one for each place, and their labels."""
    starts, labels = [], set()
    at = -1
    for _ in range(words.count(b"license")):
        at = words.index(b"license", at + 1)
        for phrase, label in BASE_PHRASES:
            n = len(phrase)
            if at >= n - 1 and all(words[at - n + 1 + k] == p.encode() for k, p in enumerate(phrase)):
                starts.append(at - n + 1)
                labels.add(label)
    return starts, labels


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<start:int,end:int,label:string>>"


def scan_text(text: str | None, tools) -> dict:
    data = utf8(text).translate(_TABLE)
    # A long text is cut into words only if a phrase can be in it; counting needs no list of them.
    words = data.split()
    starts, base = phrases(words) if b"license" in data else ([], set())
    found = detect(text or "", tools)
    labels = base | {d[2] for d in found}
    miss = 1.0
    for w in [d[4] for d in found] + [0.85] * len(starts):
        miss *= 1.0 - min(w, 0.999)
    return {
        "n_words": len(words), "n_base": len(starts), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)), "score": 1.0 - miss,
        "detections": [{"start": d[0], "end": d[1], "label": d[2]} for d in found],
    }


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: the columns of ``SCHEMA``; ``detections`` are offsets in characters of the text."""
    def make():
        tools = matcher()
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string())]))
        types = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("detections", kind)]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [scan_text(t, tools) for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array([r[n] for r in rows], t) for n, t in types], names=["doc_id"] + [n for n, _ in types])

        return step

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), make, SCHEMA)
