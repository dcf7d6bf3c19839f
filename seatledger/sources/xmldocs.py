"""Resolution XML as a source of blocks: one walk per document, text logic stays in SQL.

A document that is not well-formed gives one row with its error and no block,
so bad input is set aside and never ends a job.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

META = "title string, xml_congress string, xml_type string, xml_number string, stage string, doc_date string, error string"
BLOCKS = "array<struct<kind:int,header:string,code:string,texts:array<string>>>"
#: Kinds of blocks, in the order in which a document's are read.
APPOINTMENT, JOINT, ENUMERATED = 0, 1, 2
_DOCTYPE = re.compile(r"<!DOCTYPE[^>\[]*(?:\[[^\]]*\])?[^>]*>")
_ENTITY = re.compile(r"&(?!(?:amp|lt|gt|quot|apos|#\d+|#x[0-9A-Fa-f]+);)(\w+);")


def _name(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""


def _first(e: ET.Element | None, name: str) -> ET.Element | None:
    return None if e is None else next((x for x in e.iter() if x is not e and _name(x) == name), None)


def _text(e: ET.Element | None) -> str:
    return "" if e is None else "".join(e.itertext())


def _character(m: re.Match) -> str:
    from html.entities import html5

    return html5.get(m[1] + ";", "")


def walk(body: str | None) -> dict:
    """Metadata and blocks of one document."""
    out: dict = {"title": None, "xml_congress": None, "xml_type": None, "xml_number": None, "stage": None, "doc_date": None, "error": None, "blocks": []}
    try:
        root = ET.fromstring(_ENTITY.sub(_character, _DOCTYPE.sub("", body or "", count=1)))
    except ET.ParseError as error:
        return out | {"error": str(error)}
    out["title"] = _text(_first(root, "official-title")) or None
    if m := re.match(r"\s*(\d+)\s+([A-Z]+)\s+(\d+)", _text(_first(root, "title"))):
        out["xml_congress"], out["xml_type"], out["xml_number"] = m.groups()
    if out["xml_congress"] is None and (m := re.match(r"\s*(\d+)", _text(_first(root, "congress")))):
        out["xml_congress"] = m[1]
    if out["xml_number"] is None and (m := re.search(r"(\d+)\s*$", _text(_first(root, "legis-num")))):
        out["xml_number"] = m[1]
    resolution = root if _name(root) == "resolution" else _first(root, "resolution")
    out["stage"] = None if resolution is None else resolution.get("resolution-stage")
    action = _first(root, "action-date")
    out["doc_date"] = None if action is None else action.get("date")
    add = lambda kind, header, code, texts: out["blocks"].append({"kind": kind, "header": header, "code": code, "texts": texts})

    def visit(e: ET.Element, section: ET.Element | None, subsection: bool) -> None:
        name = _name(e)
        if name == "committee-appointment-paragraph":
            header = _first(e, "header")
            if header is not None:
                # Only a name inside the header names the committee.
                inner = _first(header, "committee-name")
                add(APPOINTMENT, _text(header if inner is None else inner), None if inner is None else inner.get("committee-id"), [_text(_first(e, "text"))])
        elif name == "subsection":
            header, intro = _first(e, "header"), _first(e, "text")
            if header is not None and "elect" in _text(intro).lower():
                texts = [_first(p, "text") for p in e.iter() if _name(p) == "paragraph"]
                add(JOINT, _text(header), None, [_text(t) for t in texts if t is not None])
        elif name == "paragraph" and not subsection:
            header, text = _first(e, "header"), _first(e, "text")
            if header is not None and text is not None and "elect" in _text(_first(section, "text")).lower():
                add(ENUMERATED, _text(header), None, [_text(text)])
        for child in e:
            visit(child, e if name == "section" else section, subsection or name == "subsection")

    visit(root, None, False)
    out["blocks"].sort(key=lambda b: b["kind"])
    return out


def read(docs: DataFrame, body: str = "body") -> DataFrame:
    """``docs`` with the metadata columns and ``blocks`` in place of ``body``."""
    kept = [c for c in docs.columns if c != body]
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("header", pa.string()), ("code", pa.string()), ("texts", pa.list_(pa.string()))]))
    names = [c.split()[0] for c in META.split(", ")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema] + [META, f"blocks {BLOCKS}"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [walk(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            cols = list(batch.columns[:-1]) + [pa.array([r[n] for r in rows], pa.string()) for n in names] + [pa.array([r["blocks"] for r in rows], kind)]
            yield pa.RecordBatch.from_arrays(cols, names=kept + names + ["blocks"])

    return docs.select(*kept, F.col(body)).mapInArrow(run, schema)
