"""The input tables from the live services: lists by page, then documents of what the lists and their titles leave.

Lists come from the ``congress_api`` source. Whatever has an address of its own (actions, committees,
granules, texts) is asked for in tasks, a row at a time, ``requests`` tasks side by side; filters on
titles and dates run before any document is asked for. Each table is written to the shared folder as it
arrives, so an address is asked for once, and again only by a task whose executor was lost.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import patterns as P
from ..operators import classify, committees
from ..plans.events import BILL, Landed
from . import api, landing, urls
from .shared import exists, put, written

log = logging.getLogger(__name__)

# Where files of people are published, and their names.
PEOPLE, PEOPLE_FILES = "https://unitedstates.github.io/congress-legislators", ("legislators-current.yaml", "legislators-historical.yaml")


@dataclass(frozen=True)
class Services:
    """Keys, and what is asked instead: ``mirrors`` maps the beginning of an address to another one."""

    key: str
    record_key: str | None = None
    mirrors: dict[str, str] = field(default_factory=dict)
    requests: int = 8
    timeout: float = 30.0

    @classmethod
    def from_environment(cls, environment: dict[str, str] | None = None) -> Services:
        """ValueError where there is no key for the bills; one for the record may be missing."""
        key = api.key_of("congress", environment)
        return cls(key, api.key_of("govinfo", environment))

    def at(self, url: str) -> str:
        for there, instead in self.mirrors.items():
            if url.startswith(there):
                return instead + url[len(there):]
        return url


def listed(spark: SparkSession, services: Services, url: str, items: str, item: str) -> DataFrame:
    """page, pos and the fields of ``item`` for every item of a list that counts its items."""
    spark.dataSource.register(api.ApiSource)
    options = {"url": services.at(url), "items": items, "key": services.key, "pageSize": api.PAGE_SIZES["congress"], "timeout": services.timeout}
    rows = spark.read.format("congress_api").options(**options).load()
    return rows.select("page", "pos", F.from_json("item", item).alias("i")).select("page", "pos", "i.*")


def asked(df: DataFrame, services: Services, ask: Callable[[dict], list[dict]], schema: str) -> DataFrame:
    """The rows that ``ask`` gives for each row; rows are dealt to ``requests`` tasks."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.to_dict("records"):  # one answer at a time, whatever the batch
                yield pd.DataFrame(ask(row), columns=names, dtype=object)

    return df.repartition(services.requests).mapInPandas(run, schema)


def _json(services: Services, url: str, key: str) -> dict:
    return json.loads(api.get(api.address(services.at(url), api_key=key), services.timeout))


def _paged(services: Services, url: str, items: str) -> Iterator[dict]:
    """Items of a list whose pages name the next one."""
    url = api.address(url, pageSize=api.PAGE_SIZES["govinfo"])
    while url:
        page = _json(services, url, services.record_key)
        yield from page.get(items) or []
        url = page.get("nextPage")


def bills(spark: SparkSession, services: Services, congress: int, bill_type: str, since: str | None = None) -> DataFrame:
    """As :func:`landing.bills`, of the bills whose titles tell of committees."""
    found = listed(spark, services, api.bills_url(congress, bill_type, since), "bills", "number string, title string, updateDate string")
    rows = found.select(
        F.lit(congress).alias("congress"), F.lit(bill_type).alias("bill_type"), "number", F.coalesce("title", F.lit("")).alias("title"), (F.col("page") * 1_000_000 + F.col("pos")).alias("api_pos"), F.col("updateDate").alias("update_date"),
    )
    return (classify.house_bills(rows) if bill_type == "hres" else classify.senate_bills(rows)).select(*rows.columns)


def actions(bills_: DataFrame, services: Services) -> DataFrame:
    """As :func:`landing.actions`, for ``bills_``."""

    def ask(row: dict) -> list[dict]:
        page = _json(services, api.actions_url(row["congress"], row["bill_type"], row["number"]), services.key)
        return [{k: row[k] for k in BILL} | {"actions": json.dumps(page.get("actions") or [])}]

    rows = asked(bills_.select(*BILL), services, ask, "congress int, bill_type string, number string, actions string")
    return rows.select(*BILL, F.from_json("actions", f"array<{S.ACTION}>").alias("actions"))


def addresses(bill_type: str) -> Column:
    """The addresses of a bill's text in the order in which they are tried: XML by stage, text by stage, text of the other host by stage."""
    stages = P.HOUSE_STAGES if bill_type == "hres" else P.SENATE_STAGES
    package = lambda s: urls.package_id(F.col("congress"), F.col("number"), F.lit(s), bill_type)
    one = lambda host, s, kind, url: F.struct(F.lit(host).alias("host"), F.lit(s).alias("stage"), F.lit(kind).alias("format"), url.alias("url"))
    return F.array(
        *[one("govinfo", s, "xml", urls.xml_url(package(s))) for s in stages], *[one("govinfo", s, "text", urls.html_url(package(s))) for s in stages],
        *[one("congress", s, "text", urls.congress_text_url(F.col("congress"), F.col("number"), F.lit(s), bill_type)) for s in stages],
    )


def renditions(bills_: DataFrame, services: Services, bill_type: str) -> DataFrame:
    """The first text of each of ``bills_`` that is there, as :func:`landing.renditions`."""

    def ask(row: dict) -> list[dict]:
        for option in row["options"]:
            body = api.get_or_none(services.at(option["url"]), services.timeout)
            if body is not None:
                return [{k: row[k] for k in BILL} | {k: option[k] for k in ("host", "stage", "format")} | {"body": body.decode("utf-8", "replace")}]
        return []

    return asked(bills_.select(*BILL, addresses(bill_type).alias("options")), services, ask, S.RENDITIONS)


def committee_records(spark: SparkSession, services: Services, chamber: str) -> DataFrame:
    """Committees of a chamber with their earlier names; each committee's own page has its history."""
    found = listed(spark, services, api.committees_url(chamber), "committees", "systemCode string, name string, parent struct<systemCode:string>")
    rows = written(found.select((F.col("page") * 1_000_000 + F.col("pos")).cast("int").alias("rec_pos"), "systemCode", "name", F.col("parent.systemCode").alias("parent")), "committees")

    def ask(row: dict) -> list[dict]:
        detail = _json(services, api.committee_url(chamber, row["systemCode"]), services.key).get("committee") or {}
        return [{"systemCode": row["systemCode"], "history": json.dumps(detail.get("history") or [])}]

    top = rows.where("parent is null and coalesce(systemCode, '') <> ''").select("systemCode").distinct()
    past = asked(top, services, ask, "systemCode string, history string").select("systemCode", F.from_json("history", "array<struct<officialName:string,libraryOfCongressName:string>>").alias("history"))
    return committees.records(rows, past)


def letters(spark: SparkSession, services: Services, start: str, end: str) -> dict[str, DataFrame]:
    """packages, granules, summaries and texts of the letters in issues from ``start`` up to ``end``."""
    if services.record_key is None:
        raise ValueError("no key for the record")
    begin = spark.range(1).select(F.lit(api.packages_url(start, end)).alias("url"))
    issues = written(asked(begin, services, lambda row: [{k: p.get(k) for k in ("packageId", "dateIssued")} for p in _paged(services, row["url"], "packages")], "packageId string, dateIssued string"), "packages")

    def granules_of(row: dict) -> list[dict]:
        return [{"packageId": row["packageId"], "pos": k, "granuleId": g.get("granuleId"), "title": g.get("title")} for k, g in enumerate(_paged(services, api.granules_url(row["packageId"]), "granules"))]

    within = issues.where((F.col("dateIssued") >= start) & (F.col("dateIssued") < end))
    every = asked(within.select("packageId").distinct(), services, granules_of, "packageId string, pos long, granuleId string, title string")
    found = written(every.where(classify.is_resignation(F.col("title"))), "granules")

    def letter(row: dict) -> list[dict]:
        """The summary must be there; a text may be missing."""
        summary = _json(services, api.granule_url(row["packageId"], row["granuleId"]), services.record_key)
        link = (summary.get("download") or {}).get("txtLink")
        body = api.get_or_none(api.address(services.at(link), api_key=services.record_key), services.timeout) if link else None
        return [{"granuleId": row["granuleId"], "detailsLink": summary.get("detailsLink"), "body": None if body is None else body.decode("utf-8", "replace")}]

    wanted = found.where(~classify.has_several_signers(F.col("title"))).select("packageId", "granuleId").distinct()
    read = written(asked(wanted, services, letter, "granuleId string, detailsLink string, body string"), "letters")
    return {"packages": issues, "granules": found, "summaries": read.select("granuleId", "detailsLink"), "texts": read.select("granuleId", "body")}


def people_files(spark: SparkSession, services: Services, folder: str) -> list[str]:
    """The published files of people in ``folder``, in any store; what is not there is fetched, and appears whole or not at all."""
    out = [f"{folder.rstrip('/')}/{name}" for name in PEOPLE_FILES]
    for name, path in zip(PEOPLE_FILES, out, strict=True):
        if not exists(spark, path):
            log.info("fetching %s", name)
            put(spark, path, api.get(services.at(f"{PEOPLE}/{name}"), 2 * services.timeout))
    return out


def landed(
    spark: SparkSession, services: Services, congress: int, chamber: str = "house", source: str = "all", since: str | None = None, people: list[str] | None = None, codes: bool = True, cache: str = ".cache",
) -> Landed:
    """All input of :func:`events.collect`. ``people``: YAML files, None for the published ones, empty for none.

    Bills must be had. People, committees and, beside bills, letters may fail: a warning, and what needs them stays empty.
    """

    def tried(what: str, make: Callable[[], object]):
        try:
            return make()
        except Exception as error:
            log.warning("no %s: %s", what, str(error)[:300])
            return None

    given: dict[str, DataFrame] = {}
    if chamber == "senate" or source in ("resolution", "all"):
        bill_type = "sres" if chamber == "senate" else "hres"
        given["bills"] = written(bills(spark, services, congress, bill_type, since), "bills")
        given["actions"] = written(actions(given["bills"], services), "actions")
        wanted = given["bills"]
        if chamber == "house":  # what was not agreed to has no events
            wanted = wanted.join(given["actions"].where(classify.agreed_date(F.col("actions")).isNotNull()), BILL, "left_semi")
        given["renditions"] = written(renditions(wanted, services, bill_type), "renditions")
    if chamber == "house" and source in ("record", "all"):
        span = (since or f"{1789 + (congress - 1) * 2}-01-03", f"{1789 + congress * 2}-01-03")
        got = letters(spark, services, *span) if source == "record" else tried("letters", lambda: letters(spark, services, *span))
        given |= got or {}
    if people is None or people:
        given["legislators"] = tried("people", lambda: landing.legislators(spark, people_files(spark, services, cache) if people is None else people))
    if codes:
        path = f"{cache.rstrip('/')}/committees-{chamber}.parquet"
        given["committees"] = tried("committees", lambda: landing.cached_records(spark, path, lambda: committee_records(spark, services, chamber)))
    return Landed(**given)
