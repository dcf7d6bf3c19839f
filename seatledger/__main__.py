"""Command line: events of one Congress, from the live services or from a folder of landed payloads.

``python -m seatledger --congress 119`` asks the services, with the key in CONGRESS_GOV_API_KEY; files of people
and committee names are kept in the folder ``--cache``. With ``--landing DIR`` it reads the folders bills,
actions, renditions, committees, committee-details, packages, granules, summaries,
texts and the files legislators*.yaml of DIR; what is missing degrades: names stay
unresolved, codes unfilled, letters out, each with a warning. Folders and files may be in any
store that Spark reads. Exit code 2: no key for the services, or no bills folder where resolutions are asked for.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys
from dataclasses import replace

log = logging.getLogger("seatledger")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="seatledger", description="Committee membership changes of one Congress.")
    p.add_argument("--congress", type=int, required=True)
    p.add_argument("--chamber", choices=("house", "senate"), default="house")
    p.add_argument("--source", choices=("resolution", "record", "all"), default="all", help="kinds of documents; the Senate has resolutions only")
    p.add_argument("--since", help="only documents updated or issued from this ISO date on")
    p.add_argument("--landing", help="folder of landed payloads, instead of the live services")
    p.add_argument("--cache", default=".cache", help="folder in which a live run keeps people and committees (%(default)s)")
    p.add_argument("--out", "--output", dest="output", help="JSON file; an earlier one there keeps its corrections (output/committee_changes_<congress>.json)")
    p.add_argument("--legislators-path", default=os.environ.get("CONGRESS_LEGISLATORS_PATH"), help="YAML file of people, or a folder of them, instead of those in the landing folder")
    p.add_argument("--no-bioguide", action="store_true", help="leave names unresolved")
    p.add_argument("--no-committee-codes", action="store_true", help="leave system codes unfilled")
    p.add_argument("-v", "--verbose", action="store_true")
    return p


def default_output(congress: int, chamber: str) -> str:
    return f"output/committee_changes_{'senate_' if chamber == 'senate' else ''}{congress}.json"


def people_files(spark, path: str | None, folder: str | None) -> list[str]:
    """YAML files of people, by name: ``path`` or what is in it, else those of the landing folder."""
    from .sources.shared import names_in

    if path and path.endswith((".yaml", ".yml")):
        return [path]
    at = path or folder
    return [f"{at.rstrip('/')}/{n}" for n in names_in(spark, at) if n.startswith("legislators") and n.endswith((".yaml", ".yml"))]


def landed(spark, folder: str, chamber: str, people: list[str], codes: bool = True):
    from pyspark.sql import functions as F

    from . import schemas as S
    from .operators import committees
    from .plans.events import Landed
    from .sources import landing
    from .sources.shared import names_in

    held = set(names_in(spark, folder))
    at = lambda name: f"{folder}/{name}" if name in held else None
    read = lambda name, f: f(spark, at(name)) if at(name) else None
    bills = read("bills", landing.bills)
    listed = read("committees", landing.committee_list) if codes else None
    recs = None if listed is None else committees.records(listed.where(F.col("chamber") == chamber).drop("chamber"), read("committee-details", landing.committee_details))
    rend = f"{folder}/renditions/*/*" if at("renditions") else None
    for name, found in (("people", people), ("committees", recs), ("packages", at("packages"))):
        if not found and (name != "packages" or chamber == "house"):
            log.warning("no %s: what needs them stays empty", name)
    return Landed(
        bills=bills, actions=read("actions", landing.actions), renditions=landing.renditions(spark, rend) if rend else None, packages=read("packages", landing.packages), granules=read("granules", landing.granules),
        summaries=spark.read.schema(S.SUMMARY).json(at("summaries")) if at("summaries") else None, texts=spark.read.schema(S.GRANULE_TEXT).json(at("texts")) if at("texts") else None,
        legislators=landing.legislators(spark, people) if people else None, committees=recs,
    )


def main(argv: list[str] | None = None, spark=None, mirrors: dict[str, str] | None = None) -> int:
    """``mirrors``: addresses that are asked instead of those that begin so."""
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO if args.verbose else logging.WARNING, format="%(levelname)s %(message)s")
    from pyspark.sql import SparkSession

    from .plans import events, site
    from .sources import landing, live, sinks
    from .sources.shared import exists, written

    services = None
    if not args.landing:
        try:
            services = replace(live.Services.from_environment(), mirrors=mirrors or {})
        except ValueError as error:
            print(f"error: {error}", file=sys.stderr)
            return 2
    spark = spark or SparkSession.builder.appName("seatledger").getOrCreate()
    if args.no_bioguide:
        people = []
    elif services and not args.legislators_path:
        people = None
    else:
        people = people_files(spark, args.legislators_path, args.landing)
    if services:
        given = live.landed(spark, services, args.congress, args.chamber, args.source, args.since, people, not args.no_committee_codes, args.cache)
    else:
        given = landed(spark, args.landing, args.chamber, people, not args.no_committee_codes)
        if given.bills is None and (args.chamber == "senate" or args.source != "record"):
            print("no bills in the landing folder", file=sys.stderr)
            return 2
    output = args.output or default_output(args.congress, args.chamber)
    previous = landing.previous_events(spark, output) if exists(spark, output) else None
    found = written(events.collect(given, args.congress, args.chamber, args.source, args.since, previous), "events")
    s = site.summary(found).first()
    sinks.export_events(found, output)
    print(f"{s['total']} events: {s['additions']} additions, {s['removals']} removals, {s['missing']} without a person")
    return 0


if __name__ == "__main__":
    sys.exit(main())
