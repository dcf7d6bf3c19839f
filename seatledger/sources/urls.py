"""Identifiers and addresses of documents. The formats are fixed values of the publishers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GOVINFO, CONGRESS = "https://www.govinfo.gov/content/pkg", "https://www.congress.gov"


def package_id(congress: Column, number: Column, stage: Column, bill_type: str = "hres") -> Column:
    return F.concat(F.lit("BILLS-"), congress.cast("string"), F.lit(bill_type), number, stage)


def xml_url(package: Column) -> Column:
    return F.concat(F.lit(f"{GOVINFO}/"), package, F.lit("/xml/"), package, F.lit(".xml"))


def html_url(package: Column) -> Column:
    """A full address passes through."""
    return F.when(package.rlike("^https?://"), package).otherwise(F.concat(F.lit(f"{GOVINFO}/"), package, F.lit("/html/"), package, F.lit(".htm")))


def congress_text_url(congress: Column, number: Column, stage: Column, bill_type: str = "hres") -> Column:
    return F.concat(F.lit(f"{CONGRESS}/"), congress.cast("string"), F.lit(f"/bills/{bill_type.upper()}"), number, F.lit(f"/BILLS-{bill_type}"), number, stage, F.lit(".htm"))


def bill_url(congress: Column, number: Column, chamber: str = "house") -> Column:
    """The ordinal is always written with 'th', as the links are."""
    return F.concat(F.lit(f"{CONGRESS}/bill/"), congress.cast("string"), F.lit(f"th-congress/{chamber}-resolution/"), number)


def package_url(package: Column) -> Column:
    return F.concat(F.lit("https://www.govinfo.gov/app/details/"), package)
