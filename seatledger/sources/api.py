"""Live pages of the publishers' services as a Python data source.

``format("congress_api")`` lists items as (page, pos, item). Lists that count their items
are read by offset, a partition for each page; lists that hand out the address of their
next page can only be read in turn, in one partition. The key comes from the options, or
from the environment on the driver, and is added to every address.
"""

from __future__ import annotations

import json
import os
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# The services, the variables that hold their key, and their page sizes.
CONGRESS_API, GOVINFO_API = "https://api.congress.gov/v3", "https://api.govinfo.gov"
KEY_NAMES = {"congress": ("CONGRESS_GOV_API_KEY",), "govinfo": ("CONGRESS_GOV_API_KEY", "GOVINFO_API_KEY")}
PAGE_SIZES = {"congress": 250, "govinfo": 100}


def key_of(service: str, environment: dict[str, str] | None = None) -> str:
    """The service's key; ValueError where the environment has none."""
    held = os.environ if environment is None else environment
    for name in KEY_NAMES[service]:
        if held.get(name):
            return held[name]
    raise ValueError(f"none of {', '.join(KEY_NAMES[service])} is set")


def address(url: str, **parameters: object) -> str:
    """``url`` with parameters added to those it has; one that is there is replaced, a null one is left out."""
    parts = urllib.parse.urlsplit(url)
    query = dict(urllib.parse.parse_qsl(parts.query)) | {k: str(v) for k, v in parameters.items() if v is not None}
    return urllib.parse.urlunsplit(parts._replace(query=urllib.parse.urlencode(query)))


class _Still(urllib.request.HTTPRedirectHandler):
    """An address that has moved is one that is not there."""

    def redirect_request(self, *_):
        return None


def get(url: str, timeout: float = 30.0) -> bytes:
    """The body of ``url``; any status but 200 is an error."""
    asked = urllib.request.Request(url, headers={"User-Agent": "seatledger"})
    with urllib.request.build_opener(_Still).open(asked, timeout=timeout) as answer:
        if answer.status != 200:
            raise urllib.error.HTTPError(url, answer.status, "not 200", answer.headers, None)
        return answer.read()


def get_or_none(url: str, timeout: float = 30.0) -> bytes | None:
    """The body, or None where the server says that there is none."""
    try:
        return get(url, timeout)
    except urllib.error.HTTPError:
        return None


def bills_url(congress: int, bill_type: str = "hres", since: str | None = None) -> str:
    return address(f"{CONGRESS_API}/bill/{congress}/{bill_type}", format="json", sort="updateDate+desc", fromDateTime=None if since is None else f"{since}T00:00:00Z")


def actions_url(congress: int, bill_type: str, number: str) -> str:
    return address(f"{CONGRESS_API}/bill/{congress}/{bill_type}/{number}/actions", format="json", limit=PAGE_SIZES["congress"])


def committees_url(chamber: str = "house") -> str:
    return address(f"{CONGRESS_API}/committee/{chamber}", format="json")


def committee_url(chamber: str, code: str) -> str:
    return address(f"{CONGRESS_API}/committee/{chamber}/{code}", format="json")


def packages_url(start: str, end: str) -> str:
    return address(f"{GOVINFO_API}/published/{start}/{end}", collection="CREC", offsetMark="*")


def granules_url(package: str) -> str:
    return address(f"{GOVINFO_API}/packages/{package}/granules", offsetMark="*")


def granule_url(package: str, granule: str) -> str:
    return f"{GOVINFO_API}/packages/{package}/granules/{granule}/summary"


class ApiReader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.items, self.key = options["url"], options["items"], options.get("key")
        self.size, self.timeout = int(options.get("pageSize", 250)), float(options.get("timeout", 30))
        self.by_offset = options.get("paging", "offset") == "offset"

    def _page(self, url: str) -> dict:
        return json.loads(get(address(url, api_key=self.key), self.timeout))

    def partitions(self) -> list[InputPartition]:
        """Number of the page, its address, and whether the pages after it are read with it."""
        if self.by_offset:
            count = (self._page(address(self.url, offset=0, limit=1)).get("pagination") or {}).get("count")
            if count is not None:
                return [InputPartition((k, address(self.url, offset=k * self.size, limit=self.size), False)) for k in range(-(-int(count) // self.size))]
        first = address(self.url, offset=0, limit=self.size) if self.by_offset else address(self.url, pageSize=self.size)
        return [InputPartition((0, first, True))]

    def read(self, partition: InputPartition) -> Iterator[tuple[int, int, str]]:
        number, url, onward = partition.value
        while url:
            page = self._page(url)
            found = page.get(self.items) or []
            for pos, item in enumerate(found):
                yield number, pos, json.dumps(item)
            following = (page.get("pagination") or {}).get("next") or page.get("nextPage")
            url = following if onward and found else None
            number += 1


class ApiSource(DataSource):
    """Options: url, items (name of the list in a page), paging (offset or cursor), pageSize, key, timeout."""

    @classmethod
    def name(cls) -> str:
        return "congress_api"

    def schema(self) -> str:
        return "page long, pos long, item string"

    def reader(self, schema) -> ApiReader:
        return ApiReader(self.options)
