"""A changelog of pages that name the next, as a data source: read whole, or as a stream that goes on where it stopped.

    changelog.register(spark, transport)
    spark.readStream.format("changelog").option("start", url).option("since", "...").load()

The offset of the stream is the address of the next page, so a query that is started
again asks for no page twice. Pages follow each other, each known only from the one
before, so they are read one after the other, ``pages`` of them for a batch at most.
The walk ends at a page that fails or isn't JSON (its row tells why), at one without
a next, or at ``most`` pages.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from urllib.parse import urljoin

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from .transport import Answer, TransportError

SCHEMA = "page_no int, page_url string, ok boolean, error string, next_url string, pos int, url string, uuid string, status string, business_name string, changed string"
#: How far the walk goes.
MOST_PAGES = 50


def read_page(transport: Callable[..., Answer], number: int, url: str, token: str, since: str) -> tuple[list[tuple], str | None]:
    """(rows, address of the next page) of a page; since is asked for on the first page only."""
    headers = {"Accept": "application/json"} | ({"Authorization": f"Bearer {token}"} if token else {}) | ({"If-Modified-Since": since} if since and number == 0 else {})

    def failed(why: str) -> tuple[list[tuple], None]:
        return [(number, url, False, why, None, *[None] * 6)], None

    try:
        answer = transport("GET", url, headers, None, True)
    except TransportError as e:
        return failed(f"feed page failed: {e}")
    if answer.status >= 400:
        return failed(f"feed page failed: HTTP {answer.status}")
    try:
        page = json.loads(answer.body)
        items = page.get("items") or []
    except (ValueError, AttributeError):
        return failed("feed page was not JSON")
    following = urljoin(url, page["next_url"]) if page.get("next_url") else None
    rows: list[tuple] = [(number, url, True, None, following, *[None] * 6)]  # the page itself, then its entries
    for pos, item in enumerate(items):
        entry = item.get("_feed_entry") or {}
        told = (item.get("url"), entry.get("uuid") or item.get("id"), entry.get("status"), entry.get("businessName"), entry.get("sistEndret"))
        rows.append((number, url, True, None, following, pos, *(None if x is None else str(x) for x in told)))
    return rows, following


class _Options:
    def __init__(self, options: dict, transport: Callable[..., Answer]) -> None:
        get = options.get
        self.transport, self.start, self.since, self.token = transport, get("start"), get("since", ""), get("token", "")
        self.most, self.pages = int(get("most", MOST_PAGES)), int(get("pages", 4))
        if not self.start:
            raise ValueError("option start: the address of the first page")

    def walk(self, number: int, url: str | None, count: int) -> Iterator[tuple[list[tuple], int, str | None]]:
        """(rows, number and address of the next page) for up to count pages."""
        while url and number < self.most and count:
            rows, url = read_page(self.transport, number, url, self.token, self.since)
            number, count = number + 1, count - 1
            yield rows, number, url


class _Whole(DataSourceReader):
    def __init__(self, options: _Options) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for rows, _, _ in self.options.walk(0, self.options.start, self.options.most):
            yield from rows


class _Stream(SimpleDataSourceStreamReader):
    def __init__(self, options: _Options) -> None:
        self.options = options

    def initialOffset(self) -> dict:  # noqa: N802
        return {"page": 0, "url": self.options.start}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        out: list[tuple] = []
        after = dict(start)
        for rows, number, url in self.options.walk(start["page"], start["url"], self.options.pages):
            out += rows
            after = {"page": number, "url": url}
        return iter(out), after

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        for rows, _, _ in self.options.walk(start["page"], start["url"], end["page"] - start["page"]):
            yield from rows

    def commit(self, end: dict) -> None:
        pass


def register(spark: SparkSession, transport: Callable[..., Answer]) -> None:
    """Make the format ``changelog`` known to the session, over a transport."""

    class Changelog(DataSource):
        @classmethod
        def name(cls) -> str:
            return "changelog"

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema: object) -> DataSourceReader:
            return _Whole(_Options(self.options, transport))

        def simpleStreamReader(self, schema: object) -> SimpleDataSourceStreamReader:  # noqa: N802
            return _Stream(_Options(self.options, transport))

    spark.dataSource.register(Changelog)
