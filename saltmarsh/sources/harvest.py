"""Harvesting sources as a Spark Python data source, with an injectable transport.

`spark.dataSource.register(HarvestSource)`, then
`spark.read.format("harvest").option("plan", json).option("transport", "module:function").load()`.

The plan is a list of {source, intent, query}; each source becomes one partition, so its intents and pages are
walked by one task at the source's own pace (`delay` seconds between requests). The transport takes
(source, request) and returns decoded JSON (for PubMed: ids, then one XML text an article) or None on
failure; nothing here opens a connection by itself. An intent that fails yields one row with the error
in `status` instead of ending the job.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Transport = Callable[[str, dict], object]
SCHEMA = "source string, intent string, page int, record int, payload string, status string"
TRIES = 3


@dataclass(frozen=True)
class Paging:
    """How a source is walked: items per page, where the items, the total and the next cursor are, and limits."""

    size: int
    items: tuple[str, ...]
    cursor: tuple[str, ...] = ()
    start: str | None = None
    total: tuple[str, ...] = ()
    most: int | None = None
    short_page: int = 0
    delay: float = 0.1
    needs_key: bool = False


# How each source pages
PAGING = {
    "openalex": Paging(200, ("results",), ("meta", "next_cursor"), "*", delay=1 / 9),
    "semantic_scholar": Paging(100, ("data",), total=("total",), most=10_000, delay=1 / 9),
    "crossref": Paging(1000, ("message", "items"), ("message", "next-cursor"), "*", short_page=20, delay=1 / 20),
    "pubmed": Paging(200, ("articles",), total=("total",), most=100_000, delay=1 / 3),
    "europe_pmc": Paging(1000, ("resultList", "result"), ("nextCursorMark",), "*", delay=1 / 8),
    "core": Paging(100, ("results",), total=("totalHits",), most=10_000, delay=1 / 5, needs_key=True),
    "lens": Paging(1000, ("data",), ("scroll_id",), None, total=("total",), delay=1 / 5, needs_key=True),
}


def at(data: object, path: tuple[str, ...]) -> object:
    """The value at a path of keys, None where it ends early."""
    for k in path:
        data = data.get(k) if isinstance(data, dict) else None
    return data


def patient(transport: Transport, source: str, request: dict, delay: float, tries: int = TRIES, sleep: Callable[[float], None] = time.sleep) -> object:
    """The answer after a pause, or None after so many failures."""
    for _ in range(tries):
        sleep(delay)
        try:
            found = transport(source, request)
        except Exception:  # whatever a transport raises is a failed try
            found = None
        if found is not None:
            return found
    return None


def pages(source: str, query: object, transport: Transport, key: str | None = None, sleep: Callable[[float], None] = time.sleep) -> Iterator[list]:
    """The items of each page until the source's own sign of the end."""
    p = PAGING[source]
    if p.needs_key and not key:
        return
    cursor, offset = p.start, 0
    while True:
        request = {"query": query, "size": p.size, "key": key, **({"cursor": cursor} if p.cursor else {"offset": offset})}
        data = patient(transport, source, request, p.delay, sleep=sleep)
        if data is None:
            raise OSError(f"{source}: no answer")
        items = at(data, p.items) or []
        if not items:
            return
        yield items
        offset += len(items) if p.cursor else p.size
        if p.cursor:
            following = at(data, p.cursor)
            if not following or (following == cursor and source != "lens") or len(items) < p.short_page:
                return
            cursor = following
        if p.total and offset >= min(at(data, p.total) or 0, p.most or 1 << 62):
            return


class _Source(InputPartition):
    """All intents of one source: its pace holds over them, as they are asked one after another in one task."""

    def __init__(self, source: str, intents: list[tuple[str, object]]):
        self.source, self.intents = source, intents


class HarvestReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.plan = json.loads(options["plan"])
        self.transport = options["transport"]
        self.keys = json.loads(options.get("keys", "{}"))

    def partitions(self) -> list[_Source]:
        by_source: dict[str, list] = {}
        for x in self.plan:
            by_source.setdefault(x["source"], []).append((x["intent"], x["query"]))
        return [_Source(s, intents) for s, intents in by_source.items()]

    def read(self, own: _Source) -> Iterator[tuple]:
        module, _, name = self.transport.partition(":")
        transport = getattr(importlib.import_module(module), name)
        for intent, query in own.intents:
            page = -1
            try:
                for page, items in enumerate(pages(own.source, query, transport, self.keys.get(own.source))):
                    for n, item in enumerate(items):
                        yield own.source, intent, page, n, item if isinstance(item, str) else json.dumps(item), "ok"
            except Exception as e:  # one failed intent must not end the harvest
                yield own.source, intent, page + 1, None, None, f"failed: {e}"


class HarvestSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "harvest"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> HarvestReader:
        return HarvestReader(self.options)
