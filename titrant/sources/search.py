"""Paged literature search as a Python data source: one partition per journal, offline unless a transport is given."""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Fetch = Callable[[str], tuple[int, str]]  # query and cursor in, status and body out


class JournalPartition(InputPartition):
    def __init__(self, journal: str, query: str):
        self.journal, self.query = journal, query


def journal_query(issns: list[str], first_year: int, last_year: int) -> str:
    any_issn = " OR ".join(f'ISSN:"{i}"' for i in issns if i)
    return f"({any_issn}) AND OPEN_ACCESS:y AND HAS_FT:y AND FIRST_PDATE:[{first_year}-01-01 TO {last_year}-12-31]"


class ServiceError(RuntimeError):
    """A service that persistently fails: what it would have given is missing, so the run ends."""


def fetched(get: Fetch, what: str, tries: int = 3, wait: Callable[[float], None] = time.sleep) -> dict:
    """JSON from the service; server errors and broken bodies are tried again, twice as long apart each time. Raises :class:`ServiceError`, so that no result is partial without a word."""
    why = "no attempt"
    for attempt in range(1, tries + 1):
        status, body = get(what)
        if status == 200:
            try:
                return json.loads(body)
            except ValueError as e:
                why = f"not JSON: {e}"
        elif status < 500:
            raise ServiceError(f"status {status} for {what}: {body[:200]}")
        else:
            why = f"status {status}"
        if attempt < tries:
            wait(2.0**attempt)
    raise ServiceError(f"{why} after {tries} attempts for {what}")


def search(get: Fetch, query: str, limit: int = 0, wait: Callable[[float], None] = time.sleep) -> Iterator[dict]:
    """Hits page by page, until the cursor is empty or stays, or the limit is reached."""
    cursor, n = "*", 0
    while True:
        page = fetched(get, json.dumps({"query": query, "cursorMark": cursor, "pageSize": 1000}), wait=wait)
        hits = (page.get("resultList") or {}).get("result") or []
        for hit in hits:
            yield hit
            n += 1
            if limit and n >= limit:
                return
        following = page.get("nextCursorMark")
        if not hits or not following or following == cursor:
            return
        cursor = following


def transport(named: str) -> Callable:
    """The function that ``module:function`` names."""
    module, _, function = named.partition(":")
    return getattr(importlib.import_module(module), function)


class LiteratureSource(DataSource):
    """Options: ``journals`` (JSON: name to ISSNs), ``first_year``, ``last_year``, ``limit``, ``transport`` (``module:function``)."""

    @classmethod
    def name(cls) -> str:
        return "literature"

    def schema(self) -> str:
        return "journal string, pmcid string, year string, title string"

    def reader(self, schema) -> DataSourceReader:
        return LiteratureReader(dict(self.options))


class LiteratureReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        journals = json.loads(self.options["journals"])
        return [JournalPartition(j, journal_query(issns, int(self.options.get("first_year", 2017)), int(self.options.get("last_year", 2100)))) for j, issns in journals.items()]

    def read(self, partition):
        for hit in search(transport(self.options["transport"]), partition.query, int(self.options.get("limit", 0))):
            yield partition.journal, hit.get("pmcid"), (hit.get("firstPublicationDate") or "")[:4], (hit.get("title") or "")[:200]
