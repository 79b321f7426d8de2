"""Transports without a network: answers made from the question alone, for dry runs and tests of what asks services."""

from __future__ import annotations

import hashlib
import json
import re

PAGE = 7


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def pages(what: str) -> tuple[int, str]:
    """A search service: a journal with the ISSN ``<n>-000x`` has ``n`` hits, ``PAGE`` at a time. The cursor is the number of hits given so far."""
    asked = json.loads(what)
    n = int(re.search(r'ISSN:"(\d+)-', asked["query"]).group(1))
    begin = 0 if asked["cursorMark"] == "*" else int(asked["cursorMark"])
    end = min(n, begin + PAGE)
    hits = [{"pmcid": f"PMC{n}x{i}", "firstPublicationDate": f"{2000 + i}-05-01", "title": f"Paper {i} " * (30 if i % 2 else 1)} for i in range(begin, end)]
    return 200, json.dumps({"resultList": {"result": hits}, "nextCursorMark": str(end)})


def article(pmcid: str) -> tuple[int, bytes]:
    """An article service: by the number that an id ends in, none (sevenths), broken (fifths), a page that is no article (elevenths), or an article."""
    n = int(re.search(r"(\d+)$", pmcid).group(1))
    if n % 7 == 0:
        return 404, b""
    if n % 5 == 0:
        return 503, b""
    if n % 11 == 0:
        return 200, b"<html><body>down for a moment</body></html>" * 10
    return 200, (f"<article><title>{pmcid}</title>" + f"<p>{_number(pmcid)}</p>" * 20 + "</article>").encode()
