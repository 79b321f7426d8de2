"""All registered queries of the library itself, and their SQL."""

from __future__ import annotations

from . import corpus_queries, flow_queries, record_queries, rule_queries, service_queries, sheet_queries, stream_queries
from .common import Query

FLAGSHIP = "rank_trend"
_ENTRIES = corpus_queries.ENTRIES | rule_queries.ENTRIES | record_queries.ENTRIES | service_queries.ENTRIES | sheet_queries.ENTRIES | flow_queries.ENTRIES | stream_queries.ENTRIES
QUERIES: dict[str, Query] = {k: q for k, (q, _) in _ENTRIES.items()}
ORACLE_SQL: dict[str, str] = {k: s for k, (_, s) in _ENTRIES.items() if s}
