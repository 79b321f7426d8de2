"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe_automaton, chat, decontaminate, dialogue_repair, exact_dedup, html_extract, licenses, minhash, pii, quality, spelling, token_shards, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": minhash.query,
    "op2_quality_rules": quality.query,
    "op3_url_filters": url_filter.query,
    "op4_decontamination": decontaminate.query,
    "op5_license_scans": licenses.query,
    "op6_html_extraction": html_extract.query,
    "op7_chat_formatting": chat.query,
    "op8_pii": pii.query,
    "op9_bpe": bpe_automaton.query,
    "op10_token_shards": token_shards.query,
    "op11_exact_dedup": exact_dedup.query,
    "op12_conversation_repair": dialogue_repair.query,
    "op13_spelling_variants": spelling.query,
    # of two operators' rows, the columns that SQL can express
    "quality_base": quality.base_query,
    "pii_base": pii.base_query,
}
ORACLE_SQL: dict[str, str] = {
    "op3_url_filters": url_filter.sql(),
    "op4_decontamination": decontaminate.SQL,
    "op5_license_scans": licenses.sql(),
    "op11_exact_dedup": exact_dedup.SQL,
    "quality_base": quality.BASE_SQL,
    "pii_base": pii.BASE_SQL,
}
