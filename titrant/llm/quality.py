"""Quality rules: word statistics and zstandard compression bands.

Method: a text is compressed whole and, if it is longer than one chunk, chunk by chunk. The ratio of compressed to
original bytes must lie in a band that depends on the length compressed: repetitive text falls below it,
incompressible text (encoded blobs, random characters) rises above it.

Edge cases: a null text has no words, all counts are 0, ``base_failed`` is true and ``kept`` false; an empty or blank
text likewise. Repeated rows are judged one by one. Texts are judged whole, however long. Columns of the input that
share a name with a computed one are replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from .bytewords import OWN, PLAIN, Slice, class_table, map_text, mix64, row_of, unused, window_hash, windows

CHUNK_BYTES = 4096
LEVEL = 3
MIN_WORDS = 50
#: For texts of at least so many bytes: the least and the greatest ratio. The least stands about 0.01 (below 512 bytes
#: 0.04) under what texts labelled good have on sf0.1 (from 256 bytes on 0.54-0.73, 0.51-0.68, 0.47-0.58, 0.45-0.52,
#: 0.43-0.47, 0.42-0.45, 0.40-0.43; none labelled from 32 KiB on, where the trend is carried on, and none from 64 KiB on).
#: Under 128 bytes, where the frame alone weighs a tenth, the band only tells single repeated words and encoded bytes.
#: The greatest stands above them and below what base64 in words has (0.92-0.84, 0.84-0.80, 0.80-0.77, then 0.75 or more).
BANDS = (
    (0, 0.30, 1.05), (128, 0.40, 0.93), (256, 0.50, 0.80), (512, 0.49, 0.75), (1024, 0.455, 0.70), (2048, 0.44, 0.70),
    (4096, 0.42, 0.70), (8192, 0.405, 0.70), (16384, 0.395, 0.70), (32768, 0.38, 0.70), (65536, 0.30, 0.70),
)
#: For fixed chunks: the bands (texts labelled good have 0.44-0.48 on sf0.1), and the greatest share of chunks that may
#: leave them.
CHUNK_BAND, CHUNK_SHARE = (0.43, 0.70), 0.25

FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, zstd_ratio double, bad_chunk_share double, reason string, kept boolean"
_SYMBOL = class_table(lambda b: chr(b) in "#*$%&|<>")
_SPAN = 3


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Whether each key stands twice or more."""
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    many = np.zeros(len(keys), bool)
    many[order[1:]] = same
    many[order[:-1]] |= same
    return many


def _later_copies(keys: np.ndarray) -> np.ndarray:
    """Whether each key stands earlier too."""
    order = np.argsort(keys, kind="stable")
    late = np.zeros(len(keys), bool)
    late[order[1:]] = keys[order][1:] == keys[order][:-1]
    return late


def word_statistics(part: Slice) -> dict[str, np.ndarray]:
    n = part.n
    starts, ends, places = part.words(PLAIN)
    prefix = part.prefix_hash(bases=OWN)
    n_words = np.diff(places)
    salt = mix64(np.arange(1, n + 1, dtype=np.uint64))

    cuts = np.flatnonzero(part.buf == 10)
    line_start = np.concatenate([part.offs[:-1], cuts + 1])
    line_end = np.concatenate([cuts, part.offs[1:]])
    line_start.sort()
    line_end.sort()
    worded = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end = line_start[worded], line_end[worded]
    line_row = np.searchsorted(part.offs, line_start, "right") - 1
    copy = _later_copies(part.span_hash(prefix, line_start, line_end) ^ salt[line_row]) if len(line_start) else np.zeros(0, bool)

    hashes = part.span_hash(prefix, starts, ends)
    first, rows = windows(places, _SPAN)
    hit = np.zeros(len(starts), bool)
    if len(first):
        at = first[_repeats(window_hash(hashes, first, _SPAN) ^ salt[rows])]
        for k in range(_SPAN):
            hit[at + k] = True
    return {
        "n_words": n_words,
        "word_chars": part.per_row(PLAIN[part.buf] & ((part.buf & 0xC0) != 0x80)),
        "n_symbols": part.per_row(_SYMBOL[part.buf]),
        "n_dup_lines": np.bincount(line_row[copy], minlength=n),
        "n_repeat_words": np.bincount(row_of(places)[hit], minlength=n),
    }


def band(size: int) -> tuple[float, float]:
    return next((lo, hi) for least, lo, hi in reversed(BANDS) if size >= least)


def compression_verdict(text: bytes, packer: zstandard.ZstdCompressor) -> tuple[float | None, float | None, str | None]:
    """Ratio, share of chunks outside their band, and why the text is rejected (None: it isn't)."""
    if not text:
        return None, None, "empty"
    ratio = len(packer.compress(text)) / len(text)
    bad = None
    if len(text) > CHUNK_BYTES:
        # the last chunk is as long as the others and overlaps its predecessor, so one band fits all
        at = [*range(0, len(text) - CHUNK_BYTES, CHUNK_BYTES), len(text) - CHUNK_BYTES]
        ratios = [len(packer.compress(text[i : i + CHUNK_BYTES])) / CHUNK_BYTES for i in at]
        bad = sum(not CHUNK_BAND[0] <= r <= CHUNK_BAND[1] for r in ratios) / len(ratios)
    least, most = band(len(text))
    if ratio < least:
        return ratio, bad, "repetitive"
    if ratio > most:
        return ratio, bad, "incompressible"
    if bad is not None and bad > CHUNK_SHARE:
        return ratio, bad, "chunks"
    return ratio, bad, None


def _make():
    packer = zstandard.ZstdCompressor(level=LEVEL)

    def compute(part: Slice, _) -> dict:
        out: dict = word_statistics(part)
        out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
        verdicts = [compression_verdict(part.text(i), packer) for i in range(part.n)]
        out["zstd_ratio"], out["bad_chunk_share"], why = zip(*verdicts, strict=True)
        out["reason"] = ["base" if failed else x for failed, x in zip(out["base_failed"], why, strict=True)]
        out["kept"] = np.array([x is None for x in out["reason"]])
        return out

    return compute


def judge(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and the statistics and verdict of each row."""
    return map_text(df, text, keep, FIELDS, _make)


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text passes, with their own columns."""

    mark = unused(df.columns, "__kept")

    def make():
        compute = _make()
        return lambda part, rows: {mark: compute(part, rows)["kept"]}

    return map_text(df, text, df.columns, f"`{mark}` boolean", make, where=mark)


def query(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))


BASE = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def base_query(spark, sf_dir: str) -> DataFrame:
    """What SQL can express of the operator's rows: all but the compression verdict."""
    return query(spark, sf_dir).select(*BASE)


BASE_SQL = rf"""
WITH w AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
line AS (SELECT k, line, count(*) AS n FROM (SELECT k, unnest(string_split(t, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1, 2),
dup AS (SELECT k, sum(n - 1) AS n FROM line GROUP BY 1),
gram AS (SELECT k, i, list_slice(ws, i, i + {_SPAN - 1}) AS g FROM (SELECT k, ws, unnest(range(1, len(ws) - {_SPAN - 2})) AS i FROM w)),
hit AS (SELECT k, count(DISTINCT j) AS n FROM (SELECT k, unnest(range(i, i + {_SPAN})) AS j FROM gram JOIN (SELECT k, g FROM gram GROUP BY 1, 2 HAVING count(*) > 1) USING (k, g)) GROUP BY 1),
c AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN dup USING (k) LEFT JOIN hit USING (k))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c
"""
