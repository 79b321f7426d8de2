"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items, one scan of each text.

Items and texts are normalised alike: A-Z lower-cased, words joined by one space, a space before and after. The
automaton holds every window of ``WINDOW`` consecutive item words (an item with fewer words is one window), so a match
begins and ends at a word; its offset maps back to word numbers and, through them, to bytes of the original text.

The benchmark's size is checked before any of it is collected. Up to ``BENCHMARK_BYTES`` of item text make one automaton
(about 400 bytes of memory for a byte of text), which every task has by broadcast. A larger benchmark is dealt to several
automata by the hash of its item ids, and the texts go through one after the other: what one pass finds is written beside
the texts for the next, so no task ever holds two automata or builds one twice, and hits are merged at the last.

Edge cases: a null or wordless text has no hits; a null or wordless item has no windows and never occurs. Items with
equal windows are all found. Repeated documents are judged one by one, repeated item rows count once per item id.
An empty benchmark marks nothing. Texts are scanned whole, however long. Of columns that share a name with a computed
one, the computed one stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import LOWER, NORMAL, Slice, map_text, unused
from .storage import settled

WINDOW = 10
BENCHMARK_BYTES = 1 << 20
FIELDS = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
SPANS = "n_words long, spans array<struct<first_byte:long,end_byte:long,first_word:long,end_word:long>>, items array<string>, contaminated boolean"


def item_windows(text: bytes, size: int = WINDOW) -> set[bytes]:
    """The windows of an item, as they are searched."""
    part = Slice(0, 1, np.frombuffer(text, np.uint8), np.array([0, len(text)]), np.zeros(1, bool))
    starts, ends, _ = part.words(NORMAL)
    low = LOWER[part.buf]
    words = [low[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    if not words:
        return set()
    return {b" " + b" ".join(words[i : i + size]) + b" " for i in range(max(1, len(words) - size + 1))}


def benchmark_parts(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> list[DataFrame]:
    """``i, t``: the items' ids and texts in parts of about ``BENCHMARK_BYTES`` of text, all rows of an item in one."""
    rows = benchmark.select(F.col(f"`{item}`").cast("string").alias("i"), F.col(f"`{text}`").alias("t")).filter("i IS NOT NULL AND t IS NOT NULL").distinct()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n = max(1, -(-size // BENCHMARK_BYTES))
    return [rows.filter(F.pmod(F.xxhash64("i"), F.lit(n)) == k) for k in range(n)] if n > 1 else [rows]


def windows_of(items: DataFrame, size: int = WINDOW) -> list[tuple[bytes, list[str]]]:
    """Each window of one part and the items that have it."""
    by: dict[bytes, set[str]] = {}
    for row in items.toLocalIterator():
        for w in item_windows(row.t.encode(), size):
            by.setdefault(w, set()).add(row.i)
    return [(w, sorted(by[w])) for w in sorted(by)]


class Scanner:
    """One automaton, and how slices are scanned with it."""

    def __init__(self, windows: list[tuple[bytes, list[str]]]):
        self.machine = ahocorasick.Automaton()
        for window, items in windows:
            # the library's keys are strings of characters; one character stands for one byte
            self.machine.add_word(window.decode("latin-1"), (window.count(b" ") - 1, len(window), items))
        self.machine.make_automaton()
        self.empty = not windows

    def normalised(self, part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word starts, ends and places; the normalised bytes (each word with a space after it, each text with a space before); where each word stands there."""
        starts, ends, places = part.words(NORMAL)
        inside = NORMAL[part.buf]
        # a byte of the output for each word byte, one for the space after each word, one for the space before each text
        size = ends - starts + 1
        row = np.repeat(np.arange(part.n), np.diff(places))
        at = np.cumsum(size) - size + row + 1
        out = np.full(int(size.sum()) + part.n, 32, np.uint8)
        run = np.flatnonzero(inside)
        shift = np.repeat(at - starts, ends - starts)
        out[run + shift] = LOWER[part.buf[run]]
        return starts, ends, places, out, at

    def scan(self, part: Slice):
        """For each text with a hit: its row, the mask of its words that are hit, and its items; also starts, ends and places of all words."""
        starts, ends, places, out, at = self.normalised(part)
        found: dict[int, tuple[np.ndarray, set[str]]] = {}
        size = np.zeros(part.n + 1, np.int64)
        # where each text begins in the output: before its words come those of earlier texts and their spaces
        size[1:] = np.cumsum(np.bincount(np.repeat(np.arange(part.n), np.diff(places)), weights=ends - starts + 1, minlength=part.n).astype(np.int64) + 1)
        for i in range(0 if self.empty else part.n):
            if places[i] == places[i + 1]:
                continue
            base = int(size[i])
            for end, (words, length, items) in self.machine.iter(out[base : size[i + 1]].tobytes().decode("latin-1")):
                first = int(np.searchsorted(at, base + end - length + 2)) - int(places[i])
                mask, seen = found.setdefault(i, (np.zeros(int(places[i + 1] - places[i]), bool), set()))
                mask[first : first + words] = True
                seen.update(items)
        return found, starts, ends, places


Found = dict[int, tuple[np.ndarray, set[str]]]  # by row, the mask of words hit and the items
Finish = Callable[[Slice, Found, np.ndarray, np.ndarray, np.ndarray], dict]  # slice, found, starts, ends and places of words in; computed columns out
CARRIED = "array<int>", "array<string>"


def scanned(docs: DataFrame, benchmark: DataFrame, text: str, keep: Sequence[str], fields: str, finish: Finish, size: int = WINDOW, where: str | None = None) -> DataFrame:
    """``keep`` and the ``fields`` that ``finish`` makes of what all automata find in each slice."""
    parts = benchmark_parts(benchmark)
    hits, items = unused(docs.columns, "__hits"), unused(docs.columns, "__items")
    rows = docs
    for k, part_items in enumerate(parts):
        windows = docs.sparkSession.sparkContext.broadcast(windows_of(part_items, size))
        last = k + 1 == len(parts)

        def make(windows=windows, before=k > 0, last=last):
            scanner = Scanner(windows.value)

            def compute(part: Slice, batch) -> dict:
                found, starts, ends, places = scanner.scan(part)
                if before:
                    column = lambda c: batch.column(batch.schema.names.index(c)).to_pylist()
                    for i, (words, seen) in enumerate(zip(column(hits), column(items), strict=True)):
                        if words:
                            mask, mine = found.setdefault(i, (np.zeros(int(places[i + 1] - places[i]), bool), set()))
                            mask[words] = True
                            mine.update(seen)
                if last:
                    return finish(part, found, starts, ends, places)
                return {hits: [np.flatnonzero(found[i][0]).tolist() if i in found else [] for i in range(part.n)], items: [sorted(found[i][1]) if i in found else [] for i in range(part.n)]}

            return compute

        carried = [hits, items] if k else []
        if last:
            return map_text(rows, text, keep, fields, make, where, carried)
        rows = settled(map_text(rows, text, docs.columns, f"`{hits}` {CARRIED[0]}, `{items}` {CARRIED[1]}", make, None, carried), "scanned")
    raise AssertionError("there is always a part")


def _digest(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


NOTHING: tuple[np.ndarray, set[str]] = (np.zeros(0, bool), set())


def _counts(part: Slice, found: Found, starts: np.ndarray, ends: np.ndarray, places: np.ndarray) -> dict:
    got = [found.get(i, NOTHING) for i in range(part.n)]
    return {"n_words": np.diff(places), "n_hit": [int(m.sum()) for m, _ in got], "n_items": [len(s) for _, s in got], "items_sha256": [_digest(s) for _, s in got], "contaminated": [bool(s) for _, s in got]}


def _passages(part: Slice, found: Found, starts: np.ndarray, ends: np.ndarray, places: np.ndarray) -> dict:
    all_spans, items = [], []
    for i in range(part.n):
        mask, seen = found.get(i, NOTHING)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
        all_spans.append([{"first_byte": int(starts[places[i] + a] - part.offs[i]), "end_byte": int(ends[places[i] + b - 1] - part.offs[i]), "first_word": int(a), "end_word": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
        items.append(sorted(seen))
    return {"n_words": np.diff(places), "spans": all_spans, "items": items, "contaminated": [bool(x) for x in items]}


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), size: int = WINDOW) -> DataFrame:
    """``keep`` and, per row, words, hit words, number and digest of the items found, and whether there is any hit."""
    return scanned(docs, benchmark, text, keep, FIELDS, _counts, size)


def spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), size: int = WINDOW) -> DataFrame:
    """Like :func:`find`, with the hit passages as byte and word offsets of the original text, and the items' ids."""
    return scanned(docs, benchmark, text, keep, SPANS, _passages, size)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows without a hit, with their own columns."""
    mark = unused(docs.columns, "__clean")

    def finish(part: Slice, found: Found, starts: np.ndarray, ends: np.ndarray, places: np.ndarray) -> dict:
        clean = np.ones(part.n, bool)
        clean[list(found)] = False
        return {mark: clean}

    return scanned(docs, benchmark, text, docs.columns, f"`{mark}` boolean", finish, where=mark)


def query(spark, sf_dir: str) -> DataFrame:
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = r"""
WITH item AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS win FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT row_number() OVER () AS k, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
sizes AS (SELECT DISTINCT len(win) AS n FROM win),
place AS (SELECT k, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes WHERE len(w) >= n),
hit AS (SELECT p.k, p.i, p.n, x.item_id FROM place p JOIN win x ON list_slice(p.w, p.i, p.i + p.n - 1) = x.win),
words AS (SELECT k, count(DISTINCT j) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS j FROM hit) GROUP BY k),
items AS (SELECT k, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS all_items FROM hit GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(all_items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (k) LEFT JOIN items USING (k)
"""
