"""Vectorised work on whole texts: Arrow batches in, numpy over their UTF-8 bytes, Arrow batches out.

A :class:`Slice` holds some rows of a batch (about ``SLICE_BYTES`` of text, one row at least), so that the
scratch arrays stay small however large a batch is; a single very long text is its own slice and is never cut.
"""

from __future__ import annotations

import secrets
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SLICE_BYTES = 2 << 20
SLICE_ROWS = 1 << 15
ODD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise."""
    x = np.asarray(x, np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def class_table(inside: Callable[[int], bool]) -> np.ndarray:
    return np.array([inside(b) for b in range(256)])


#: Words ``[^\x20\x09-\x0D]+``.
PLAIN = class_table(lambda b: not (b == 0x20 or 9 <= b <= 13))
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of a text whose A-Z are lower-cased, found without lower-casing first.
NORMAL = class_table(lambda b: b >= 0x80 or chr(b).isascii() and chr(b).isalnum())
#: A-Z to a-z.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

#: Sequences are hashed as polynomials modulo this prime in two bases, so no pattern of letters collides by itself, as
#: some do modulo a power of two.
PRIME = (1 << 31) - 1
#: The bases of hashes that tasks exchange. Those that stay in a process are drawn there, so no text can be made for them.
SHARED = (0x2C1B3C6D, 0x297A2D39)
OWN = (1 + (1 << 20) + secrets.randbelow(1 << 30), 1 + (1 << 20) + secrets.randbelow(1 << 30))

_LETTER = (mix64(np.arange(1, 257, dtype=np.uint64) * ODD) >> np.uint64(33)).astype(np.int64)
_BASE = 0xD1342543DE82EF95


@lru_cache(4)
def _powers(bits: int, base: int) -> np.ndarray:
    """Powers of a base, up to 2^bits of them."""
    out = np.ones(1, np.int32)
    while len(out) < 1 << bits:
        out = np.concatenate([out, (out * np.int64(pow(base, len(out), PRIME)) % PRIME).astype(np.int32)])
    return out


class Prefix:
    """Sums over the items before each place of a sequence, by which any span of it is hashed. ``values`` are below 2^31, one array for each base."""

    def __init__(self, values: tuple[np.ndarray, np.ndarray], bases: tuple[int, int] = SHARED):
        n = len(values[0])
        self.bits, self.bases, self.sums = max(21, n.bit_length()), bases, []
        for base, value in zip(bases, values, strict=True):
            term = value * _powers(self.bits, base)[:n]
            high = term >> 31
            term &= PRIME
            term += high
            total = np.zeros(n + 1, np.int64)
            np.cumsum(term, out=total[1:])
            self.sums.append(total)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of spans; equal spans get equal hashes wherever they stand."""
        first, second = ((total[end] - total[start]) % PRIME * _powers(self.bits, pow(base, -1, PRIME))[start] % PRIME for base, total in zip(self.bases, self.sums, strict=True))
        return mix64((first << 31 | second).astype(np.uint64) + np.asarray(end - start).astype(np.uint64) * ODD)


def halves(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two values below 2^31 of each 64-bit hash."""
    return (hashes & np.uint64(PRIME)).astype(np.int64), (hashes >> np.uint64(33)).astype(np.int64)


@dataclass
class Slice:
    """Rows ``lo:hi`` of a batch; ``buf[offs[i]:offs[i + 1]]`` is the i-th text in UTF-8 (null: empty)."""

    lo: int
    hi: int
    buf: np.ndarray
    offs: np.ndarray
    null: np.ndarray

    @property
    def n(self) -> int:
        return self.hi - self.lo

    def text(self, i: int) -> bytes:
        return self.buf[self.offs[i] : self.offs[i + 1]].tobytes()

    def prefix_hash(self, lower: bool = False, bases: tuple[int, int] = SHARED) -> Prefix:
        letters = _LETTER[LOWER[self.buf] if lower else self.buf]
        return Prefix((letters, letters), bases)

    def span_hash(self, prefix: Prefix, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte spans; equal spans get equal hashes wherever they stand."""
        return prefix.spans(start, end)

    def words(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and for each text the place of its first one (with the total at the end)."""
        inside = table[self.buf]
        first = np.empty(len(inside), bool)
        if len(inside):
            first[0] = inside[0]
            np.logical_and(inside[1:], ~inside[:-1], out=first[1:])
            edges = self.offs[:-1][np.diff(self.offs) > 0]
            first[edges] = inside[edges]
        last = np.empty(len(inside), bool)
        if len(inside):
            last[-1] = inside[-1]
            np.logical_and(inside[:-1], ~inside[1:], out=last[:-1])
            ends = self.offs[1:][np.diff(self.offs) > 0] - 1
            last[ends] = inside[ends]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        return starts, ends, np.searchsorted(starts, self.offs)

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Sums of a value for each byte, by text."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offs[1:]] - total[self.offs[:-1]]


def row_of(places: np.ndarray) -> np.ndarray:
    """The row of each item, from the place of each row's first item."""
    return np.repeat(np.arange(len(places) - 1), np.diff(places))


def windows(places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First items of all runs of ``size`` items within a row, and their rows."""
    counts = np.maximum(np.diff(places) - size + 1, 0)
    rows = np.repeat(np.arange(len(counts)), counts)
    first = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + places[:-1][rows]
    return first, rows


def window_hash(hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(len(first), np.uint64)
    for k in range(size):
        out = out * np.uint64(_BASE) + hashes[first + k]
    return mix64(out)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    null = np.asarray(column.is_null().to_numpy(zero_copy_only=False), bool) if column.null_count else np.zeros(len(column), bool)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    offs = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        hi = min(hi, lo + SLICE_ROWS, len(column))
        yield Slice(lo, hi, flat[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], null[lo:hi])
        lo = hi


class IntTable:
    """A table from non-negative integers to integers, looked up many at a time (open addressing)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            _, first = np.unique(at[left], return_index=True)
            mine = left[first]
            mine = mine[self.keys[at[mine]] < 0]
            self.keys[at[mine]], self.values[at[mine]] = keys[mine], values[mine]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((np.asarray(keys).astype(np.uint64) * ODD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray, missing: int) -> np.ndarray:
        at = self._slot(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.values[at], missing)
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
            there = self.keys[at[left]]
            hit = there == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (there >= 0)]
        return out


def unused(columns: Sequence[str], name: str) -> str:
    """``name``, or a longer one that no column has (columns that differ in case only are the same to Spark)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def besides(keep: Sequence[str], computed: Sequence[str]) -> list[str]:
    """The columns of ``keep`` that no computed one replaces."""
    names = {c.lower() for c in computed}
    return [c for c in dict.fromkeys(keep) if c.lower() not in names]


Compute = Callable[[Slice, pa.RecordBatch], dict]


def map_text(df: DataFrame, text: str, keep: Sequence[str], fields: str, make: Callable[[], Compute], where: str | None = None, also: Sequence[str] = ()) -> DataFrame:
    """Carry the columns ``keep`` and append ``fields`` (a DDL string), computed slice by slice from the column ``text``.

    A computed column replaces a kept one of the same name. ``make`` runs once per task and returns the function that
    maps a slice to a dict of column values; with ``where``, only rows whose value in that computed column is true stay,
    and the column itself is dropped. The rows that the function gets have the columns ``also`` too, which aren't carried.
    """
    added = T.StructType.fromDDL(fields)
    keep = besides(keep, added.names)
    needed = list(dict.fromkeys([*keep, text, *also]))
    source = df.select(*[f"`{c}`" for c in needed])
    schema = T.StructType([*[source.schema[c] for c in keep], *[f for f in added if f.name != where]])
    arrow = to_arrow_schema(schema)
    kinds = {f.name: f.type for f in to_arrow_schema(added)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            column = batch.column(needed.index(text))
            for part in slices(column):
                rows = batch.slice(part.lo, part.n)
                got = compute(part, rows)
                arrays = [rows.column(needed.index(c)) for c in keep]
                arrays += [pa.array(got[f.name], kinds[f.name]) for f in added if f.name != where]
                out = pa.RecordBatch.from_arrays([a.cast(f.type) if a.type != f.type else a for a, f in zip(arrays, arrow, strict=True)], schema=arrow)
                yield out if where is None else out.filter(pa.array(np.asarray(got[where], bool)))

    return source.mapInArrow(run, schema)
