"""Rules by the thousand: a counting index over their predicates instead of an expression for each rule.

Conditions of all rules become postings: for each property and kind of test, the literals in order and, behind each, the
rules that ask for it. A record's value selects the postings that hold with one binary search (equal literals, a prefix of
the lower bounds, a suffix of the upper ones, all unequal ones less the equal one), and every posting adds one to its
rule's counter. A rule fires if its counter reaches the number of its tests. So a record costs what its values satisfy,
and a distinct test is evaluated once however many rules share it.

The index is made on the driver, where the rules are, and broadcast once. Records go through in one pass of Arrow batches,
in slices whose counters fit ``CELLS``; nothing is shuffled and no code is generated for a rule. The rows are those of
:func:`titrant.operators.rules.apply_rules`.

Properties are booleans, numbers (compared as doubles) or strings; a literal must be of its property's kind.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .rules import OPERATORS, RANKS, Lookup, Rule, literal

#: So many counters (records x rules) a task holds at a time.
CELLS = 1 << 20
KINDS = {"boolean": bool, "double": (int, float), "string": str}
FIRED = T.ArrayType(
    T.StructType([T.StructField("ord", T.IntegerType()), *[T.StructField(c, T.StringType()) for c in ("id", "because", "cite", "confidence")], T.StructField("field_consensus", T.BooleanType())]), False
)


def tests_of(wanted: object) -> list[tuple[str, object]]:
    """The tests of a condition: a literal is one of equality; operators that nobody knows say nothing; without any, a value must be there."""
    if not isinstance(wanted, dict):
        return [("eq", wanted)]
    return [(op, v) for op, v in wanted.items() if op in OPERATORS] or [("there", None)]


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges ``first:last``, and the number of the range that each belongs to."""
    length = last - first
    owner = np.repeat(np.arange(len(first)), length)
    return np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length) + first[owner], owner


@dataclass
class Postings:
    """Literals in order, and the rules behind each one: ``rules[starts[i]:starts[i + 1]]``."""

    literals: np.ndarray
    starts: np.ndarray
    rules: np.ndarray

    @classmethod
    def of(cls, pairs: list[tuple[object, int]], kind: str) -> Postings:
        literals = sorted({v for v, _ in pairs})
        place = {v: i for i, v in enumerate(literals)}
        at = np.array([place[v] for v, _ in pairs], np.int64)
        order = np.argsort(at, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(literals)))])
        return cls(np.array(literals, object if kind == "string" else np.float64), starts, np.array([r for _, r in pairs], np.int64)[order])

    def ranks(self, values: np.ndarray, side: str) -> np.ndarray:
        return np.searchsorted(self.literals, values, side)

    def equal(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.ranks(values, "left"), self.ranks(values, "right")
        return self.starts[lo], self.starts[hi]


class RuleIndex:
    """Postings of all tests, how many tests each rule has, and which properties."""

    def __init__(self, rules: Sequence[Rule], kinds: dict[str, str]):
        found: dict[tuple[str, str], list[tuple[object, int]]] = {}
        self.needed = np.zeros(len(rules), np.int64)
        for i, rule in enumerate(rules):
            for p, wanted in rule.when.items():
                for op, v in tests_of(wanted):
                    if v is None and op != "there":
                        op = "never"  # nothing compares with null
                    elif op != "there" and (not isinstance(v, KINDS[kinds[p]]) or kinds[p] == "double" and isinstance(v, bool)):
                        raise TypeError(f"rule {rule.id}: {p} is a {kinds[p]}, {v!r} isn't")
                    found.setdefault((p, op), []).append((0.0 if op in ("there", "never") else v, i))
                    self.needed[i] += 1
        self.postings = {key: Postings.of(pairs, "double" if key[1] in ("there", "never") else kinds[key[0]]) for key, pairs in found.items()}
        self.properties = list(kinds)
        at = {p: k for k, p in enumerate(self.properties)}
        # a row for each rule, filled up with a property that no record has
        self.of_rule = np.full((len(rules), max((len(r.when) for r in rules), default=0) + 1), len(at), np.int64)
        for i, r in enumerate(rules):
            self.of_rule[i, : len(r.when)] = [at[p] for p in r.when]
        self.ids, self.because, self.cites = ([getattr(r, c) for r in rules] for c in ("id", "because", "cite"))
        self.consensus = np.array([r.field_consensus for r in rules], bool)
        # what all rules write, one after the other: rule i the places starts[i]:starts[i + 1]
        writes = [(k, literal(v)) for r in rules for k, v in r.then.items()]
        self.paths = sorted({k for k, _ in writes})
        place = {k: i for i, k in enumerate(self.paths)}
        self.starts = np.concatenate([[0], np.cumsum([len(r.then) for r in rules], dtype=np.int64)])
        self.path_of, self.written = np.array([place[k] for k, _ in writes], np.int64), [v for _, v in writes]

    def fired(self, values: dict[str, tuple[np.ndarray, np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Records and rules that fire, in order, from each property's values and which of them are there."""
        width = len(self.needed)
        counts = np.zeros(n * width, np.int16)
        for (p, op), post in self.postings.items():
            value, there = values[p]
            rows = np.flatnonzero(there)
            if op == "never" or not len(rows):
                continue
            value, zero, full = value[rows], np.zeros(len(rows), np.int64), np.full(len(rows), len(post.rules), np.int64)
            if op == "eq":
                ranges = [(*post.equal(value), 1)]
            elif op in ("ne", "there"):
                ranges = [(zero, full, 1)] + ([(*post.equal(value), -1)] if op == "ne" else [])
            elif op in ("gt", "gte"):
                ranges = [(zero, post.starts[post.ranks(value, "left" if op == "gt" else "right")], 1)]
            else:
                ranges = [(post.starts[post.ranks(value, "right" if op == "lt" else "left")], full, 1)]
            for first, last, sign in ranges:
                # a rule has one literal for a property and an operator, so no counter is met twice here
                if 8 * (last - first).sum() < n * width:
                    place, owner = _spread(first, last)
                    counts[rows[owner] * width + post.rules[place]] += np.int16(sign)
                    continue
                # many counters: values between the same literals have the same ones, which are then found once
                kinds, alike = np.unique(first * (len(post.rules) + 1) + last, return_inverse=True)
                place, owner = _spread(kinds // (len(post.rules) + 1), kinds % (len(post.rules) + 1))
                block = np.zeros((len(kinds), width), np.int16)
                block[owner, post.rules[place]] = sign
                table = counts.reshape(n, width)
                if len(rows) == n:
                    table += block[alike]
                else:
                    table[rows] += block[alike]
        return np.divmod(np.flatnonzero(counts.reshape(n, width) == self.needed.astype(np.int16)), max(1, width))

    def profiles(self, rows: np.ndarray, ords: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each record's directives begin, and their places among all that rules write: later ones over earlier ones; a path that is written again moves behind the others."""
        place, owner = _spread(self.starts[ords], self.starts[ords + 1])
        row = rows[owner]
        _, last = np.unique((row * len(self.paths) + self.path_of[place])[::-1], return_index=True)
        kept = np.sort(len(place) - 1 - last)
        return np.searchsorted(row[kept], np.arange(n + 1)), place[kept]

    def confidences(self, told: Sequence[pa.Array], rows: np.ndarray, ords: np.ndarray, n: int) -> pa.Array:
        """The first of the least confidences of each fired rule's properties; a property without any counts as high."""
        words, codes = ["high"], np.zeros((n, len(self.properties) + 1), np.int64)
        for k, column in enumerate(told):
            coded = column.dictionary_encode()
            codes[:, k] = pc.fill_null(pc.add(coded.indices.cast(pa.int64()), len(words)), 0).to_numpy(zero_copy_only=False)
            words += coded.dictionary.to_pylist()
        ranks = np.array([RANKS.get(w, 0) for w in words])
        each = codes[rows[:, None], self.of_rule[ords]]
        rank = ranks[each]
        least = rank.argmin(1)[:, None] if len(each) else np.zeros((0, 1), np.int64)
        # what ranks as high is said as high
        got = np.where(np.take_along_axis(rank, least, 1) < RANKS["high"], np.take_along_axis(each, least, 1), 0)[:, 0]
        return pa.array(words, pa.string()).take(pa.array(got))


def _values(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    there = np.asarray(column.is_valid().to_numpy(zero_copy_only=False), bool)
    if kind == "string":
        return column.to_numpy(zero_copy_only=False), there
    return pc.fill_null(column.cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False), there


def _kind(t: T.DataType, name: str) -> str:
    if isinstance(t, T.BooleanType):
        return "boolean"
    if isinstance(t, T.NumericType):
        return "double"
    if isinstance(t, (T.StringType, T.NullType)):
        return "string"
    raise TypeError(f"{name} is {t.simpleString()}; rules test booleans, numbers and strings")


def apply_indexed(records: DataFrame, rules: Sequence[Rule], value: Lookup, confidence: Lookup | None = None) -> DataFrame:
    """All columns, and ``rules_fired``, ``profile`` (dotted paths) and ``conflicts``, as :func:`titrant.operators.rules.apply_rules` gives them."""
    names = list(dict.fromkeys(p for r in rules for p in r.when))
    confidence = confidence or (lambda _: F.lit(None).cast("string"))
    added = ("rules_fired", "profile", "conflicts")
    own = [c for c in records.columns if c not in added]
    probe = records.select(*[value(p).alias(f"v{k}") for k, p in enumerate(names)]).schema
    kinds = {p: _kind(probe[f"v{k}"].dataType, p) for k, p in enumerate(names)}
    casts = {"boolean": "boolean", "double": "double", "string": "string"}
    inputs = [value(p).cast(casts[kinds[p]]).alias(f"v{k}") for k, p in enumerate(names)] + [confidence(p).cast("string").alias(f"c{k}") for k, p in enumerate(names)]
    source = records.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("own"), *inputs)
    schema = T.StructType([*[records.schema[c] for c in own], T.StructField("rules_fired", FIRED, False), T.StructField("profile", T.MapType(T.StringType(), T.StringType())), T.StructField("conflicts", T.ArrayType(T.StringType()))])
    arrow = to_arrow_schema(schema)
    held = records.sparkSession.sparkContext.broadcast(RuleIndex(rules, kinds))
    step = max(1, CELLS // max(1, len(rules)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: RuleIndex = held.value
        texts = [pa.array(t, pa.string()) for t in (index.ids, index.because, index.cites)]
        paths, written = pa.array(index.paths, pa.string()), pa.array(index.written, pa.string())
        for whole in batches:
            for lo in range(0, whole.num_rows, step):
                batch = whole.slice(lo, step)
                n = batch.num_rows
                values = {p: _values(batch.column(1 + k), kinds[p]) for k, p in enumerate(names)}
                told = [batch.column(1 + len(names) + k) for k in range(len(names))]
                rows, ords = index.fired(values, n)
                given = np.searchsorted(rows, np.arange(n + 1))
                begin, place = index.profiles(rows, ords, n)
                profiles = pa.MapArray.from_arrays(pa.array(begin, pa.int32()), paths.take(pa.array(index.path_of[place])), written.take(pa.array(place)))
                fields = [pa.array(ords, pa.int32()), *[t.take(pa.array(ords)) for t in texts], index.confidences(told, rows, ords, n), pa.array(index.consensus[ords])]
                kind = arrow.field("rules_fired").type
                fired = pa.ListArray.from_arrays(pa.array(given, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(kind.value_type)))
                mine = batch.column(0)
                columns = [*(mine.flatten() if own else []), fired, profiles, pa.array([[]] * n, arrow.field("conflicts").type)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return source.mapInArrow(run, schema)
