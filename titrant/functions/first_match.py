"""Priority chains as columns: the first of some conditions that holds decides."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(pairs: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """``CASE``: the value of the first condition that is true."""
    out = None
    for condition, value in pairs:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def any_of(conditions: Sequence[Column]) -> Column:
    return functools.reduce(Column.__or__, conditions, F.lit(False))


def all_of(conditions: Sequence[Column]) -> Column:
    return functools.reduce(Column.__and__, conditions, F.lit(True))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    return any_of([text.contains(w) for w in words])


def most_important(listed: Column, order: Sequence[str]) -> Column:
    """The first of ``order`` that the array holds, else its first element, else null."""
    held = F.array(*[F.lit(x) for x in order])
    return F.coalesce(F.try_element_at(F.filter(held, lambda p: F.array_contains(listed, p)), F.lit(1)), F.get(listed, F.lit(0)))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))
