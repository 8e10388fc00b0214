"""Cleaning, remapping and comparison of columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_quotes(text: Column | str) -> Column:
    """Text without any double quote."""
    return F.translate(text, '"', "")


def remap(value: Column | str, mapping: Mapping[int, int]) -> Column:
    """Replace all listed values at once; a replaced value is not replaced again."""
    value = F.col(value) if isinstance(value, str) else value
    cases = reduce(lambda acc, kv: acc.when(value == kv[0], F.lit(kv[1])), mapping.items(), F)
    return cases.otherwise(value)


def any_differs(left: str, right: str, columns: Iterable[str], null_as_empty: Iterable[str] = ()) -> Column:
    """True if any of ``columns`` differs between the structs ``left`` and ``right``; never NULL.

    A NULL on either side counts as no difference, except in ``null_as_empty``,
    where NULL stands for the empty string.
    """
    as_empty = set(null_as_empty)

    def differs(name: str) -> Column:
        a, b = F.col(f"{left}.{name}"), F.col(f"{right}.{name}")
        if name in as_empty:
            a, b = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
        return a != b

    return F.coalesce(reduce(Column.__or__, [differs(c) for c in columns]), F.lit(False))
