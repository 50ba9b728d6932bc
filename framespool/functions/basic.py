"""Small helpers on columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cols(c) -> list[Column]:
    return [col(x) for x in ([c] if isinstance(c, str | Column) else c)]


def micros(c) -> Column:
    """A timestamp as microseconds since 1970 (session zone UTC)."""
    return F.unix_micros(col(c).cast("timestamp"))


def every(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def first_true(rules: list[tuple[Column, object]], otherwise=None) -> Column:
    """The value of the first rule whose condition holds."""
    out = F.lit(otherwise)
    for condition, value in reversed(rules):
        out = F.when(condition, value).otherwise(out)
    return out
