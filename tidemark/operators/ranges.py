"""Cutting a table into ranges of its primary key, for a parallel snapshot.

A key is cut if it is one integer column.  The bounds come from one aggregate over the key
alone; ranges are half-open but the last, computed with exact integers, and disjoint, so
their union is the table.  One Spark partition reads one range.
"""

from __future__ import annotations

import decimal
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Range:
    """Keys from ``low`` to below ``high``; up to ``high`` itself if ``closed``.  Without a column: all rows."""

    column: str | None = None
    low: int | None = None
    high: int | None = None
    closed: bool = False

    def sql(self) -> str:
        """The condition as text for a source that takes predicates."""
        if self.column is None:
            return "1 = 1"
        name = "`" + self.column.replace("`", "``") + "`"
        if self.closed and self.low == self.high:
            return f"{name} = {self.low}"
        return f"{name} >= {self.low} AND {name} {'<=' if self.closed else '<'} {self.high}"

    def holds(self) -> Column:
        if self.column is None:
            return F.lit(True)
        key = F.col("`" + self.column.replace("`", "``") + "`")
        bound = lambda v: F.lit(decimal.Decimal(v)) if abs(v) >= 1 << 63 else F.lit(v)
        if self.closed and self.low == self.high:
            return key == bound(self.low)
        return (key >= bound(self.low)) & ((key <= bound(self.high)) if self.closed else (key < bound(self.high)))


def as_integer(value: Any) -> int | None:
    """An exact integer from what a source's driver returns; None if it is not one."""
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, int):
        return value
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else None
    if isinstance(value, (bytes, bytearray)):
        value = bytes(value).decode("ascii", "replace")
    if isinstance(value, str):
        text = value[1:] if value[:1] in "+-" else value
        return int(value) if text.isascii() and text.isdigit() else None
    return None


def split(low: int, high: int, parts: int) -> list[tuple[int, int]]:
    """Bounds of up to ``parts`` neighbouring ranges of near equal width; the last includes ``high``."""
    span = high - low + 1
    parts = max(1, min(parts, span))
    cuts = [low + span * i // parts for i in range(parts)] + [high]
    return list(zip(cuts, cuts[1:], strict=False))


def plan_ranges(low: Any, high: Any, column: str | None, parts: int) -> list[Range]:
    """Ranges for the bounds of a key; one range of all rows where it cannot be cut."""
    a, b = as_integer(low), as_integer(high)
    if column is None or parts <= 1 or a is None or b is None or b < a:
        return [Range()]
    if a == b:
        return [Range(column, a, a, True)]
    bounds = split(a, b, parts)
    return [Range(column, lo, hi, i == len(bounds) - 1) for i, (lo, hi) in enumerate(bounds)]


def cuttable(schema: T.StructType, key: Sequence[str]) -> str | None:
    """The key column, if the key is one integer column."""
    if len(key) != 1:
        return None
    kind = schema[key[0]].dataType
    whole = isinstance(kind, T.IntegralType) or isinstance(kind, T.DecimalType) and kind.scale == 0
    return key[0] if whole else None


def ranges_of(table: DataFrame, key: Sequence[str], parts: int) -> list[Range]:
    column = cuttable(table.schema, key)
    if column is None or parts <= 1:
        return [Range()]
    low, high = table.agg(F.min(column), F.max(column)).first()
    return plan_ranges(low, high, column, parts)
