"""Values at the edges: wall clocks on the way in, JSON on the way out, text for logs."""

from __future__ import annotations

import base64
import datetime as dt
import decimal
import math
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(value: dt.datetime) -> dt.datetime:
    """The digits a clock showed, whatever its zone."""
    return value.replace(tzinfo=None)


def wall_clock_column(ts: Column) -> Column:
    """A timestamp's digits in the session's zone, as a timestamp without zone."""
    return ts.cast("timestamp_ntz")


def rfc3339(value: dt.datetime) -> str:
    """UTC with as many fractional digits as needed."""
    value = value.astimezone(dt.timezone.utc).replace(tzinfo=None) if value.tzinfo else value
    text = value.strftime("%Y-%m-%dT%H:%M:%S").rjust(19, "0")
    return text + (f".{value.microsecond:06d}".rstrip("0") if value.microsecond else "") + "Z"


def to_json(value: Any) -> Any:
    """A collected cell as JSON can hold it: decimals as numbers, bytes as text, times as RFC 3339."""
    if isinstance(value, dt.datetime):
        return rfc3339(value)
    if isinstance(value, dt.date):
        return rfc3339(dt.datetime(value.year, value.month, value.day))
    if isinstance(value, decimal.Decimal):
        whole = value == value.to_integral_value() and value.as_tuple().exponent == 0
        if whole:
            return int(value) if -(1 << 63) <= value < 1 << 63 else str(value)
        return float(value)
    if isinstance(value, (bytes, bytearray)):
        try:
            return bytes(value).decode()
        except UnicodeDecodeError:
            return base64.b64encode(bytes(value)).decode()
    if isinstance(value, float) and not math.isfinite(value):
        return str(value)
    if hasattr(value, "asDict"):
        return {k: to_json(v) for k, v in value.asDict().items()}
    if isinstance(value, dict):
        return {str(to_json(k)): to_json(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [to_json(v) for v in value]
    return value if value is None or isinstance(value, (bool, int, float, str)) else str(value)


def rfc3339_column(ts: Column) -> Column:
    text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(text, r"\.?0{0,6}$", ""), F.lit("Z"))


def shortened(text: Column, most: int) -> Column:
    """One line of at most ``most`` characters, for logs."""
    return F.left(F.translate(text, "\n", " "), F.lit(most))
