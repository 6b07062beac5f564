"""Scalar helpers, all built-in Spark expressions (JVM side, codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pct_change(price, prev_close, digits: int = 4) -> Column:
    """``round((price - pc) / pc * 100, digits)``; NULL when ``pc`` is
    NULL or zero.  ``try_divide`` keeps ANSI mode from raising."""
    p, pc = _c(price), _c(prev_close)
    return F.when(pc.isNull() | (pc == 0), F.lit(None).cast("double")).otherwise(
        F.round(F.try_divide(p - pc, pc) * 100, digits))


def non_negative(x) -> Column:
    """``max(0, x)``."""
    return F.greatest(F.lit(0).cast("double"), _c(x).cast("double"))


def lag_seconds(now, created) -> Column:
    """Seconds between two time stamps, never negative (consumer lag)."""
    diff = (F.unix_micros(_c(now).cast("timestamp")) - F.unix_micros(_c(created).cast("timestamp"))) / 1e6
    return non_negative(diff)


def to_json_all(*cols) -> Column:
    """JSON object text with NULL fields kept (as ``json.dumps`` writes)."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def contains_ci(col, needle: str | None) -> Column:
    """Case-insensitive substring; a blank needle matches everything."""
    if needle is None or not needle.strip():
        return F.lit(True)
    return F.lower(_c(col)).contains(needle.lower())


def floor_div(x, width) -> Column:
    """Exact integer floor division of a long, also for negatives
    (``width``: a positive int or a long column)."""
    x = _c(x).cast("long")
    w = (width if isinstance(width, Column) else F.lit(width)).cast("long")
    return F.call_function("div", x - F.pmod(x, w), w)


def to_bytes(col) -> Column:
    """String -> UTF-8 bytes (message key/value encoding)."""
    return F.encode(_c(col), "UTF-8")


def from_bytes(col) -> Column:
    """UTF-8 bytes -> string (a Kafka key/value column is binary)."""
    return F.decode(_c(col), "UTF-8")
