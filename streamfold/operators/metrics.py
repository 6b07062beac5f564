"""Activity metrics per interval.

Counters and latency samples are rows (name, time, amount or seconds); a
tumbling window on event time turns them into the per-interval summary
(the reference resets in-process counters every 60 s; on event time the
same numbers are reproducible).  Everything is a ``groupBy(window, name)``
with partial aggregation; in a stream add ``withWatermark`` first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamfold.functions.scalar import lag_seconds


def _window(ts_col: str, interval: str) -> Column:
    return F.window(F.col(ts_col), interval)


def counter_totals(df: DataFrame, ts_col: str, name_col: str, amount_col: str | None = None,
                   interval: str = "60 seconds") -> DataFrame:
    """A5: per window and counter name, the sum of increments (1 per row
    when no amount column)."""
    amount = F.lit(1).cast("long") if amount_col is None else F.col(amount_col)
    g = df.groupBy(_window(ts_col, interval).alias("w"), F.col(name_col).alias("name"))
    return g.agg(F.sum(amount).alias("total")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "name", "total")


def latency_summary(df: DataFrame, ts_col: str, name_col: str, seconds_col: str,
                    interval: str = "60 seconds") -> DataFrame:
    """Per window and bucket: n, min, avg, max in ms rounded to 0.1.
    A bucket with no samples in a window has no row."""
    ms = F.col(seconds_col) * 1000
    g = df.filter(F.col(seconds_col).isNotNull()).groupBy(
        _window(ts_col, interval).alias("w"), F.col(name_col).alias("name"))
    return g.agg(F.count("*").alias("n"),
                 F.round(F.min(ms), 1).alias("min_ms"),
                 F.round(F.avg(ms), 1).alias("avg_ms"),
                 F.round(F.max(ms), 1).alias("max_ms")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        "name", "n", "min_ms", "avg_ms", "max_ms")


def consumer_lag(messages: DataFrame, now: Column | None = None) -> DataFrame:
    """Lag in seconds of every message, for broker CreateTime stamps
    only (``timestampType = 0``), never negative."""
    now = F.current_timestamp() if now is None else now
    return (messages.filter(F.col("timestampType") == 0)
            .withColumn("lag_s", lag_seconds(now, F.col("timestamp"))))
