"""Fan-in merges.

N aligned projections are unioned and folded per key.  Every rule takes an
explicit total order (``order_cols``), because arrival order is not
reproducible; keep it through the union.  ``struct(ts, id)`` in tests,
``struct(timestamp, topic, partition, offset)`` on a topic.

All keyed merges are a single ``groupBy(key).agg(...)`` built from
``max_by``/``max``: those have partial (map-side) aggregation, so a hot key
holding a large share of the rows is reduced to one row per map task before
the shuffle and never lands whole in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamfold.functions.scalar import floor_div
from streamfold.functions.schema import as_fields


# Chunk of the rows without a time: before every real one.
NO_TIME_CHUNK = -(1 << 62)
# Chunks whose sessions one window finds.
SPAN_CHUNKS = 4096


def _order(order_cols) -> Column:
    """The order as one struct: never NULL itself, so a row whose order column
    is NULL still counts, before all others."""
    return F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_cols])


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL of aligned projections (by name)."""
    if not frames:
        raise ValueError("a sink needs at least one source")
    return reduce(lambda a, b: a.unionByName(b), frames)


def _value_cols(fields, key):
    ks = set(key)
    return [f.name for f in as_fields(fields) if f.name not in ks]


def check_key(fields, key):
    names = [f.name for f in as_fields(fields)]
    missing = [k for k in key if k not in names]
    if missing:
        raise ValueError(f"key columns {missing} are not sink fields")


def merge_latest_nonnull(df: DataFrame, sink_fields, key: list[str], order_cols) -> DataFrame:
    """A1: per key, the latest non-null value of every non-key column.

    A column never set for a key stays NULL; a NULL key forms its own group.
    ``max_by`` skips rows whose order is NULL, so masking the order where the
    value is NULL gives "latest non-null" in one pass.
    """
    check_key(sink_fields, key)
    order = _order(order_cols)
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c)
            for c in _value_cols(sink_fields, key)]
    # a sink of keys alone: one row per key
    out = df.groupBy(*key).agg(*aggs) if aggs else df.select(*key).distinct()
    return out.select(*[f.name for f in as_fields(sink_fields)])


def partial_nonnull(df: DataFrame, sink_fields, key: list[str], order_cols) -> DataFrame:
    """What A1 needs of one batch: per key and column the latest non-null
    value, and its order in ``_o_<column>``.  ``fold_nonnull`` over the
    increments of any batches, in any order and repeated, is A1 over all their
    rows."""
    check_key(sink_fields, key)
    order, aggs = _order(order_cols), []
    for c in _value_cols(sink_fields, key):
        o = F.when(F.col(c).isNotNull(), order)
        aggs += [F.max_by(F.col(c), o).alias(c), F.max(o).alias(f"_o_{c}")]
    return df.groupBy(*key).agg(*aggs) if aggs else df.select(*key).distinct()


def fold_nonnull(parts: DataFrame, sink_fields, key: list[str]) -> DataFrame:
    """A1 from the increments of ``partial_nonnull``."""
    check_key(sink_fields, key)
    aggs = [F.max_by(F.col(c), F.col(f"_o_{c}")).alias(c) for c in _value_cols(sink_fields, key)]
    out = parts.groupBy(*key).agg(*aggs) if aggs else parts.select(*key).distinct()
    return out.select(*[f.name for f in as_fields(sink_fields)])


def last_rows(df: DataFrame, sink_fields, key: list[str], order_cols) -> DataFrame:
    """What A2 needs of one batch: the last row of each key with its order
    columns; rows with a NULL key are left out (``null_key_rows``).
    ``upsert_last_row`` over the increments is A2 over all rows."""
    cols = list(dict.fromkeys([*[f.name for f in as_fields(sink_fields)], *order_cols]))
    ok = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    return (df.filter(ok).groupBy(*key)
            .agg(F.max_by(F.struct(*cols), _order(order_cols)).alias("_row")).select("_row.*"))


def upsert_last_row(df: DataFrame, sink_fields, key: list[str], order_cols) -> DataFrame:
    """A2: per key the whole last row wins, NULLs included.

    Rows with a NULL key component are not upserted (the store rejects
    them); route them with ``null_key_rows``.
    """
    check_key(sink_fields, key)
    vals = _value_cols(sink_fields, key)
    ok = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    if not vals:
        return df.filter(ok).select(*[f.name for f in as_fields(sink_fields)]).distinct()
    out = (df.filter(ok)
           .groupBy(*key)
           .agg(F.max_by(F.struct(*vals), _order(order_cols)).alias("_row")))
    return out.select(*key, *[F.col("_row")[c].alias(c) for c in vals]) \
              .select(*[f.name for f in as_fields(sink_fields)])


def null_key_rows(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows an upsert sink must reject (any key component NULL)."""
    bad = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return df.filter(bad)


def append_fanin(frames: list[DataFrame]) -> DataFrame:
    """A3: every aligned row of every source is kept; nothing merged."""
    return union_all(frames)


def merge_idle_ttl(df: DataFrame, sink_fields, key: list[str], order_cols, ts_col: str,
                   ttl_seconds: int = 3600) -> DataFrame:
    """A4: A1 where a key idle for more than ``ttl_seconds`` starts again
    from NULL (batch model of a state TTL refreshed on every write).

    The key's rows split into sessions wherever consecutive rows are more
    than ``ttl_seconds`` apart; the result is A1 over the last session.  A row
    without a time is older than any other: it counts only for a key that has
    no row with a time.

    Plan, chosen so no key is ever gathered into one task:

    1. Bucket rows into chunks of width ``ttl_seconds``.  Two rows in one
       chunk are less than the TTL apart, so a session can only start at
       the first row of a chunk.
    2. One partial aggregation per (key, chunk): first/last time stamp and,
       per column, the latest non-null value with its order.
    3. Which chunks open a session is found at two levels: inside a span of
       ``SPAN_CHUNKS`` chunks by a window over (key, span), and over the span
       rows of a key (about 7,700 a year at a TTL of one second).  So is the
       last session's first chunk.
    4. A second aggregation per key over the chunks of that session.
    """
    check_key(sink_fields, key)
    vals = _value_cols(sink_fields, key)
    order = _order(order_cols)
    ttl_us = int(ttl_seconds * 1_000_000)
    us = F.unix_micros(F.col(ts_col).cast("timestamp"))
    chunked = df.withColumn("_us", us).withColumn(
        "_chunk", F.coalesce(floor_div(F.col("_us"), ttl_us), F.lit(NO_TIME_CHUNK)))

    per_chunk = [F.min("_us").alias("_first"), F.max("_us").alias("_last")]
    for c in vals:
        o = F.when(F.col(c).isNotNull(), order)
        per_chunk.append(F.max_by(F.col(c), o).alias(c))
        per_chunk.append(F.max(o).alias(f"_o_{c}"))
    # the key as one struct: equal where its columns are, NULLs included
    chunks = (chunked.groupBy(*key, "_chunk").agg(*per_chunk)
              .withColumn("_k", F.struct(*key)).withColumn("_span", floor_div(F.col("_chunk"), SPAN_CHUNKS)))

    spans = (chunks.groupBy("_k", "_span").agg(F.max("_last").alias("_span_last"))
             .withColumn("_before", F.lag("_span_last").over(Window.partitionBy("_k").orderBy("_span")))
             .select("_k", "_span", "_before"))
    inside = Window.partitionBy("_k", "_span").orderBy("_chunk")
    prev_last = F.coalesce(F.lag("_last").over(inside), F.col("_before"))
    starts = chunks.join(spans, ["_k", "_span"]).withColumn(
        "_start", prev_last.isNull() | ((F.col("_first") - prev_last) > ttl_us))
    last_start = F.max("_span_start").over(Window.partitionBy("_k")).alias("_last_start")
    sessions = (starts.groupBy("_k", "_span").agg(F.max(F.when(F.col("_start"), F.col("_chunk"))).alias("_span_start"))
                .select("_k", "_span", last_start))
    session = chunks.join(sessions, ["_k", "_span"]).filter(F.col("_chunk") >= F.col("_last_start"))

    aggs = [F.max_by(F.col(c), F.col(f"_o_{c}")).alias(c) for c in vals]
    out = session.groupBy(*key).agg(*aggs) if aggs else session.select(*key).distinct()
    return out.select(*[f.name for f in as_fields(sink_fields)])
