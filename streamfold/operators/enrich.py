"""Backward as-of enrichment.

Each left row (trade) takes the latest right row (quote) of the same key
whose order is at or before its own; a quote sorts before a trade at equal
time.  Inner semantics: a trade with no earlier quote gives no row.  The
quote travels as one struct, so a NULL field of the newest quote stays
NULL instead of being filled from an older quote.

Plan, the same for every input (no key is ever gathered whole into one task):

1. Union both sides, tagged, with ``chunk = floor(time / chunk_ms)``, dealt
   out by (key, chunk) once; every later step reads that exchange, so each
   input is scanned and decoded once.
2. Per (key, chunk) the last quote and whether the chunk holds a trade.
3. The last quote of all earlier chunks is carried to each trade chunk at two
   levels: inside a span of ``SPAN_CHUNKS`` chunks by a window over the chunk
   rows of (key, span), and from earlier spans by a window over the span rows
   of a key.
4. The union is joined to that carry table on (key, chunk) and a running
   ``last(ignorenulls)`` window runs inside each (key, chunk); the join and
   the window share one hash partitioning.  Result: ``coalesce(in-chunk
   quote, carried quote)``.

What a window holds: the rows of one key in ``chunk_ms`` (one second by
default), ``SPAN_CHUNKS`` chunk rows, or one row per span of a key (about 7,700
a year).  None grows with a key's share of the data otherwise; a key with
more rows a second than a task can sort needs a smaller ``chunk_ms``, down to
0.001.  Nothing is broadcast by force, and no statistics choose the plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamfold.functions.scalar import floor_div, pct_change

CHUNK_MS = 1000
# Chunks whose carried quotes one window handles.
SPAN_CHUNKS = 4096


def asof_latest(left: DataFrame, right: DataFrame, key: list[str], ts_col: str, seq_col: str,
                right_cols: list[str], prefix: str = "", chunk_ms: float = CHUNK_MS,
                right_ts_col: str | None = None, right_seq_col: str | None = None,
                span_chunks: int = SPAN_CHUNKS) -> DataFrame:
    """Inner backward as-of join; returns left columns + prefixed right columns.

    Order on both sides is ``(ts_col, seq_col)``; at equal time the right
    row comes first.  Rows with a NULL key never match.
    """
    right_ts_col = right_ts_col or ts_col
    right_seq_col = right_seq_col or seq_col
    left_cols = left.columns
    not_null = lambda df: df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key]))

    q_struct = F.struct(*[F.col(c) for c in right_cols])
    l_struct = F.struct(*[F.col(c) for c in left_cols])
    q_type, l_type = l_struct_type(right, right_cols), l_struct_type(left, left_cols)
    q = not_null(right).select(
        *[F.col(k) for k in key],
        F.col(right_ts_col).cast("timestamp").alias("_t"), F.lit(0).alias("_kind"),
        F.col(right_seq_col).cast("long").alias("_s"),
        q_struct.alias("_q"), F.lit(None).cast(l_type).alias("_l"))
    t = not_null(left).select(
        *[F.col(k) for k in key],
        F.col(ts_col).cast("timestamp").alias("_t"), F.lit(1).alias("_kind"),
        F.col(seq_col).cast("long").alias("_s"),
        F.lit(None).cast(q_type).alias("_q"), l_struct.alias("_l"))
    width = F.lit(max(1, int(chunk_ms * 1000))).cast("long")
    # never null, so that no join adds a filter of its own below the exchange
    number = lambda c, w: F.coalesce(floor_div(c, w), F.lit(0))
    u = (q.unionByName(t).filter(F.col("_t").isNotNull())
         .withColumn("_chunk", number(F.unix_micros("_t"), width)).repartition(*key, "_chunk"))

    # chunk rows: is a trade in the chunk, and the last quote of the chunk; every branch uses all columns
    # and filters none, so that all read the same exchange
    order = F.when(F.col("_kind") == 0, F.struct("_t", "_s"))
    chunks = (u.groupBy(*key, "_chunk")
              .agg(F.max_by("_q", order).alias("_chunk_q"), F.max(F.col("_l").isNotNull()).alias("_is_t"))
              .withColumn("_span", number(F.col("_chunk"), F.lit(span_chunks))))
    before = lambda w: w.rangeBetween(Window.unboundedPreceding, -1)
    inside = before(Window.partitionBy(*key, "_span").orderBy("_chunk"))
    across = before(Window.partitionBy(*key).orderBy("_span"))
    spans = (chunks.groupBy(*key, "_span")
             .agg(F.max_by("_chunk_q", F.when(F.col("_chunk_q").isNotNull(), F.col("_chunk"))).alias("_span_q"),
                  F.max("_is_t").alias("_any_t"))
             .withColumn("_from_span", F.last("_span_q", ignorenulls=True).over(across))
             .filter("_any_t").select(*key, "_span", "_from_span"))
    carry = (chunks.withColumn("_in_span", F.last("_chunk_q", ignorenulls=True).over(inside))
             .filter("_is_t").join(spans, [*key, "_span"])
             .select(*key, "_chunk", F.coalesce("_in_span", "_from_span").alias("_carry")))

    in_w = (Window.partitionBy(*key, "_chunk").orderBy("_t", "_kind", "_s")
            .rowsBetween(Window.unboundedPreceding, 0))
    joined = u.join(carry, [*key, "_chunk"], "inner")
    got = joined.withColumn("_hit", F.coalesce(F.last("_q", ignorenulls=True).over(in_w), F.col("_carry")))
    out = got.filter((F.col("_kind") == 1) & F.col("_hit").isNotNull())
    # the left row whole, by a generator, so that a caller's narrower selection does not change the exchange
    return out.select(F.inline(F.array("_l")), *[F.col("_hit")[c].alias(prefix + c) for c in right_cols])


def l_struct_type(df: DataFrame, cols: list[str]):
    return df.select(F.struct(*[F.col(c) for c in cols]).alias("x")).schema["x"].dataType


# Quote fields attached to each trade, and their names in the
# enriched record.
QUOTE_FIELDS = ["current", "high", "low", "open", "prev_close"]


def enrich_trades(trades: DataFrame, quotes: DataFrame, ts_col: str = "_ts", seq_col: str = "_seq",
                  key: str = "symbol", **options) -> DataFrame:
    """J1 + P4: trades with the latest quote of their symbol and the percent
    change against the quote's previous close."""
    e = asof_latest(trades, quotes, [key], ts_col, seq_col, QUOTE_FIELDS, prefix="quote_", **options)
    return e.withColumn("pct_change", pct_change("price", "quote_prev_close"))
