"""Sink declarations used by the registered queries and the benchmark.

They mirror the shape of the reference's seeded pipelines: several topics
fanned into one keyed sink per store kind.
"""

from __future__ import annotations

from pyspark.sql import types as T

from streamfold.functions.schema import Field

# The document sink (latest non-null merge) and its field
# mapping {sink index: {source_node_id, source_field}}.
DOC_FIELDS = [
    Field("symbol", "STRING"), Field("price", "DOUBLE"), Field("volume", "DOUBLE"),
    Field("quote_current", "DOUBLE"), Field("quote_prev_close", "DOUBLE"),
    Field("clicks_k", "BIGINT"), Field("timestamp", "BIGINT"),
]
DOC_MAPPING = {
    "0": {"source_node_id": "trades", "source_field": "symbol"},
    "1": {"source_node_id": "trades", "source_field": "price"},
    "2": {"source_node_id": "trades", "source_field": "volume"},
    "3": {"source_node_id": "quotes", "source_field": "current"},
    "4": {"source_node_id": "quotes", "source_field": "prev_close"},
    "5": {"source_node_id": "clicks", "source_field": "k"},
    "6": {"source_node_id": "trades", "source_field": "timestamp"},
}
DOC_KEY = ["symbol"]

# The wide-column sink (last row wins), aligned by name.
WIDE_FIELDS = [
    Field("symbol", "STRING"), Field("price", "DOUBLE"), Field("volume", "DOUBLE"),
    Field("current", "DOUBLE"), Field("prev_close", "DOUBLE"), Field("k", "BIGINT"),
    Field("timestamp", "BIGINT"),
]
WIDE_KEY = ["symbol"]

# A pre-existing column-store table with some NOT NULL
# columns no source supplies (one per type), aligned by name.
COLUMN_DEST = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("price", T.DoubleType(), False),
    T.StructField("volume", T.DoubleType(), True),
    T.StructField("current", T.DoubleType(), True),
    T.StructField("k", T.LongType(), False),
    T.StructField("note", T.StringType(), False),
    T.StructField("active", T.BooleanType(), False),
    T.StructField("updated", T.TimestampNTZType(), False),
    T.StructField("timestamp", T.LongType(), False),
])
