"""Custom stateful stream operator (A4 stream).

It runs as a ``transformWithStateInPandas`` processor keyed by the merge
key; Spark partitions the keys over executors, keeps the state in its
fault-tolerant state store (RocksDB) and checkpoints it with the query.
Inside a group the work on one micro-batch is vectorised pandas.  Columns
handed to pandas get plain names (no leading underscore: those are
renamed positionally on the way in).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark) -> None:
    """transformWithState needs the RocksDB state store provider."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _rank(order: tuple) -> tuple:
    """Order keys as comparable pairs, NULL before everything."""
    return tuple((v is not None, v if v is not None else 0) for v in order)


def _plain(v):
    """A pandas scalar as a Python value, its missing values as None."""
    if v is None or v is pd.NaT or (isinstance(v, float) and np.isnan(v)):
        return None
    return v.item() if hasattr(v, "item") else v


class IdleMerge(StatefulProcessor):
    """A4 on a stream: per key the latest non-null value of every column with
    its order key, in a value state with a TTL; a key idle longer than the
    TTL starts again from NULL.  A row with an older order does not replace a
    newer value, in whatever batch it arrives.  Emits the key's merged row
    after every batch that touches it (update semantics)."""

    def __init__(self, key: list[str], value_schema: T.StructType, order_fields: list[T.StructField], ttl_ms: int):
        self.key, self.ttl_ms = list(key), ttl_ms
        self.cols = [f.name for f in value_schema.fields]
        self.orders = [f.name for f in order_fields]
        # column i, then its order keys
        self.schema = T.StructType([x for i, f in enumerate(value_schema.fields) for x in
                                    [T.StructField(f"v{i}", f.dataType),
                                     *[T.StructField(f"v{i}_{o.name}", o.dataType) for o in order_fields]]])

    def init(self, handle) -> None:
        self.state = handle.getValueState("merged", self.schema, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        width = 1 + len(self.orders)
        best: dict = {}
        if self.state.exists():
            held = list(self.state.get())
            for i, c in enumerate(self.cols):
                value, *order = held[i * width:(i + 1) * width]
                if value is not None:
                    best[c] = (_rank(tuple(order)), value, tuple(order))
        # fold the key's rows chunk by chunk (no concat): one stable sort per
        # chunk; per column the last non-null row
        for pdf in rows:
            pdf = pdf.sort_values(self.orders, kind="stable", na_position="first").reset_index(drop=True)
            for c in self.cols:
                i = pdf[c].last_valid_index()
                if i is None:
                    continue
                order = tuple(_plain(pdf[o].iloc[i]) for o in self.orders)
                if c not in best or _rank(order) >= best[c][0]:
                    best[c] = (_rank(order), _plain(pdf[c].iloc[i]), order)
        none = (None, None, (None,) * len(self.orders))
        found = [best.get(c, none) for c in self.cols]
        self.state.update(tuple(x for _, value, order in found for x in (value, *order)))
        yield pd.DataFrame([[*key, *[value for _, value, _ in found]]], columns=[*self.key, *self.cols])

    def close(self) -> None:
        pass


def idle_merge_stream(df: DataFrame, key, value_cols: list[str], order_cols: list[str],
                      ttl_seconds: int = 3600) -> DataFrame:
    """Streaming A4 (processing-time TTL, refreshed on every write).
    ``key``: one column name or a list (composite key).  Order columns that
    are time stamps go by their microseconds."""
    key = [key] if isinstance(key, str) else list(key)
    fields = {f.name: f for f in df.schema.fields}
    vschema = T.StructType([T.StructField(c, fields[c].dataType) for c in value_cols])
    out = T.StructType([T.StructField(k, fields[k].dataType) for k in key] + list(vschema.fields))

    def comparable(c):
        kind = fields[c].dataType
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return F.unix_micros(F.col(c).cast("timestamp"))
        return F.col(c).cast("string" if isinstance(kind, T.StringType) else "long")

    src = df.select(*key, *value_cols, *[comparable(c).alias(f"o{i}") for i, c in enumerate(order_cols)])
    orders = [src.schema[f"o{i}"] for i in range(len(order_cols))]
    return src.groupBy(*key).transformWithStateInPandas(
        IdleMerge(key, vschema, orders, int(ttl_seconds * 1000)), out, "Update", "ProcessingTime")
