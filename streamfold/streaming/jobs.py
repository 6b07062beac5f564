"""Streaming queries (T3, T5, T7, T8, T9) built from the batch operators.

The operators are plain DataFrame transformations, so the same code runs
on a streaming DataFrame; this module only adds sources, triggers,
checkpoints and sinks.  Every query checkpoints under the shared folder
(``spark.checkpoint.dir``), and every sink is idempotent per query and batch, so a
restarted query replays from its checkpoint without losing or doubling
rows (the reference's failed flush drops rows; this does not).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamfold.operators import align, merge
from streamfold.session import checkpoint_subdir
from streamfold.sinks.stores import append_batch, append_column_store, query_id, topic_rows
from streamfold.sources.tables import ENVELOPE
from streamfold.sources.topics import KAFKA_ORDER, decode_json

# Checkpoint every 10 s; the consumer flushes every second.
CHECKPOINT_INTERVAL = "10 seconds"
FLUSH_INTERVAL = "1 second"


def envelope_files_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Offline topic stream: parquet files of envelope rows (topic, key,
    value, partition, offset, timestamp, timestampType)."""
    return (spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def decoded_stream(messages: DataFrame, fields, mode: str = "skip") -> DataFrame:
    if mode == "fail":
        return decode_json(messages, fields, mode="FAILFAST")
    return decode_json(messages, fields, drop_bad=True)


def _started(rows: DataFrame, each, name: str, mode: str, trigger: str, checkpoint: str):
    return (rows.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(processingTime=trigger).queryName(name).start())


def _owner(spark: SparkSession, checkpoint: str):
    """The id of the query that runs on a checkpoint, read once it runs."""
    known = []

    def get() -> str:
        if not known:
            known.append(query_id(spark, checkpoint))
        return known[0]

    return get


def start_merge(merged: DataFrame, path: str | None, name: str, trigger: str = CHECKPOINT_INTERVAL,
                checkpoint: str | None = None, writer=None, mode: str = "update"):
    """T8 + K1: the changed rows of every micro-batch, whose merge the stream's
    state holds, to ``writer(batch, batch_id)`` or to the folder of their query
    and batch under ``path``; ``stores.newest_rows`` reads the current table."""
    spark = merged.sparkSession
    ck = checkpoint or checkpoint_subdir(spark, os.path.join("streams", name))
    owner = _owner(spark, ck)
    each = writer or (lambda b, i: append_batch(b.withColumn("_at", F.current_timestamp()), path, i, owner()))
    return _started(merged, each, name, mode, trigger, ck)


def start_append(rows: DataFrame, path: str, key: list[str], name: str,
                 trigger: str = FLUSH_INTERVAL, checkpoint: str | None = None, writer=None, mode: str = "append"):
    """K3: append the aligned rows, sorted by key within files, one folder per
    query and batch (a replay overwrites its own folder), or hand them to
    ``writer(batch, batch_id)``.  T5: read with ``min_offsets_per_trigger`` and
    ``max_trigger_delay`` for the reference's flush at 500 rows or 1 s."""
    spark = rows.sparkSession
    ck = checkpoint or checkpoint_subdir(spark, os.path.join("streams", name))
    owner = _owner(spark, ck)
    each = writer or (lambda b, i: append_column_store(b, path, key, batch_id=i, owner=owner()))
    return _started(rows, each, name, mode, trigger, ck)


def start_fanout(rows: DataFrame, writers: dict, name: str, trigger: str = FLUSH_INTERVAL,
                 checkpoint: str | None = None):
    """Several sinks from one query: the batch is persisted once and
    every writer ``(batch_df, batch_id)`` gets it."""
    spark = rows.sparkSession
    ck = checkpoint or checkpoint_subdir(spark, os.path.join("streams", name))

    def each(batch: DataFrame, batch_id: int):
        batch.persist()
        try:
            for w in writers.values():
                w(batch, batch_id)
        finally:
            batch.unpersist()

    return (rows.writeStream.foreachBatch(each).option("checkpointLocation", ck)
            .trigger(processingTime=trigger).queryName(name).start())


def doc_merge_stream(sources: dict[str, DataFrame], sink_fields, key, mapping, order) -> DataFrame:
    """Decoded source streams -> P1 -> union -> A1 (a streaming aggregation)."""
    frames = [align.align_mapped(df, sid, sink_fields, mapping, passthrough=tuple(order))
              for sid, df in sources.items()]
    return merge.merge_latest_nonnull(merge.union_all(frames), sink_fields, key, order)


def windowed_counts(events: DataFrame, ts_col: str, name_col: str, interval: str = "60 seconds",
                    watermark: str = "5 seconds") -> DataFrame:
    """T9 (+ T1 as an extension): tumbling counts per name on event time
    with a watermark, for append output."""
    ts = F.col(ts_col).cast("timestamp")
    return (events.withColumn("_ets", ts).withWatermark("_ets", watermark)
            .groupBy(F.window("_ets", interval).alias("w"), F.col(name_col).alias("name"))
            .agg(F.count("*").alias("total"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "name", "total"))


class Started(dict):
    """The running queries by name, and ``errors``: what could not be started."""

    def __init__(self):
        super().__init__()
        self.errors: dict[str, str] = {}


def start_spec(spark: SparkSession, spec, topic_reader, out_dir: str, name: str = "spec",
               trigger: str = CHECKPOINT_INTERVAL, checkpoint_root: str | None = None,
               writers: dict | None = None, strict: bool = True, ttl_seconds: int | None = None,
               messages: DataFrame | None = None, order=KAFKA_ORDER, now=None, on_counters=None) -> Started:
    """X2 on streams: one query (``fanin.FanIn``) for the sinks of the spec.

    ``spec`` is the graph, or a function that reads it anew for every batch, so
    routes change without a restart (S6).  ``topic_reader(topic)`` returns a
    streaming envelope DataFrame (e.g. ``read_topic``); ``messages`` may hold
    all topics instead (a subscription by pattern, so new topics join).
    ``writers[node_type](rows, batch_id, node)`` writes what a micro-batch
    changes (``fanin.sink_increment``) to that kind of store, e.g. the ones of
    ``sinks.guarded``; without one the rows go to files under
    ``out_dir/<sink>``, read by ``fanin.stored_result``.  With ``ttl_seconds``
    a document sink of several sources keeps its merge in stream state, as a
    query of its own, and so does each ``INSERT INTO <sink>`` of a node's text
    (X1).  A sink that cannot be built raises before anything starts, or with
    ``strict=False`` is left out and named in ``errors``.
    """
    from streamfold.plans import spec as X
    from streamfold.streaming import fanin

    load = spec if callable(spec) else lambda: spec
    graph = load()
    nodes = {n["id"]: n for n in graph["nodes"]}
    edges = graph.get("edges", [])
    started = Started()

    def folder(query: str) -> str:
        return (os.path.join(checkpoint_root, query) if checkpoint_root
                else checkpoint_subdir(spark, os.path.join("streams", query)))

    # what each query would be, built before any of them starts
    own, shared, plans = {}, [], {}
    for sid in X.sink_ids(graph):
        feeds = X.sink_sources(nodes[sid], nodes, edges)
        if not feeds:
            continue
        try:
            if nodes[sid]["node_type"] == X.MONGODB and ttl_seconds and len(feeds) > 1:
                own[sid] = X.build_sink(nodes[sid], nodes, edges, topic_reader, order=order, ttl_seconds=ttl_seconds)
            else:
                fields = X.node_fields(nodes[sid])
                merge.check_key(fields, X.node_key(nodes[sid], fields))
                for s in feeds:
                    X.node_fields(nodes[s])
                shared.append(sid)
        except Exception as ex:  # noqa: BLE001
            started.errors[sid] = f"{type(ex).__name__}: {ex}"
    for job in X.node_inserts(graph, started.errors):
        try:
            plans[job.name] = (job, X.insert_rows(spark, job, graph, topic_reader))
        except Exception as ex:  # noqa: BLE001
            started.errors[job.name] = f"{type(ex).__name__}: {ex}"
    if started.errors and strict:
        raise ValueError(f"sinks failed to build: {started.errors}")

    if own:
        from streamfold.streaming.state import use_rocksdb
        use_rocksdb(spark)          # the TTL merge keeps its state in RocksDB

    def writer_of(node):
        store = (writers or {}).get(node["node_type"])
        return (lambda b, i: store(b, i, node)) if store else None

    for sid, merged in own.items():
        started[sid] = start_merge(merged, os.path.join(out_dir, sid), f"{name}_{sid}", trigger,
                                   folder(f"{name}_{sid}"), writer_of(nodes[sid]))
    for query, (job, rows) in plans.items():
        mode = "update" if X.is_aggregated(rows) else "append"
        path = os.path.join(out_dir, job.sink["id"])
        common = {"trigger": trigger, "checkpoint": folder(f"{name}_{query}"), "writer": writer_of(job.sink)}
        if job.sink["node_type"] == X.CLICKHOUSE:
            key = X.node_key(job.sink, X.node_fields(job.sink))
            started[query] = start_append(rows, path, key, f"{name}_{query}", mode=mode, **common)
        else:
            started[query] = start_merge(rows, path, f"{name}_{query}", mode=mode, **common)
    if shared or callable(spec):
        if messages is None:
            topics = dict.fromkeys(s for sid in shared for s in X.sink_sources(nodes[sid], nodes, edges))
            by_topic = {X.node_topic(nodes[s]): nodes[s] for s in topics}       # each topic is read once
            messages = merge.union_all([X.read_node(topic_reader, n) for n in by_topic.values()])
        left_out = set(own) | set(started.errors)
        work = fanin.FanIn(spark, load, out_dir, folder(name), lambda sid: sid not in left_out, writers, order, now,
                           on_counters)
        started["fanin"] = fanin.start_fanin(messages, work, name, trigger)
    return started


# Node properties that say where a store is and what to write.
STORE_PROPERTIES = ("uri", "host", "port", "database", "collection", "keyspace", "table", "primary_key")


def store_options(node: dict) -> dict:
    """Connector options a sink node names."""
    props = node.get("properties") or {}
    return {k: props[k] for k in STORE_PROPERTIES if props.get(k) not in (None, "")}


def start_enrichment(trades: DataFrame, quotes: DataFrame, name: str, checkpoint: str | None = None,
                     trigger: str = FLUSH_INTERVAL, writer=None, bootstrap: str | None = None,
                     topic: str = "enriched"):
    """The enrichment job: trade and quote messages (envelopes) are decoded
    (S7, S8), each trade takes the latest quote of its symbol (J1, ``asof``)
    and its percent change (P4), and leaves as a keyed message (K4) for
    ``writer(messages, batch_id)`` or a Kafka topic (at least once, as Kafka
    writes are)."""
    from streamfold.functions.scalar import pct_change
    from streamfold.operators.enrich import QUOTE_FIELDS
    from streamfold.sinks.stores import kafka_sink_options
    from streamfold.sources.topics import decode_quotes, decode_trades
    from streamfold.streaming.asof import start_asof

    seq = (F.col("_offset") * 1000 + F.col("_tick_idx")).alias("seq")
    t = decode_trades(trades).select("symbol", "price", "volume", "timestamp", F.col("_kafka_ts").alias("at"), seq)
    q = decode_quotes(quotes, with_fetched_at=False).select(
        "symbol", *QUOTE_FIELDS, F.col("_kafka_ts").alias("at"), F.col("_offset").alias("seq"))

    def write(rows: DataFrame, batch_id: int) -> None:
        rows = rows.withColumn("pct_change", pct_change("price", "quote_prev_close")).drop("at", "seq")
        messages = topic_rows(rows, "symbol")
        if writer is not None:
            writer(messages, batch_id)
        else:
            messages.write.format("kafka").options(**kafka_sink_options(bootstrap, topic)).save()

    return start_asof(t, q, ["symbol"], "at", "seq", QUOTE_FIELDS, name, write, checkpoint=checkpoint, trigger=trigger)
