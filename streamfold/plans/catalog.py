"""Registered queries: one per operator of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables (or data Spark derives from them).  Column names match the
DuckDB oracle in ``streamfold.plans.oracle``.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamfold.operators import align, enrich, merge, metrics, routing, runs
from streamfold.plans import sinks_spec as S
from streamfold.plans import spec as X
from streamfold.session import checkpoint_subdir
from streamfold.sinks import guarded, stores
from streamfold.sources import tables as tb
from streamfold.sources import topics as tp
from streamfold.streaming import fanin, jobs

ORDER = tb.ORDER


def _aligned_doc(spark, sf_dir) -> DataFrame:
    src = tb.decoded_sources(spark, sf_dir)
    return merge.union_all([align.align_mapped(df, sid, S.DOC_FIELDS, S.DOC_MAPPING, passthrough=ORDER)
                            for sid, df in src.items()])


def _aligned_wide(spark, sf_dir) -> DataFrame:
    src = tb.decoded_sources(spark, sf_dir)
    return merge.union_all([align.align_null_fill(df, S.WIDE_FIELDS, passthrough=ORDER)
                            for df in src.values()])


def _aligned_column(spark, sf_dir) -> DataFrame:
    src = tb.decoded_sources(spark, sf_dir)
    return merge.append_fanin([align.align_default_fill(df, S.COLUMN_DEST, passthrough=ORDER)
                               for df in src.values()])


def _seq_out(df: DataFrame) -> DataFrame:
    return df.drop("_ts").withColumnRenamed("_seq", "seq")


# ---------------------------------------------------------------- align
def q_align_mapped(spark, sf_dir):
    return _seq_out(_aligned_doc(spark, sf_dir))


def q_align_null_fill(spark, sf_dir):
    return _seq_out(_aligned_wide(spark, sf_dir))


def q_align_default_fill(spark, sf_dir):
    # one source lacking most destination columns: clicks
    df = align.align_default_fill(tb.clicks(spark, sf_dir), S.COLUMN_DEST, passthrough=ORDER)
    return _seq_out(df)


def q_single_source_insert(spark, sf_dir):
    """One source straight into an upsert sink: the last projected row
    per key replaces the document (no per-column merge)."""
    df = align.align_mapped(tb.trades(spark, sf_dir), "trades", S.DOC_FIELDS, S.DOC_MAPPING, passthrough=ORDER)
    return merge.upsert_last_row(df, S.DOC_FIELDS, S.DOC_KEY, ORDER)


# ---------------------------------------------------------------- merges
def q_merge_latest_nonnull(spark, sf_dir):
    return merge.merge_latest_nonnull(_aligned_doc(spark, sf_dir), S.DOC_FIELDS, S.DOC_KEY, ORDER)


def q_upsert_last_row(spark, sf_dir):
    return merge.upsert_last_row(_aligned_wide(spark, sf_dir), S.WIDE_FIELDS, S.WIDE_KEY, ORDER)


def q_append_fanin(spark, sf_dir):
    return _seq_out(_aligned_column(spark, sf_dir))


def q_merge_idle_ttl(spark, sf_dir):
    return merge.merge_idle_ttl(_aligned_doc(spark, sf_dir), S.DOC_FIELDS, S.DOC_KEY, ORDER,
                                ts_col="_ts", ttl_seconds=3600)


# ---------------------------------------------------------------- sources
def _env_out(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("_offset", "offset")


def q_src_json_decode(spark, sf_dir):
    """Decode a topic with a declared schema; bad records kept as
    all-NULL rows with the raw text flagged (PERMISSIVE)."""
    d = tp.decode_json(tb.topic_messages(spark, sf_dir, "trades", with_bad=True), handles=tb.TRADES_FIELDS)
    return _env_out(d.select("symbol", "price", "volume", "timestamp", "_offset",
                             F.col(tp.CORRUPT).isNotNull().alias("is_bad")))


def q_src_meta_ts(spark, sf_dir):
    """The broker time stamp kept as ``_kafka_ts``."""
    d = tp.decode_json(tb.topic_messages(spark, sf_dir, "trades"), handles=tb.TRADES_FIELDS)
    return _env_out(d.select("symbol", "price", "_offset", "_kafka_ts"))


def q_src_skip_bad(spark, sf_dir):
    """Bad records skipped."""
    d = tp.decode_json(tb.topic_messages(spark, sf_dir, "quotes", with_bad=True), handles=tb.QUOTES_FIELDS,
                       drop_bad=True)
    return _env_out(d.drop("_topic", "_key", "_partition", "_kafka_ts"))


def q_src_drop_count_bad(spark, sf_dir):
    """Per topic, messages read and parse errors (each topic decoded
    with its own schema, then one aggregation over all topics)."""
    flags = [tp.decode_json(tb.topic_messages(spark, sf_dir, t, with_bad=True), handles=fields)
             .select("_topic", tp.CORRUPT) for t, fields in tb.TOPIC_FIELDS.items()]
    return tp.count_bad(merge.union_all(flags)).withColumnRenamed("_topic", "topic")


def q_decode_trades(spark, sf_dir):
    """Trade feed envelopes -> ticks."""
    d = tp.decode_trades(tb.trade_envelopes(spark, sf_dir))
    return _env_out(d.select("symbol", "price", "volume", "timestamp", "_offset",
                             F.col("_tick_idx").alias("tick_idx")))


def q_decode_quotes(spark, sf_dir):
    """Quote responses -> quote records (fetched_at left out: it is the
    processing time)."""
    d = tp.decode_quotes(tb.quote_responses(spark, sf_dir), with_fetched_at=False)
    return _env_out(d.drop("_topic", "_key", "_partition", "_kafka_ts"))


# Route spec of the stand-in consumer, {target table: topics}.
ROUTES = {"ticks_wide": ["trades", "quotes", "trades"], "ticks_col": ["trades"], "clicks_col": ["clicks"]}


def _routed(spark, sf_dir):
    return routing.fan_out(tb.topics_union(spark, sf_dir), routing.route_table(spark, ROUTES))


def q_route_fanout(spark, sf_dir):
    """One subscription, each message once per table its topic feeds."""
    return _routed(spark, sf_dir).select("target_table", "topic", "offset", "key")


def q_writes_by_table(spark, sf_dir):
    """Rows written in total and per target table."""
    return routing.write_counts(_routed(spark, sf_dir))


# ---------------------------------------------------------------- enrich
def q_enrich_asof(spark, sf_dir):
    """J1 + P4: each trade with the latest quote of its symbol."""
    e = enrich.enrich_trades(tb.trades(spark, sf_dir), tb.quotes(spark, sf_dir))
    return _seq_out(e)


def q_pct_change(spark, sf_dir):
    """P4 over decoded quote responses (prev_close 0 gives NULL)."""
    q = tp.decode_quotes(tb.quote_responses(spark, sf_dir), with_fetched_at=False)
    e = enrich.asof_latest(tb.trades(spark, sf_dir), q, ["symbol"], "_ts", "_seq", ["prev_close"],
                           prefix="quote_", right_ts_col="_kafka_ts", right_seq_col="_offset")
    e = e.withColumn("pct_change", enrich.pct_change("price", "quote_prev_close"))
    return e.select("symbol", F.col("_seq").alias("seq"), "price", "quote_prev_close", "pct_change")


# ---------------------------------------------------------------- runs/logs
def q_filter_log_node(spark, sf_dir):
    """P6 + O3: one node's logs, id ascending."""
    return runs.filter_logs(tb.run_logs(spark, sf_dir), node_id="click")


# Fixed value: the search text of the name-search query.
SEARCH_TEXT = "R#00000012"


def q_search_name(spark, sf_dir):
    """Case-insensitive substring search over pipeline names."""
    return runs.search_by_name(tb.parents(spark, sf_dir), SEARCH_TEXT).select("id", "name")


def q_run_summary(spark, sf_dir):
    """R1 + R2 + A8 + A9: per run and node: status, last log row, counts."""
    return runs.run_summary(tb.log_runs(spark, sf_dir), tb.log_nodes(spark, sf_dir), tb.run_logs(spark, sf_dir))


def q_latest_run_per_parent(spark, sf_dir):
    """J2 + O2: each pipeline with node count and newest run."""
    out = runs.latest_run_per_parent(tb.parents(spark, sf_dir), tb.runs(spark, sf_dir),
                                     tb.parent_node_counts(spark, sf_dir))
    return out.select("id", "name", "created_at", "updated_at", "node_count", "last_run_id", "last_run_status",
                      "last_run_at")


def q_runs_top20(spark, sf_dir):
    """O1: newest 20 runs of every pipeline."""
    return runs.top_runs(tb.runs(spark, sf_dir), 20)


def q_newest_running_run(spark, sf_dir):
    """The newest run in status running, per pipeline."""
    return runs.latest_run(tb.runs(spark, sf_dir), status="running")


def q_job_health(spark, sf_dir):
    """Health of the job behind each pipeline's newest run."""
    return runs.job_health(tb.parents(spark, sf_dir), tb.runs(spark, sf_dir), tb.jobs(spark, sf_dir))


def q_jobs_by_state(spark, sf_dir):
    """A10: jobs and running jobs."""
    return runs.jobs_by_state(tb.jobs(spark, sf_dir))


# ---------------------------------------------------------------- metrics
def q_activity_counts(spark, sf_dir):
    """A5 + T9: events per 60 s window and counter (event type)."""
    e = tb.read_table(spark, sf_dir, "events")
    return metrics.counter_totals(e, "ts", "event_type", interval="60 seconds")


def q_consumer_lag(spark, sf_dir):
    """T10 + A6: per topic, lag from broker time (CreateTime only) to now: n,
    and whether every lag is at least 0 and min <= avg <= max (the figures
    themselves depend on the clock; ``consumer_lag_at`` has them)."""
    lag = metrics.consumer_lag(tb.topics_union(spark, sf_dir))
    ms = F.col("lag_s") * 1000
    return (lag.groupBy("topic").agg(F.count("*").alias("n"), F.min(ms).alias("lo"), F.avg(ms).alias("mid"),
                                     F.max(ms).alias("hi"))
            .select("topic", "n", (F.col("lo") >= 0).alias("never_negative"),
                    ((F.col("lo") <= F.col("mid")) & (F.col("mid") <= F.col("hi"))).alias("in_order")))


# Fixed value: the observation time of the reproducible consumer-lag query
# (inside the data's span, so messages newer than it clamp to lag 0).
LAG_OBSERVED_AT = "2024-01-15 00:00:00"


def q_consumer_lag_at(spark, sf_dir):
    """T10 + A6 observed at a fixed time instead of the clock, so the lag
    arithmetic gets a value check: per topic n and min/avg/max lag in whole
    ms (CreateTime only, never negative)."""
    now = F.lit(LAG_OBSERVED_AT).cast("timestamp")
    lag = metrics.consumer_lag(tb.topics_union(spark, sf_dir), now=now)
    ms = F.round(F.col("lag_s") * 1000).cast("long")
    return lag.groupBy("topic").agg(F.count("*").alias("n"), F.min(ms).alias("min_ms"),
                                    F.round(F.avg(ms), 1).alias("avg_ms"), F.max(ms).alias("max_ms"))


def q_windowed_counts(spark, sf_dir):
    """T9 + T1: tumbling 1 h counts per name, by the code of the stream."""
    return jobs.windowed_counts(tb.read_table(spark, sf_dir, "events"), "ts", "event_type", interval="1 hour")


def q_src_failfast(spark, sf_dir):
    """A clean topic decoded so that a bad record would fail the job."""
    d = tp.decode_json(tb.topic_messages(spark, sf_dir, "trades"), handles=tb.TRADES_FIELDS, mode="FAILFAST")
    return _env_out(d.select("symbol", "price", "volume", "timestamp", "_offset"))


def q_topic_output(spark, sf_dir):
    """K4: clicks as keyed JSON messages."""
    return stores.topic_rows(tb.clicks(spark, sf_dir).select("symbol", "k", "timestamp"), "symbol")


def q_route_projected(spark, sf_dir):
    """Trades as the table ``ticks_wide`` receives them, by its own columns."""
    return _seq_out(routing.project_target(tb.trades(spark, sf_dir), S.WIDE_FIELDS, passthrough=ORDER))


def q_dedupe_first_seen(spark, sf_dir):
    """Each user's event types in the order they were first seen."""
    e = tb.read_table(spark, sf_dir, "events")
    return routing.first_seen(e, "user_id", "event_type", ["ts", "event_id"])


def q_message_bytes(spark, sf_dir):
    """texts as UTF-8 bytes, as a topic carries them, and read back."""
    from streamfold.functions.scalar import from_bytes, to_bytes
    d = tb.read_table(spark, sf_dir, "documents").select("doc_id", "text", to_bytes("text").alias("raw"))
    return d.select("doc_id", F.octet_length("raw").cast("long").alias("n_bytes"), F.sha2("raw", 256).alias("raw_sha256"),
                    (from_bytes("raw") == F.col("text")).alias("same"))


def q_store_increments(spark, sf_dir):
    """K1: what micro-batches of a document sink leave in files (two of one
    query, one of a query with a new checkpoint, whose numbers start again at
    0), folded when read."""
    rows = _aligned_doc(spark, sf_dir)
    path = f"{checkpoint_subdir(spark, 'stores')}/doc-{uuid.uuid4().hex}"
    part = F.pmod(F.col("_seq"), F.lit(3))
    for k, (owner, batch) in enumerate((("first", 0), ("first", 1), ("second", 0))):
        increment = merge.partial_nonnull(rows.filter(part == k), S.DOC_FIELDS, S.DOC_KEY, ORDER)
        stores.append_batch(increment, path, batch, owner)
    return merge.fold_nonnull(spark.read.parquet(path), S.DOC_FIELDS, S.DOC_KEY)


def q_latency_stats(spark, sf_dir):
    """Latency samples (value, seconds) per 1 h window and bucket."""
    e = tb.read_table(spark, sf_dir, "events")
    return metrics.latency_summary(e, "ts", "event_type", "value", interval="1 hour")


# ---------------------------------------------------------------- X1 / X2
def stand_in_spec() -> dict:
    """Three topics fanned into a document sink; a column-store sink is
    downstream of the document sink, a wide-column sink takes the topics
    directly, and one sink has no source at all."""
    topic = lambda t: {"id": t, "node_type": X.KAFKA, "label": f"kafka-{t}",
                       "properties": {"topic": t, "format": "json", "_handles": tb.TOPIC_FIELDS[t]}}
    handles = [[f.name, f.type] for f in S.DOC_FIELDS]
    wide = [[f.name, f.type] for f in S.WIDE_FIELDS]
    return {
        "nodes": [
            topic("trades"), topic("quotes"), topic("clicks"),
            {"id": "doc", "node_type": X.MONGODB, "label": "doc-merge",
             "properties": {"primary_key": S.DOC_KEY, "_handles": handles, "field_mappings": S.DOC_MAPPING}},
            {"id": "col", "node_type": X.CLICKHOUSE, "label": "col-analytics",
             "properties": {"primary_key": S.DOC_KEY, "_handles": handles}},
            {"id": "wide", "node_type": X.SCYLLADB, "label": "wide-merged",
             "properties": {"primary_key": S.WIDE_KEY, "_handles": wide}},
            {"id": "orphan", "node_type": X.SCYLLADB, "label": "no-source", "properties": {"_handles": wide}},
        ],
        "edges": [
            {"source_id": "trades", "target_id": "doc"}, {"source_id": "quotes", "target_id": "doc"},
            {"source_id": "clicks", "target_id": "doc"}, {"source_id": "doc", "target_id": "col"},
            {"source_id": "trades", "target_id": "wide"}, {"source_id": "quotes", "target_id": "wide"},
            {"source_id": "clicks", "target_id": "wide"},
        ],
    }


def _spec_sinks(spark, sf_dir, **kw):
    reader = lambda t: tb.topic_messages(spark, sf_dir, t)
    return X.build(stand_in_spec(), reader, **kw)


def q_declarative_spec(spark, sf_dir):
    """The document sink of the stand-in spec (topics -> decode -> P1 -> A1)."""
    return _spec_sinks(spark, sf_dir, only=["doc"])["doc"]


def q_spec_column_store(spark, sf_dir):
    """X2 column-store sink traced through the document sink: raw topic
    rows, P2-aligned and appended (inserted_at left out: processing time)."""
    out = _spec_sinks(spark, sf_dir, only=["col"], with_inserted_at=False)["col"]
    return out.withColumnRenamed("_topic", "topic").withColumnRenamed("_offset", "offset")


def q_spec_wide_upsert(spark, sf_dir):
    """X2 wide-column sink: P3 by name, last row wins in topic order."""
    return _spec_sinks(spark, sf_dir, only=["wide"])["wide"]


def text_spec() -> dict:
    """The stand-in spec with what its nodes hold declared as text."""
    spec = stand_in_spec()
    for n in spec["nodes"]:
        props = n["properties"]
        columns = [f"  `{name}` {kind}" for name, kind in props.pop("_handles")]
        if n["node_type"] == X.KAFKA:
            columns += ["  `at` TIMESTAMP(3) METADATA FROM 'timestamp'", "  WATERMARK FOR `at` AS `at` - INTERVAL '5' SECOND"]
        elif "primary_key" in props:
            columns.append(f"  PRIMARY KEY ({', '.join(props.pop('primary_key'))}) NOT ENFORCED")
        n["sql"] = f"CREATE TABLE `{n['id']}` (\n" + ",\n".join(columns) + "\n) WITH ('format' = 'json', 'x' = 'a(b)');"
    return spec


def q_spec_from_text(spark, sf_dir):
    """S3 + X2: the document sink, its topics and key declared as node text."""
    reader = lambda t: tb.topic_messages(spark, sf_dir, t)
    return X.build(text_spec(), reader, only=["doc"])["doc"]


def q_wide_statements(spark, sf_dir):
    """K2: the values of the wide-column store's guarded inserts, write time
    included, as one batch binds them."""
    spec = stand_in_spec()
    sink = next(n for n in spec["nodes"] if n["id"] == "wide")
    rows = X.build(spec, lambda t: tb.topic_messages(spark, sf_dir, t), only=["wide"], reduce_wide=False)["wide"]
    return guarded.insert_values(fanin.sink_increment(sink, rows, 3, tp.KAFKA_ORDER), X.node_fields(sink))


def q_sql_insert(spark, sf_dir):
    """INSERT INTO a document sink by its label, aligned to its fields."""
    spec = stand_in_spec()
    spec["nodes"] += [
        {"id": "totals", "node_type": X.MONGODB, "label": "Symbol Totals", "properties": {
            "_handles": [["symbol", "STRING"], ["n", "BIGINT"], ["top", "DOUBLE"], ["note", "STRING"]]}},
        {"id": "q", "node_type": "transform", "sql":
            "INSERT INTO symbol_totals SELECT symbol, count(*), max(price) FROM trades GROUP BY symbol"}]
    return X.run_node_sql(spark, spec, lambda t: tb.topic_messages(spark, sf_dir, t))["totals"]


def _sample_sources(spark, sf_dir):
    return {"orders": tb.sample_orders(spark, sf_dir), "customers": tb.sample_customers(spark, sf_dir)}


def q_seed_wide_merge(spark, sf_dir):
    """The seeded sample workflow's wide-column sink: orders and customers
    fanned in by name (P3) and upserted by the first field, order_id (A2).
    A fan-in, not a join: customer rows have no order_id and are rejected,
    so ``name`` stays NULL."""
    from streamfold.functions.schema import fields_from_handles
    fields = fields_from_handles(tb.SAMPLE_SINK_FIELDS)
    u = merge.union_all([align.align_null_fill(df, fields, passthrough=ORDER)
                         for df in _sample_sources(spark, sf_dir).values()])
    return merge.upsert_last_row(u, fields, ["order_id"], ORDER)


def q_seed_column_reports(spark, sf_dir):
    """The sample workflow's column-store sink (downstream of the
    wide-column sink, so fed by both topics): P2 against the created
    table (key NOT NULL -> '' for customers), appended."""
    from streamfold.functions.schema import fields_from_handles
    fields = fields_from_handles(tb.SAMPLE_SINK_FIELDS)
    dest = align.column_store_schema(fields, ["order_id"])
    return merge.append_fanin([align.align_default_fill(df, dest, passthrough=("_seq",))
                               for df in _sample_sources(spark, sf_dir).values()]).withColumnRenamed("_seq", "seq")


# Fixed value: the user SQL of the X1 query.
USER_SQL = ("SELECT symbol, count(*) AS n_trades, max(price) AS max_price, min(timestamp) AS first_ts "
            "FROM trades GROUP BY symbol")


def q_user_sql(spark, sf_dir):
    """User SQL over the decoded topics registered as views."""
    return X.run_user_sql(spark, USER_SQL, tb.decoded_sources(spark, sf_dir))


def _alone(query):
    """A query that opens each of its tables once."""
    @functools.wraps(query)
    def run(spark, sf_dir):
        tb.close_tables()
        return query(spark, sf_dir)
    return run


QUERIES = {
    "align_mapped": q_align_mapped,
    "align_null_fill": q_align_null_fill,
    "align_default_fill": q_align_default_fill,
    "single_source_insert": q_single_source_insert,
    "merge_latest_nonnull": q_merge_latest_nonnull,
    "upsert_last_row": q_upsert_last_row,
    "append_fanin": q_append_fanin,
    "merge_idle_ttl": q_merge_idle_ttl,
    "src_json_decode": q_src_json_decode,
    "src_meta_ts": q_src_meta_ts,
    "src_skip_bad": q_src_skip_bad,
    "src_drop_count_bad": q_src_drop_count_bad,
    "decode_trades": q_decode_trades,
    "decode_quotes": q_decode_quotes,
    "route_fanout": q_route_fanout,
    "writes_by_table": q_writes_by_table,
    "enrich_asof": q_enrich_asof,
    "pct_change": q_pct_change,
    "filter_log_node": q_filter_log_node,
    "search_name": q_search_name,
    "run_summary": q_run_summary,
    "latest_run_per_parent": q_latest_run_per_parent,
    "runs_top20": q_runs_top20,
    "newest_running_run": q_newest_running_run,
    "job_health": q_job_health,
    "jobs_by_state": q_jobs_by_state,
    "activity_counts": q_activity_counts,
    "latency_stats": q_latency_stats,
    "consumer_lag": q_consumer_lag,
    "windowed_counts": q_windowed_counts,
    "src_failfast": q_src_failfast,
    "topic_output": q_topic_output,
    "route_projected": q_route_projected,
    "dedupe_first_seen": q_dedupe_first_seen,
    "message_bytes": q_message_bytes,
    "store_increments": q_store_increments,
    "consumer_lag_at": q_consumer_lag_at,
    "declarative_spec": q_declarative_spec,
    "spec_column_store": q_spec_column_store,
    "spec_wide_upsert": q_spec_wide_upsert,
    "spec_from_text": q_spec_from_text,
    "wide_statements": q_wide_statements,
    "sql_insert": q_sql_insert,
    "user_sql": q_user_sql,
    "seed_wide_merge": q_seed_wide_merge,
    "seed_column_reports": q_seed_column_reports,
}
QUERIES = {name: _alone(query) for name, query in QUERIES.items()}
