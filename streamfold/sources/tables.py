"""Stand-in inputs derived from the driver tables.

The engine's real inputs are keyed JSON topics and run/log tables.  For
tests and benchmarks they are derived, with Spark, from the parquet tables
so the work grows with the data:

* trades topic  = ``events`` rows of type ``purchase`` (key user_id,
  price = value, volume = props.k, timestamp in epoch ms)
* quotes topic  = ``events`` rows of type ``error`` (key user_id,
  prev_close = value, timestamp in epoch seconds like the quote feed)
* clicks topic  = ``events`` rows of type ``click`` (key user_id, k)
* run logs      = ``events`` (run_id = user_id, node_id = event_type)
* runs / parents = ``orders`` / ``customer``

Every decoded source carries the merge order as ``_ts`` (event time) and
``_seq`` (a unique id), so folds are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER = ("_ts", "_seq")

# The event types standing in for each topic.
TOPIC_EVENT_TYPE = {"trades": ["purchase"], "quotes": ["error"], "clicks": ["click", "view", "signup"]}

# Declared topic schemas (handles) of the stand-in topics.
TRADES_FIELDS = [["symbol", "STRING"], ["price", "DOUBLE"], ["volume", "DOUBLE"], ["timestamp", "BIGINT"]]
QUOTES_FIELDS = [["symbol", "STRING"], ["current", "DOUBLE"], ["high", "DOUBLE"], ["low", "DOUBLE"],
                 ["open", "DOUBLE"], ["prev_close", "DOUBLE"], ["timestamp", "BIGINT"]]
CLICKS_FIELDS = [["symbol", "STRING"], ["k", "BIGINT"], ["timestamp", "BIGINT"]]
TOPIC_FIELDS = {"trades": TRADES_FIELDS, "quotes": QUOTES_FIELDS, "clicks": CLICKS_FIELDS}

# Fixed value: a message of a bad-record topic is replaced by this text when
# its event id is a multiple of BAD_EVERY.
BAD_TEXT = "bad"
BAD_EVERY = 50
# Fixed value: every such message carries the broker's append time instead of
# the producer's create time.
APPEND_TIME_EVERY = 7


# The tables a query has opened, so that it lists and reads the schema of each
# once; ``close_tables`` before the next one.
_OPEN: dict[tuple, DataFrame] = {}


def close_tables() -> None:
    _OPEN.clear()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A lazy DataFrame over one driver table."""
    at = (id(spark), f"{sf_dir}/{name}.parquet")
    if at not in _OPEN:
        _OPEN[at] = spark.read.parquet(at[1])
    return _OPEN[at]


def _events(spark, sf_dir, event_type: str | list[str] | None = None) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e if event_type is None else e.filter(F.col("event_type").isin(event_type))


def _k():
    return F.get_json_object("props", "$.k").cast("long")


def epoch_ms(ts_col: str = "ts"):
    """Event time (timestamp or timestamp_ntz, read as UTC) -> epoch ms."""
    return F.unix_millis(F.col(ts_col).cast("timestamp"))


def _topic_columns(topic: str) -> list:
    """Decoded columns of a stand-in topic, as expressions over ``events``."""
    sym = F.col("user_id").cast("string").alias("symbol")
    v = F.col("value")
    if topic == "trades":
        return [sym, v.alias("price"), _k().cast("double").alias("volume"),
                epoch_ms().alias("timestamp")]
    if topic == "quotes":
        return [sym, v.alias("current"), (v + 1.0).alias("high"), (v - 1.0).alias("low"),
                (v + 0.5).alias("open"), v.alias("prev_close"),
                F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp")]
    if topic == "clicks":
        return [sym, _k().alias("k"), epoch_ms().alias("timestamp")]
    raise KeyError(topic)


def decoded_topic(spark, sf_dir, topic: str) -> DataFrame:
    """One stand-in topic in decoded form, with the order columns."""
    e = _events(spark, sf_dir, TOPIC_EVENT_TYPE[topic])
    return e.select(*_topic_columns(topic), F.col("ts").alias("_ts"), F.col("event_id").alias("_seq"))


def trades(spark, sf_dir) -> DataFrame:
    return decoded_topic(spark, sf_dir, "trades")


def quotes(spark, sf_dir) -> DataFrame:
    return decoded_topic(spark, sf_dir, "quotes")


def clicks(spark, sf_dir) -> DataFrame:
    return decoded_topic(spark, sf_dir, "clicks")


def decoded_sources(spark, sf_dir) -> dict[str, DataFrame]:
    return {t: decoded_topic(spark, sf_dir, t) for t in ("trades", "quotes", "clicks")}


# ---------------------------------------------------------------- topics
ENVELOPE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])


def _envelope(df: DataFrame, topic: str, value, with_bad: bool) -> DataFrame:
    """Kafka-shaped rows: (topic, key, value, partition, offset, timestamp).

    Broker time stamps have millisecond precision, so the event time is
    truncated to ms.  One partition per topic, offset = event id.
    """
    if with_bad:
        value = F.when(F.col("event_id") % BAD_EVERY == 0, F.lit(BAD_TEXT)).otherwise(value)
    return df.select(
        F.lit(topic).alias("topic"),
        F.col("user_id").cast("string").alias("key"),
        value.alias("value"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.timestamp_millis(epoch_ms()).alias("timestamp"),
        F.when(F.col("event_id") % APPEND_TIME_EVERY == 0, 1).otherwise(0).alias("timestampType"),
    )


def topic_messages(spark, sf_dir, topic: str, with_bad: bool = False) -> DataFrame:
    """JSON messages of one stand-in topic, as a topic source would give."""
    e = _events(spark, sf_dir, TOPIC_EVENT_TYPE[topic])
    return _envelope(e, topic, F.to_json(F.struct(*_topic_columns(topic))), with_bad)


def topics_union(spark, sf_dir, topics=("trades", "quotes", "clicks"), with_bad: bool = False) -> DataFrame:
    out = None
    for t in topics:
        m = topic_messages(spark, sf_dir, t, with_bad)
        out = m if out is None else out.unionByName(m)
    return out


def trade_envelopes(spark, sf_dir) -> DataFrame:
    """Raw trade feed messages ``{"type": ..., "data": [{s, p, v, t}, ...]}``.

    ``purchase`` events become trade messages with two ticks; ``view``
    events become ``{"type":"ping"}`` messages that decoding drops.  Tick
    one omits ``v`` when k % 7 == 0 and sends ``"v":null`` when k % 11 == 0;
    tick two has price value + 1, no ``v``, t + 1 and ``"p":null`` when
    k % 13 == 0.  That exercises missing-key defaults against explicit
    nulls on table data.
    """
    e = _events(spark, sf_dir).filter(F.col("event_type").isin("purchase", "view"))
    k = _k()
    sym = F.col("user_id").cast("string")
    ms = epoch_ms()
    v_part = (F.when(k % 7 == 0, F.lit(""))
              .when(k % 11 == 0, F.lit(',"v":null'))
              .otherwise(F.concat(F.lit(',"v":'), k.cast("string"))))
    tick1 = F.concat(F.lit('{"s":"'), sym, F.lit('","p":'), F.col("value").cast("string"),
                     v_part, F.lit(',"t":'), ms.cast("string"), F.lit("}"))
    p2 = F.when(k % 13 == 0, F.lit("null")).otherwise((F.col("value") + 1.0).cast("string"))
    tick2 = F.concat(F.lit('{"s":"'), sym, F.lit('","p":'), p2, F.lit(',"t":'),
                     (ms + 1).cast("string"), F.lit("}"))
    msg = F.when(F.col("event_type") == "purchase",
                 F.concat(F.lit('{"type":"trade","data":['), tick1, F.lit(","), tick2, F.lit("]}"))
                 ).otherwise(F.lit('{"type":"ping"}'))
    return _envelope(e, "trades-raw", msg, with_bad=False)


def quote_responses(spark, sf_dir) -> DataFrame:
    """Raw quote poll responses ``{"c","h","l","o","pc","t"}`` keyed by symbol.

    From ``error`` events: c = value, h = value + 1, l = value - 1,
    o = value + 0.5, pc = value, t = epoch seconds.  ``c`` is null when
    k % 17 == 0 (the poll is dropped) and ``pc`` is 0 when k % 19 == 0.
    """
    e = _events(spark, sf_dir, TOPIC_EVENT_TYPE["quotes"])
    k = _k()
    v = F.col("value")
    c = F.when(k % 17 == 0, F.lit(None).cast("double")).otherwise(v)
    pc = F.when(k % 19 == 0, F.lit(0.0)).otherwise(v)
    body = F.to_json(F.struct(c.alias("c"), (v + 1.0).alias("h"), (v - 1.0).alias("l"),
                              (v + 0.5).alias("o"), pc.alias("pc"),
                              F.unix_seconds(F.col("ts").cast("timestamp")).alias("t")),
                     {"ignoreNullFields": "false"})
    return _envelope(e, "quotes-raw", body, with_bad=False)


# ---------------------------------------------------------------- runs/logs
def run_logs(spark, sf_dir) -> DataFrame:
    """Log rows: id, run_id, node_id, node_label, level, message, timestamp.

    Level ERROR for ``error`` events; a message starts with the success
    marker when the event value is at least 150.
    """
    e = read_table(spark, sf_dir, "events")
    marker = F.when(F.col("value") >= 150, F.lit("✓ ")).otherwise(F.lit(""))
    return e.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("run_id"),
        F.col("event_type").alias("node_id"),
        F.upper("event_type").alias("node_label"),
        F.when(F.col("event_type") == "error", F.lit("ERROR")).otherwise(F.lit("INFO")).alias("level"),
        F.concat(marker, F.col("event_type"), F.lit(" #"), F.col("event_id").cast("string")).alias("message"),
        F.col("ts").alias("timestamp"),
    )


# The node template of every stand-in pipeline (id, type); the
# last node never logs, so it reports "pending".
LOG_NODES = [("error", "kafka"), ("click", "kafka"), ("purchase", "kafka"),
             ("view", "mongodb"), ("signup", "clickhouse"), ("sink", "scylladb")]


def runs(spark, sf_dir) -> DataFrame:
    """Runs from ``orders``: id, parent (pipeline) id, status, job id, start.

    Status: O -> running, F -> success, P -> pending.  Job id: none for
    priority 5-LOW, the placeholder ``submitted`` for 4-NOT SPECIFIED,
    else ``job-<id>``.
    """
    o = read_table(spark, sf_dir, "orders")
    status = (F.when(F.col("o_orderstatus") == "O", "running")
              .when(F.col("o_orderstatus") == "F", "success").otherwise("pending"))
    job = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
           .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("submitted"))
           .otherwise(F.concat(F.lit("job-"), F.col("o_orderkey").cast("string"))))
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("pipeline_id"),
                    status.alias("status"), job.alias("job_id"),
                    F.col("o_orderdate").alias("started_at"))


def jobs(spark, sf_dir) -> DataFrame:
    """Job states as a job manager would list them: orders not in status P
    (those are unreachable); O -> RUNNING, F -> FINISHED."""
    o = read_table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P")
    return o.select(F.concat(F.lit("job-"), F.col("o_orderkey").cast("string")).alias("job_id"),
                    F.when(F.col("o_orderstatus") == "O", "RUNNING").otherwise("FINISHED").alias("state"))


def parents(spark, sf_dir) -> DataFrame:
    """Pipelines from ``customer``: id, name, and dates of making and of the
    last change derived from the key."""
    c = read_table(spark, sf_dir, "customer")
    made = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(c_custkey % 300 as int))")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), made.alias("created_at"),
                    F.expr("timestamp_ntz'2024-12-01' + make_dt_interval(cast(c_custkey * 7 % 60 as int))")
                    .alias("updated_at"))


def parent_node_counts(spark, sf_dir) -> DataFrame:
    """Node count per pipeline, from the list of its nodes."""
    return log_nodes(spark, sf_dir).groupBy("pipeline_id").agg(F.count("*").alias("node_count"))


def log_runs(spark, sf_dir) -> DataFrame:
    """Runs that wrote logs, with their pipeline: the distinct run ids of
    the logs, joined to the runs table for the pipeline id."""
    ids = run_logs(spark, sf_dir).select("run_id").distinct()
    return ids.join(runs(spark, sf_dir).select(F.col("id").alias("run_id"), "pipeline_id"), "run_id")


def log_nodes(spark, sf_dir) -> DataFrame:
    """The nodes of every pipeline: each pipeline of ``customer`` carries
    the LOG_NODES template (a generator per pipeline row, no join)."""
    tmpl = F.array(*[F.struct(F.lit(n).alias("node_id"), F.lit(n.upper()).alias("node_label"),
                              F.lit(t).alias("node_type")) for n, t in LOG_NODES])
    return parents(spark, sf_dir).select(F.col("id").alias("pipeline_id"), F.inline(tmpl))


# Declared fields of the seeded sample workflow (orders and
# customers topics fanned into one wide-column sink and one column store).
SAMPLE_ORDERS_FIELDS = [["order_id", "STRING"], ["amount", "DOUBLE"], ["customer_id", "STRING"]]
SAMPLE_CUSTOMERS_FIELDS = [["customer_id", "STRING"], ["name", "STRING"], ["email", "STRING"]]
SAMPLE_SINK_FIELDS = [["order_id", "STRING"], ["amount", "DOUBLE"], ["name", "STRING"]]


def sample_orders(spark, sf_dir) -> DataFrame:
    """Orders topic of the sample workflow, from ``orders``."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_totalprice").alias("amount"),
                    F.col("o_custkey").cast("string").alias("customer_id"),
                    F.col("o_orderdate").alias("_ts"), F.col("o_orderkey").alias("_seq"))


def sample_customers(spark, sf_dir) -> DataFrame:
    """Customers topic of the sample workflow, from ``customer`` (email
    derived from the name)."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("customer_id"), F.col("c_name").alias("name"),
                    F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
                    F.lit(None).cast("timestamp_ntz").alias("_ts"), F.col("c_custkey").alias("_seq"))
