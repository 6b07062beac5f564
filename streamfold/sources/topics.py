"""JSON topic sources.

A topic is a DataFrame shaped like Spark's Kafka source:
``topic, key, value, partition, offset, timestamp, timestampType``.  It
comes from ``read_topic`` (Kafka, batch or stream) or from any other
DataFrame of that shape (files, tables).  Decoding is ``from_json`` against
a declared schema; nothing is inferred.

Decoded rows carry the envelope as ``_topic, _key, _partition, _offset``
and the broker time as ``_kafka_ts`` (millisecond time stamp without zone,
as the reference's ``TIMESTAMP(3) METADATA`` column).  ``KAFKA_ORDER`` is
the total order to merge on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamfold.functions.scalar import lag_seconds
from streamfold.functions.schema import Field, as_fields, declared_fields, to_struct

KAFKA_ORDER = ("_kafka_ts", "_topic", "_partition", "_offset")
CORRUPT = "_corrupt_record"
META = ["_topic", "_key", "_partition", "_offset", "_kafka_ts"]


# ---------------------------------------------------------------- S1 reader
def kafka_options(topics, bootstrap: str, starting: str = "earliest", group_id: str | None = None,
                  pattern: bool = False, max_offsets_per_trigger: int | None = None,
                  fail_on_data_loss: bool = True, min_offsets_per_trigger: int | None = None,
                  max_trigger_delay: str | None = None) -> dict:
    """Options for ``spark.read[Stream].format("kafka")``.

    Topics are subscribed from the earliest offset.  No consumer group is set
    unless ``group_id`` names one: Spark then makes one per query, so two sinks
    over one topic each read all of it.  ``pattern=True`` subscribes by regex
    (several are alternatives), so new topics join without a restart (S6).
    Offsets that have expired raise unless ``fail_on_data_loss=False``.
    T5: ``min_offsets_per_trigger`` and ``max_trigger_delay`` start a micro-batch
    at so many messages or after that time, whichever comes first (the reference
    flushes at 500 rows or 1 s).
    """
    names = [topics] if isinstance(topics, str) else list(topics)
    opts = {"kafka.bootstrap.servers": bootstrap, "startingOffsets": starting,
            "failOnDataLoss": str(bool(fail_on_data_loss)).lower()}
    if pattern:
        opts["subscribePattern"] = "|".join(names)
    else:
        opts["subscribe"] = ",".join(names)
    if group_id:
        opts["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_offsets_per_trigger:
        opts["minOffsetsPerTrigger"] = str(min_offsets_per_trigger)
        opts["maxTriggerDelay"] = max_trigger_delay or "1s"
    return opts


# Fixed value: the message formats a topic node may declare.
FORMATS = ("json",)


def node_reader_options(node: dict) -> dict:
    """What a topic node's properties say about reading it: its consumer group
    and its format (only JSON is read; another format raises)."""
    props = node.get("properties") or {}
    fmt = str(props.get("format") or "json").lower()
    if fmt not in FORMATS:
        raise ValueError(f"topic node {node.get('id')}: format {fmt!r} is not supported")
    return {"group_id": props["group_id"]} if props.get("group_id") else {}


def read_topic(spark: SparkSession, topics, bootstrap: str, stream: bool = True, **kw) -> DataFrame:
    """Kafka topic(s) as an envelope DataFrame (needs the Kafka connector,
    ``spark-sql-kafka``, on the classpath).  Set ``max_offsets_per_trigger``
    to bound a micro-batch."""
    r = spark.readStream if stream else spark.read
    try:
        return r.format("kafka").options(**kafka_options(topics, bootstrap, **kw)).load()
    except Exception as ex:  # noqa: BLE001
        if "kafka" in str(ex).lower() and "data source" in str(ex).lower():
            raise RuntimeError("the Kafka connector (spark-sql-kafka) is not on the classpath; "
                               "use an envelope DataFrame from files instead") from ex
        raise


def read_json_lines(spark: SparkSession, path: str, topic: str, stream: bool = False) -> DataFrame:
    """Offline topic: a folder of JSON-lines files, one message per line.

    Offsets are not available from files; the line's position is not
    stable across file listings, so ``_offset`` is NULL and callers should
    order on payload fields.
    """
    r = (spark.readStream if stream else spark.read).format("text")
    df = r.load(path)
    return df.select(F.lit(topic).alias("topic"), F.lit(None).cast("string").alias("key"),
                     F.col("value"), F.lit(0).alias("partition"),
                     F.lit(None).cast("long").alias("offset"),
                     F.current_timestamp().alias("timestamp"), F.lit(1).alias("timestampType"))


def _meta(meta_ts: bool = True) -> list[Column]:
    cols = [F.col("topic").alias("_topic"), F.col("key").cast("string").alias("_key"),
            F.col("partition").alias("_partition"), F.col("offset").alias("_offset")]
    if meta_ts:
        cols.append(F.col("timestamp").cast("timestamp_ntz").alias("_kafka_ts"))
    return cols


def rows_where(cond: Column, *cols: Column) -> Column:
    """Generator that emits ``struct(cols)`` once when ``cond`` holds, else
    nothing.  A ``filter`` over a parsed column would be pushed below the
    projection with the parse inlined into every predicate term (one JSON
    parse per term); as a generator the parse stays in one projection where
    subexpression elimination evaluates it once per message."""
    return F.inline(F.when(cond, F.array(F.struct(*cols))))


# ---------------------------------------------------------------- S1-S4
def decode_json(messages: DataFrame, fields=None, mode: str = "PERMISSIVE",
                meta_ts: bool = True, handles=None, ddl: str | None = None,
                drop_bad: bool = False) -> DataFrame:
    """Decode the ``value`` of every message against the declared schema.

    ``mode``: ``FAILFAST`` raises on the first bad message (S4a);
    ``PERMISSIVE`` keeps it with NULL fields and the raw text in
    ``_corrupt_record`` (use ``skip_bad`` / ``split_bad`` on the result);
    ``drop_bad=True`` drops bad messages in the same pass (S4b).
    """
    flds = as_fields(fields) if fields is not None else declared_fields(handles, ddl)
    schema = to_struct([Field(f.name, f.type) for f in flds])
    opts = {"mode": mode}
    if mode.upper() == "PERMISSIVE":
        schema = schema.add(T.StructField(CORRUPT, T.StringType()))
        opts["columnNameOfCorruptRecord"] = CORRUPT
    parsed = F.from_json(F.col("value").cast("string"), schema, opts)
    out = messages.select(parsed.alias("_m"), F.col("value").cast("string").alias("_text"), *_meta(meta_ts))
    cols = [F.col("_m")[f.name].alias(f.name) for f in flds]
    meta = [F.col(c) for c in META if c in out.columns]
    if mode.upper() != "PERMISSIVE":
        # the parse is the condition of a generator, so that no choice of
        # columns prunes it: every bad message fails the job
        return out.select(rows_where(F.col("_m").isNotNull() | F.col("_text").isNull()
                                     | F.raise_error(F.lit("not a JSON object")).isNull(), *cols, *meta))
    # a message that is not a JSON object at all (e.g. the text null)
    # parses to a NULL struct: that is a bad record too
    corrupt = F.when(F.col("_m").isNull(), F.col("_text")).otherwise(F.col("_m")[CORRUPT])
    if drop_bad:
        return out.select(rows_where(corrupt.isNull(), *cols, *meta))
    return out.select(*cols, corrupt.alias(CORRUPT), *meta)


def decode_many(messages: DataFrame, sources: dict[str, tuple]) -> DataFrame:
    """Messages of several topics, each decoded once per source node that
    reads its topic: ``sources`` is ``{source id: (topic, fields)}``.  One row
    per message, with a struct ``_m_<n>`` for the n-th source (NULL for other
    topics' messages); ``source_rows`` takes a source's rows from it."""
    text = F.col("value").cast("string")
    parsed = []
    for n, (topic, fields) in enumerate(sources.values()):
        schema = to_struct([Field(f.name, f.type) for f in as_fields(fields)])
        schema = schema.add(T.StructField(CORRUPT, T.StringType()))
        m = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
        parsed.append(F.when(F.col("topic") == topic, m).alias(f"_m_{n}"))
    out = messages.select(*_meta(), F.col("timestamp").alias("_at"), F.col("timestampType").alias("_at_type"),
                          text.alias("_text"), *parsed)
    # one test per source whether the message can be read
    bad = [F.when(F.col("_topic") == topic, F.coalesce(
        F.col(f"_m_{n}")[CORRUPT], F.when(F.col(f"_m_{n}").isNull() & F.col("_text").isNotNull(), F.col("_text")))
        .isNotNull()).alias(f"_bad_{n}") for n, (topic, _) in enumerate(sources.values())]
    return out.select("*", *bad)


def source_rows(decoded: DataFrame, sources: dict[str, tuple], source_id: str, mode: str) -> DataFrame:
    """One source's rows of ``decode_many``.  ``mode`` ``fail`` raises at a bad
    message (S4a); else it is dropped (S4b, S4c)."""
    n = list(sources).index(source_id)
    rows = decoded.filter(F.col("_topic") == sources[source_id][0])
    m, bad = F.col(f"_m_{n}"), F.col(f"_bad_{n}")
    cols = [m[f.name].alias(f.name) for f in as_fields(sources[source_id][1])]
    keep = F.when(bad, F.raise_error(F.lit("bad message in the topic of a document sink")).cast("boolean")) \
        .otherwise(F.lit(True)) if mode == "fail" else ~bad
    return rows.filter(keep).select(*cols, *META)


def decode_counts(sources: dict[str, tuple], now: Column | None = None) -> list[Column]:
    """Counters over ``decode_many``, for ``observe``: per source the messages
    read and the parse errors (S4c) and the lag of messages with a create time
    (T10), in ms."""
    now = F.current_timestamp() if now is None else now
    out = []
    for n, (topic, _) in enumerate(sources.values()):
        mine = F.col("_topic") == topic
        lag = F.when(mine & (F.col("_at_type") == 0), lag_seconds(now, F.col("_at")) * 1000)
        out += [F.count_if(mine & ~F.col(f"_bad_{n}")).alias(f"read_{n}"),
                F.count_if(mine & F.col(f"_bad_{n}")).alias(f"bad_{n}"),
                F.count(lag).alias(f"lag_n_{n}"), F.min(lag).alias(f"lag_min_{n}"),
                F.avg(lag).alias(f"lag_avg_{n}"), F.max(lag).alias(f"lag_max_{n}")]
    return out


def skip_bad(decoded: DataFrame) -> DataFrame:
    """Drop every bad record (Spark has no per-block skip count)."""
    return decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def split_bad(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows) of a PERMISSIVE decode."""
    good = decoded.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = decoded.filter(F.col(CORRUPT).isNotNull()).select(*[c for c in META if c in decoded.columns], CORRUPT)
    return good, bad


def count_bad(decoded: DataFrame, by: str = "_topic") -> DataFrame:
    """S4c counters: messages read (parsed) and parse errors, per topic."""
    bad = F.col(CORRUPT).isNotNull()
    return decoded.groupBy(by).agg(F.count_if(~bad).alias("kafka_read"),
                                   F.count_if(bad).alias("parse_errors"))


# ---------------------------------------------------------------- S7 / S8
# The feed's trade message type, and each tick key with the
# name it is published under, its type and the value used when it is missing.
TRADE_TYPE = "trade"
TICK_KEYS = [("s", "symbol", "string", ""), ("p", "price", "double", 0.0),
             ("v", "volume", "double", 0.0), ("t", "timestamp", "bigint", 0)]

_TICK_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("data", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
])


def _get_or(m: Column, k: str, default, dtype: str) -> Column:
    """Missing key -> default; present (even explicit null) -> its value."""
    v = m[k] if dtype == "string" else m[k].try_cast(dtype)
    return F.when(F.map_contains_key(m, k), v).otherwise(F.lit(default).cast(dtype))


def decode_trades(messages: DataFrame) -> DataFrame:
    """Raw feed messages -> one row per tick.

    Keeps ``type = 'trade'``, explodes ``data[]`` and renames
    ``s, p, v, t`` to ``symbol, price, volume, timestamp`` (ms).  A missing
    key takes the default ('' / 0.0 / 0.0 / 0); a present null stays NULL.
    Ticks are parsed as string maps to tell the two apart.
    """
    parsed = messages.select(F.from_json(F.col("value").cast("string"), _TICK_SCHEMA).alias("_m"), *_meta())
    # explode only trade messages (no filter: see ``rows_where``)
    data = F.when(F.col("_m.type") == TRADE_TYPE, F.col("_m.data"))
    ticks = parsed.select(F.posexplode(data).alias("_tick_idx", "_t"), *META)
    t = F.col("_t")
    return ticks.select(*[_get_or(t, k, default, dtype).alias(name) for k, name, dtype, default in TICK_KEYS],
                        "_tick_idx", *META)


# Quote response keys and the names they are published under.
QUOTE_KEYS = [("c", "current"), ("h", "high"), ("l", "low"), ("o", "open"),
              ("pc", "prev_close"), ("t", "timestamp")]


def decode_quotes(messages: DataFrame, with_fetched_at: bool = True) -> DataFrame:
    """Quote poll responses -> quote records keyed by the message key.

    A response whose ``c`` is null or missing is dropped, and so is one
    missing any other key (the reference's lookup raises and the poll is
    discarded); an explicit null in another field stays NULL.
    ``fetched_at`` is the processing time in epoch seconds.
    """
    m = F.from_json(F.col("value").cast("string"), T.MapType(T.StringType(), T.StringType()))
    parsed = messages.select(m.alias("_m"), *_meta())
    mm = F.col("_m")
    keep = mm.isNotNull() & mm["c"].isNotNull()
    for k, _ in QUOTE_KEYS[1:]:
        keep = keep & F.map_contains_key(mm, k)
    cols = [F.col("_key").alias("symbol")]
    for k, name in QUOTE_KEYS:
        cols.append(mm[k].try_cast("bigint" if k == "t" else "double").alias(name))
    if with_fetched_at:
        cols.append(F.unix_seconds(F.current_timestamp()).alias("fetched_at"))
    return parsed.select(rows_where(keep, *cols, *[F.col(c) for c in META]))
