"""Node text: columns, key, watermark and metadata of a declaration."""
import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from streamfold.functions import declare as D
from streamfold.plans import spec as X
from streamfold.streaming import jobs

TEMPLATE = """CREATE TABLE orders (
  order_id   STRING,
  customer_id STRING,
  amount     DOUBLE,
  ts         TIMESTAMP(3),
  PRIMARY KEY (order_id) NOT ENFORCED,
  WATERMARK FOR ts AS ts - INTERVAL '5' SECOND
) WITH (
  'connector' = 'kafka',
  'topic'     = 'orders',
  'format'    = 'json'
);"""


def _node(text, **props):
    return {"id": "n", "node_type": X.KAFKA, "sql": text, "properties": props}


@pytest.mark.parametrize("text,expected", [
    ("CREATE TABLE orders (order_id STRING, amount DOUBLE, name STRING) WITH ('connector'='kafka');",
     [("order_id", "STRING"), ("amount", "DOUBLE"), ("name", "STRING")]),
    ("SELECT order_id, amount, name FROM orders", [("order_id", "STRING"), ("amount", "STRING"), ("name", "STRING")]),
    ("""CREATE TABLE merged (
          `symbol` STRING,
          `price` DOUBLE,
          PRIMARY KEY (`symbol`) NOT ENFORCED
        ) WITH ('connector'='cassandra');""", [("symbol", "STRING"), ("price", "DOUBLE")]),
    ("", [("id", "STRING"), ("payload", "STRING")]),
    (TEMPLATE, [("order_id", "STRING"), ("customer_id", "STRING"), ("amount", "DOUBLE"), ("ts", "TIMESTAMP")]),
    ("create table t (a varchar(20), b CHAR, c VARBINARY(8), d decimal(10, 2), e INT NOT NULL, f BIGINT COMMENT 'x, (y')",
     [("a", "STRING"), ("b", "STRING"), ("c", "BYTES"), ("d", "DECIMAL(10,2)"), ("e", "INT"), ("f", "BIGINT")]),
    ("CREATE TABLE t (a INT, -- the key, (first)\n b STRING)", [("a", "INT"), ("b", "STRING")]),
    ("SELECT t.a, max(b, 'x, FROM y') AS top, `c` FROM t", [("a", "STRING"), ("top", "STRING"), ("c", "STRING")]),
    ("SELECT * FROM t", [("id", "STRING"), ("payload", "STRING")]),
])
def test_fields_of_node_text(spark, text, expected):
    assert [(f.name, f.type) for f in X.node_fields(_node(text))] == expected


def test_text_goes_before_handles_and_bad_text_raises(spark):
    assert [f.name for f in X.node_fields(_node(TEMPLATE, _handles=[["x", "INT"]]))][0] == "order_id"
    assert [f.name for f in X.node_fields(_node("INSERT INTO a SELECT 1", _handles=[["x", "INT"]]))] == ["x"]
    for text in ("CREATE TABLE t", "CREATE TABLE t (a INT", "CREATE TABLE t (a NOSUCHTYPE)", "CREATE TABLE t (a)"):
        with pytest.raises(Exception):
            X.node_fields(_node(text))


def test_key_watermark_and_metadata(spark):
    d = D.declaration(TEMPLATE)
    assert d.key == ["order_id"] and d.watermark == ("ts", "5 second")
    assert X.node_key(_node(TEMPLATE), d.fields) == ["order_id"]
    assert X.node_key(_node(TEMPLATE, primary_key=["amount"]), d.fields) == ["amount"]
    assert D.declaration("CREATE TABLE t (a INT, b INT, CONSTRAINT pk PRIMARY KEY (a, b))").key == ["a", "b"]
    d = D.declaration("CREATE TABLE t (a INT, `_kafka_ts` TIMESTAMP(3) METADATA VIRTUAL, "
                      "at TIMESTAMP(3) METADATA FROM 'timestamp', WATERMARK FOR at AS at)")
    assert [f.name for f in d.fields] == ["a"]
    assert d.metadata == {"_kafka_ts": "_kafka_ts", "at": "_kafka_ts"} and d.watermark == ("at", "0 seconds")
    with pytest.raises(ValueError, match="metadata"):
        D.declaration("CREATE TABLE t (a INT, b INT METADATA FROM 'nothing')")
    with pytest.raises(ValueError, match="watermark"):
        D.declaration("CREATE TABLE t (a TIMESTAMP(3), WATERMARK FOR a AS other(a))")


def test_decimal_and_timestamp_columns_decode(spark):
    env = "topic string, key string, value string, partition int, offset long, timestamp timestamp, timestampType int"
    msgs = spark.createDataFrame([("t", "k", '{"a":"x","d":1.25,"ts":"2024-01-01 00:00:01"}', 0, 7, dt.datetime(2024, 1, 2), 0)], env)
    rows = X.decode_source(msgs, _node("CREATE TABLE t (a VARCHAR, d DECIMAL(10, 2), ts TIMESTAMP(3), "
                                       "at TIMESTAMP(3) METADATA FROM 'timestamp', WATERMARK FOR ts AS ts - INTERVAL '5' SECOND)"),
                           "drop")
    r = rows.first()
    assert (r["a"], str(r["d"]), r["ts"].second, r["at"].day) == ("x", "1.25", 1, 2)


def test_declared_watermark_drops_a_late_row(spark):
    """The watermark of the node's text, on the stream: a row later than the
    delay does not reopen its window."""
    d = tempfile.mkdtemp(prefix="sf-wm-")
    node = _node("CREATE TABLE t (name STRING, ts TIMESTAMP(3), WATERMARK FOR ts AS ts - INTERVAL '5' SECOND)", topic="t")

    def send(n, *times):
        rows = [("t", "k", f'{{"name":"a","ts":"2024-01-01 00:{t}"}}', 0, i, dt.datetime(2024, 1, 1), 0)
                for i, t in enumerate(times)]
        spark.createDataFrame(rows, jobs.ENVELOPE).coalesce(1).write.parquet(f"{d}/in/{n}")

    send(0, "00:10", "00:20")
    s = spark.readStream.schema(jobs.ENVELOPE).option("recursiveFileLookup", "true").parquet(f"{d}/in")
    counts = (X.decode_source(s, node, "drop").groupBy(F.window("ts", "60 seconds").alias("w"), "name")
              .agg(F.count("*").alias("n")).select("w.start", "n"))
    q = (counts.writeStream.format("memory").queryName("late_mem").outputMode("append")
         .option("checkpointLocation", f"{d}/ck").start())
    try:
        q.processAllAvailable()
        send(1, "02:00", "02:30")       # the watermark passes the first minute
        q.processAllAvailable()
        send(2, "00:30", "02:40")       # the first is late
        q.processAllAvailable()
        send(3, "09:00")                # closes the other minutes
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r["start"].minute: r["n"] for r in spark.sql("SELECT * FROM late_mem").collect()}
    assert got == {0: 2, 2: 3}
