"""Sinks (K1-K4).

With a store connector on the classpath, hand ``start_spec`` a writer that uses
the store's own upsert (``sinks.guarded`` builds its statements) or append.
Without one, every micro-batch becomes plain Parquet in a folder of its query
and batch (``append_batch``), and reading folds them with the merges:

* K1: ``merge.partial_nonnull`` per batch, ``merge.fold_nonnull`` on reading;
* K2: ``merge.last_rows`` per batch, ``merge.upsert_last_row`` on reading;
* K3: ``append_column_store``, sorted by key within files, with an
  ``inserted_at`` time stamp;
* merged rows without an order (a stream's update mode): ``newest_rows``.

K4: ``topic_rows`` / ``write_topic`` / ``start_topic``, keyed JSON messages.

A query is named by the id that Spark keeps in its checkpoint, so a replayed
batch overwrites its own folder, and a query with a new checkpoint, whose batch
numbers start again at 0, adds to what another query has stored.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamfold.functions.scalar import to_json_all

def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def query_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id of the streaming query that owns a checkpoint folder, or None
    for a folder no query has used."""
    fs, p = _fs(spark, f"{checkpoint.rstrip('/')}/metadata")
    if not fs.exists(p):
        return None
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file of the driver's own, or None."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, put in place whole."""
    fs, p = _fs(spark, path)
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.new")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(p, False)
    fs.rename(draft, p)


def remove_file(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, False)


def any_null(key: list[str]):
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])


# Columns that a sink adds to what its sources bring.
ADDED = ("inserted_at", "_topic", "_offset", "query", "batch")


def table_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns of the column-store table under ``path`` with their
    nullability, as kept beside its files; without such a note the files'
    columns; None where there is no table."""
    path = path.rstrip("/")
    note = read_text(spark, f"{path}/_schema.json")
    if note is not None:
        return T.StructType.fromJson(json.loads(note))
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    return T.StructType([f for f in spark.read.parquet(path).schema.fields if f.name not in ADDED])


def create_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Keep a table's schema beside its files, if it is new."""
    if read_text(spark, f"{path.rstrip('/')}/_schema.json") is None:
        write_text(spark, f"{path.rstrip('/')}/_schema.json", json.dumps(schema.jsonValue()))


def append_batch(df: DataFrame, path: str, batch_id: int, owner: str) -> None:
    """One micro-batch to the folder of its query and batch."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/query={owner}/batch={batch_id}")


def newest_rows(stored: DataFrame, key: list[str]) -> DataFrame:
    """The row of each key that was written last, of batches stored with
    their time in ``_at``."""
    names = [c for c in stored.columns if c not in ("_at", "query", "batch")]
    row = F.max_by(F.struct(*names), F.struct("_at", "batch")).alias("_row")
    return stored.groupBy(*key).agg(row).select("_row.*")


def append_column_store(df: DataFrame, path: str, key: list[str], inserted_at: bool = True,
                        batch_id: int | None = None, owner: str = "batch") -> None:
    """K3: append rows sorted by key within each file.  With ``batch_id``
    (from ``foreachBatch``) the rows go to the folder of their query and
    batch, overwritten on replay, so a retried batch is not appended twice."""
    if inserted_at:
        df = df.withColumn("inserted_at", F.current_timestamp())
    out = df.sortWithinPartitions(*key)
    if batch_id is None:
        out.write.mode("append").parquet(path)
    else:
        append_batch(out, path, batch_id, owner)


def topic_rows(df: DataFrame, key_col: str) -> DataFrame:
    """K4: (key, value) rows: key = the symbol, value = JSON of the row with
    NULL fields kept."""
    return df.select(F.col(key_col).cast("string").alias("key"),
                     to_json_all(*[F.col(c) for c in df.columns]).alias("value"))


def kafka_sink_options(bootstrap: str, topic: str) -> dict:
    """Producer options of the reference's feed: lz4, small linger."""
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic,
            "kafka.compression.type": "lz4", "kafka.linger.ms": "5"}


def write_topic(df: DataFrame, key_col: str, bootstrap: str, topic: str) -> None:
    """Batch write of keyed JSON messages (needs the Kafka connector)."""
    topic_rows(df, key_col).write.format("kafka").options(**kafka_sink_options(bootstrap, topic)).save()


def start_topic(rows: DataFrame, key_col: str, bootstrap: str, topic: str, checkpoint: str, name: str):
    """K4 on a stream: every row as a keyed JSON message."""
    return (topic_rows(rows, key_col).writeStream.format("kafka").options(**kafka_sink_options(bootstrap, topic))
            .option("checkpointLocation", checkpoint).queryName(name).start())
