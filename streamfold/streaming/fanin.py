"""One streaming query for many sinks.

Every micro-batch is decoded once, each message by the source nodes of its
topic, kept for the batch, and written to each sink in turn.

*Marks.*  A sink that has written a batch leaves a mark with the batch's number
and counts under the query's checkpoint.  A sink that fails does not stop the
others; the batch fails after them, and when the query starts again the batch
runs only for sinks without its mark.  So a failed sink loses nothing and the
others double nothing.

*Routes.*  The spec is read anew for every batch and stored with the batch's
number before anything is written; a batch that runs again takes the stored
one, so its rows go where they went before.

*Counters.*  ``observe`` on the decoded and the written rows counts them while
they pass; a batch's counters are appended as one small file, and
``Progress`` does the same for what queries report of themselves.
"""

from __future__ import annotations

import json
import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from streamfold.operators import align, merge
from streamfold.plans import spec as X
from streamfold.sinks import stores
from streamfold.sources import topics as tp

log = logging.getLogger(__name__)

COUNTERS = "query string, batch long, metric string, name string, n double"
# Batches whose marks and stored specs are kept.
KEPT_BATCHES = 3


class SinksFailed(RuntimeError):
    """Some sinks of a batch failed; the others have written it."""

    def __init__(self, errors: dict[str, Exception]):
        super().__init__("; ".join(f"{sid}: {type(ex).__name__}: {ex}" for sid, ex in sorted(errors.items())))
        self.errors = errors


class BatchNotes:
    """What a query remembers of its last batches beside its checkpoint: one
    small file a batch and subject."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.root = spark, f"{checkpoint.rstrip('/')}/notes"

    def get(self, subject: str, batch_id: int):
        text = stores.read_text(self.spark, f"{self.root}/{subject}/{batch_id}.json")
        return None if text is None else json.loads(text)

    def put(self, subject: str, batch_id: int, value) -> None:
        stores.write_text(self.spark, f"{self.root}/{subject}/{batch_id}.json", json.dumps(value, default=lambda schema: schema.jsonValue()))
        stores.remove_file(self.spark, f"{self.root}/{subject}/{batch_id - KEPT_BATCHES}.json")

    def versioned(self, subject: str, batch_id: int, load):
        """The value this batch used when it first ran, else ``load()``, kept
        for a replay."""
        held = self.get(subject, batch_id)
        if held is None:
            self.put(subject, batch_id, load())
            held = self.get(subject, batch_id)
        return held


def sink_rows(sink: dict, decoded: dict[str, DataFrame], order, table=None) -> DataFrame:
    """A sink's aligned rows with their order columns, from its sources' rows
    (``{source id: rows}``).  ``table`` is the schema of a column store's
    existing table."""
    fields = X.node_fields(sink)
    props = sink.get("properties") or {}
    keep = tuple(dict.fromkeys([*order, "_topic"]))
    if sink["node_type"] == X.MONGODB:
        mapping = props.get("field_mappings") or {}
        return merge.union_all([align.align_mapped(d, s, fields, mapping, passthrough=keep) for s, d in decoded.items()])
    if sink["node_type"] == X.SCYLLADB:
        return merge.union_all([align.align_null_fill(d, fields, passthrough=keep) for d in decoded.values()])
    return merge.append_fanin([align.align_default_fill(d, X.dest_schema(sink, fields, table), passthrough=("_topic", "_offset"))
                               for d in decoded.values()])


def sink_increment(sink: dict, rows: DataFrame, n_sources: int, order) -> DataFrame:
    """What a micro-batch's rows change in a sink's store."""
    fields = X.node_fields(sink)
    key = X.node_key(sink, fields)
    if sink["node_type"] == X.MONGODB and n_sources > 1:
        return merge.partial_nonnull(rows, fields, key, order)
    if sink["node_type"] in (X.MONGODB, X.SCYLLADB):
        return merge.last_rows(rows, fields, key, order)
    return rows


def stored_result(spark: SparkSession, path: str, sink: dict, n_sources: int, order=tp.KAFKA_ORDER) -> DataFrame:
    """The current table of a sink that writes to files."""
    fields = X.node_fields(sink)
    key = X.node_key(sink, fields)
    stored = spark.read.parquet(path)
    if sink["node_type"] == X.MONGODB and n_sources > 1:
        return merge.fold_nonnull(stored, fields, key)
    if sink["node_type"] in (X.MONGODB, X.SCYLLADB):
        return merge.upsert_last_row(stored, fields, key, order)
    return stored.drop("query", "batch")


class FanIn:
    """The work of one micro-batch, for ``foreachBatch``."""

    def __init__(self, spark: SparkSession, load_spec, out_dir: str, checkpoint: str, only=None,
                 writers: dict | None = None, order=tp.KAFKA_ORDER, now=None, on_counters=None):
        self.spark, self.load_spec, self.out = spark, load_spec, out_dir.rstrip("/")
        self.checkpoint, self.notes = checkpoint, BatchNotes(spark, checkpoint)
        self.only, self.writers, self.order, self.now = only, writers or {}, order, now
        self.on_counters = on_counters
        self._owner = None

    @property
    def owner(self) -> str:
        if self._owner is None:
            self._owner = stores.query_id(self.spark, self.checkpoint) or "query"
        return self._owner

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spec = self.notes.versioned("spec", batch_id, self.load_spec)
        nodes = {n["id"]: n for n in spec["nodes"]}
        feeds = {sid: ids for sid in X.sink_ids(spec) if (self.only is None or self.only(sid))
                 and (ids := X.sink_sources(nodes[sid], nodes, spec.get("edges", [])))}
        sources = {s: (X.node_topic(nodes[s]), X.node_fields(nodes[s]))
                   for s in dict.fromkeys(s for ids in feeds.values() for s in ids)}
        counts: dict[str, list] = {sid: self.notes.get(f"sinks/{sid}", batch_id) for sid in feeds}
        todo = [sid for sid in feeds if counts[sid] is None]
        errors: dict[str, Exception] = {}
        if sources:
            seen = Observation()
            decoded = tp.decode_many(batch, sources).observe(seen, *tp.decode_counts(sources, self.now)).persist()
            try:
                for sid in todo:
                    try:
                        counts[sid] = self._write(nodes[sid], feeds[sid], nodes, decoded, sources, batch_id)
                    except Exception as ex:  # noqa: BLE001  (a failing sink does not stop the others)
                        log.error("sink %s, batch %s: %s", sid, batch_id, ex)
                        errors[sid] = ex
                        continue
                    self.notes.put(f"sinks/{sid}", batch_id, counts[sid])
                if self.notes.get("counted", batch_id) is None and not errors:
                    if not todo:                # all written before: nothing has read the rows yet
                        decoded.write.format("noop").mode("overwrite").save()
                    self._count(batch_id, sources, seen.get, counts)
                    self.notes.put("counted", batch_id, True)
            finally:
                decoded.unpersist()
        if errors:
            raise SinksFailed(errors)

    def _write(self, sink, source_ids, nodes, decoded, sources, batch_id) -> dict:
        mode = "fail" if sink["node_type"] == X.MONGODB else "drop"
        rows = {s: X.D.with_declared(tp.source_rows(decoded, sources, s, mode), X.node_declaration(nodes[s]))
                for s in source_ids}
        key = X.node_key(sink, X.node_fields(sink))
        seen = Observation()
        null_key = F.count_if(stores.any_null(key)).alias("null_key")
        path, table = f"{self.out}/{sink['id']}", None
        store = self.writers.get(sink["node_type"])
        if sink["node_type"] == X.CLICKHOUSE and not store:
            table = X.dest_schema(sink, X.node_fields(sink), stores.table_schema(self.spark, path))
            stores.create_table(self.spark, path, table)
        aligned = sink_rows(sink, rows, self.order, table).observe(seen, F.count(F.lit(1)).alias("written"), null_key)
        out = sink_increment(sink, aligned, len(source_ids), self.order)
        if store:
            store(out, batch_id, sink)
        elif sink["node_type"] == X.CLICKHOUSE:
            stores.append_column_store(out, path, key, batch_id=batch_id, owner=self.owner)
        else:
            stores.append_batch(out, path, batch_id, self.owner)
        got = seen.get
        turned_away = got["null_key"] if sink["node_type"] == X.SCYLLADB else 0
        if turned_away:         # the store takes no NULL key: kept apart, and counted
            stores.append_batch(merge.null_key_rows(sink_rows(sink, rows, self.order), key),
                                f"{self.out}/_rejects/{sink['id']}", batch_id, self.owner)
        return {"written": got["written"] - turned_away, "rejected": turned_away}

    def _count(self, batch_id, sources, seen: dict, counts: dict) -> None:
        rows = []
        for n, (topic, _) in enumerate(sources.values()):
            rows += [("kafka_read", topic, seen[f"read_{n}"]), ("parse_errors", topic, seen[f"bad_{n}"]),
                     *[(f"kafka_lag_{k}", topic, seen[f"lag_{k}_{n}"]) for k in ("n", "min", "avg", "max")]]
        for sid, c in counts.items():
            rows += [("written", sid, c["written"]), ("rejected", sid, c["rejected"])]
        rows = [(self.owner, batch_id, m, name, None if v is None else float(v)) for m, name, v in rows]
        if self.on_counters:
            self.on_counters(rows)
        else:
            append_counters(self.spark, f"{self.out}/_counters", rows)


def append_counters(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    """Counters of one batch as one file in the folder of its query and batch."""
    df = spark.createDataFrame(rows, COUNTERS).drop("query", "batch").coalesce(1)
    stores.append_batch(df, path, rows[0][1], rows[0][0])


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """(query, batch, metric, name, n) of all batches."""
    return spark.read.parquet(path).select("query", F.col("batch").cast("long").alias("batch"), "metric", "name", "n")


class Progress(StreamingQueryListener):
    """Appends what every query of a session reports of a batch: its input
    rows and the metrics its plan observes, as counter rows for
    ``append(rows)``."""

    def __init__(self, append):
        self.append = append

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = [("input_rows", p.name or "", float(p.numInputRows))]
        for name, metrics in p.observedMetrics.items():
            rows += [(k, name, float(v)) for k, v in metrics.asDict().items() if isinstance(v, (int, float))]
        if p.numInputRows:
            self.append([(str(p.id), p.batchId, m, n, v) for m, n, v in rows])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def start_fanin(messages: DataFrame, work: FanIn, name: str, trigger: str):
    """The query that runs ``work`` on every micro-batch of envelopes."""
    return (messages.writeStream.foreachBatch(work).option("checkpointLocation", work.checkpoint)
            .trigger(processingTime=trigger).queryName(name).start())
