"""Declarative pipelines (X2) and user SQL.

A spec is the graph the reference stores: ``nodes`` (id, node_type,
label, properties) and ``edges`` (source_id -> target_id).  ``build``
turns it into one DataFrame per sink node, composed from the operators:

* topic source (``kafka``): messages from ``topic_reader(topic)``, decoded
  against the node's declared fields;
* document sink (``mongodb``): P1 alignment with the field mapping, then
  A1 (latest non-null per column) or, with a single source, P8 (the last
  projected row replaces the document);
* wide-column sink (``scylladb``): P3 alignment by name, A2 (last row
  wins); a topic fed by two source nodes keeps the last node's fields;
* column-store sink (``clickhouse``): P2 alignment against the destination
  schema, A3 append; a topic fed by two source nodes keeps the first.

A sink gathers the topic sources upstream of it, tracing through
intermediate sinks, so a sink downstream of a document sink receives the
raw topic rows, not the merged result.  A sink with no source is skipped.
Spark plans the DAG; there is no scheduler or code generation here.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamfold.functions import declare as D
from streamfold.functions.schema import declared_fields, primary_key
from streamfold.operators import align, merge
from streamfold.sources import topics as tp

log = logging.getLogger(__name__)

# Node types of the graph.
KAFKA, MONGODB, SCYLLADB, CLICKHOUSE = "kafka", "mongodb", "scylladb", "clickhouse"
SINK_TYPES = (MONGODB, SCYLLADB, CLICKHOUSE)


def node_declaration(node: dict) -> D.Declaration | None:
    """What the node's own text declares: ``ddl`` (a column list) or its SQL."""
    props = node.get("properties") or {}
    if props.get("ddl"):
        return D.declaration(f"CREATE TABLE t ({props['ddl']})")
    return D.declaration(node_sql(node))


def node_fields(node: dict):
    """Declared fields: the node's own text, then the handles, then the
    default.  Text that declares a table but cannot be read raises."""
    d = node_declaration(node)
    if d is not None and d.fields:
        return d.fields
    return declared_fields((node.get("properties") or {}).get("_handles"))


def node_key(node: dict, fields) -> list[str]:
    """A sink's key: its property, then the PRIMARY KEY of its text, then the
    first field."""
    d = node_declaration(node)
    return primary_key((node.get("properties") or {}).get("primary_key") or (d.key if d else None), fields)


def node_sql(node: dict) -> str:
    """The SQL text a node carries, or nothing."""
    props = node.get("properties") or {}
    return str(node.get("sql") or node.get("flink_sql") or props.get("sql") or "").strip()


# ``INSERT INTO <sink> [(columns)] <query>``
INSERT = re.compile(r"^INSERT\s+INTO\s+`?([\w.]+)`?\s*(\((?:[^()']*)\))?\s*((?:SELECT|WITH)\b.*)$", re.I | re.S)


@dataclass
class InsertJob:
    """One INSERT INTO of a node's text: the query and the sink it fills."""

    name: str
    sink: dict
    columns: list[str] | None
    query: str


def node_inserts(spec: dict, errors: dict | None = None) -> list[InsertJob]:
    """The INSERT INTO statements of the nodes' text.  A sink goes by its id,
    its label or its table name; an unknown one raises, or is noted in
    ``errors``."""
    names: dict[str, dict] = {}
    for n in spec["nodes"]:
        if n["node_type"] in SINK_TYPES:
            table = (n.get("properties") or {}).get("table")
            for name in (n["id"], n.get("label"), table, str(n.get("label", "")).lower().replace(" ", "_").replace("-", "_")):
                if name:
                    names.setdefault(str(name).lower(), n)
    out = []
    for n in spec["nodes"]:
        for i, text in enumerate(D.split_top(node_sql(n), ";")):
            if not (m := INSERT.match(text)):
                continue
            name = f"{n['id']}_sql{i}"
            sink = names.get(m.group(1).lower())
            if sink is None:
                if errors is None:
                    raise ValueError(f"{name}: no sink {m.group(1)!r}")
                errors[name] = f"no sink {m.group(1)!r}"
                continue
            columns = [c.strip("` ") for c in D.split_top(m.group(2)[1:-1])] if m.group(2) else None
            out.append(InsertJob(name, sink, columns, m.group(3)))
    return out


def topic_views(spec: dict, topic_reader: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """The decoded topic sources by topic name."""
    return {node_topic(n): decode_source(read_node(topic_reader, n), n, "drop")
            for n in spec["nodes"] if n["node_type"] == KAFKA}


def insert_rows(spark: SparkSession, job: InsertJob, spec: dict, topic_reader) -> DataFrame:
    """The rows of an INSERT INTO, by position the sink's columns (or the
    listed ones), aligned to the sink's fields by name."""
    rows = run_user_sql(spark, job.query, topic_views(spec, topic_reader))
    fields = node_fields(job.sink)
    names = job.columns or [f.name for f in fields][:len(rows.columns)]
    if len(names) != len(rows.columns) or not set(names) <= {f.name for f in fields}:
        raise ValueError(f"{job.name}: {len(rows.columns)} columns for {names} of {job.sink['id']}")
    rows = rows.toDF(*names)
    if job.sink["node_type"] == CLICKHOUSE:
        return align.align_default_fill(rows, dest_schema(job.sink, fields))
    return align.align_null_fill(rows, fields)


def is_aggregated(rows: DataFrame) -> bool:
    """Whether a query groups its rows (its analysed plan has an Aggregate), so
    that a stream of it updates rows it has given before."""
    plan = rows._jdf.queryExecution().analyzed().toString()
    return bool(re.search(r"^[ :+~-]*(Aggregate|Deduplicate)\b", plan, re.M))


def run_node_sql(spark: SparkSession, spec: dict, topic_reader: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    """X1 inside X2: run the SQL text of every node that has some and is no
    declaration, with the decoded topic sources as views named by topic.
    Returns {node id: result of its last query}, and {sink id: rows} for what
    INSERT INTO statements bring a sink."""
    results: dict[str, DataFrame] = {}
    views = topic_views(spec, topic_reader)
    for n in spec["nodes"]:
        plain = [t for t in D.split_top(node_sql(n), ";") if not INSERT.match(t)]
        result = run_user_sql(spark, ";".join(plain), views)
        if result is not None:
            results[n["id"]] = result
    for job in node_inserts(spec):
        rows = insert_rows(spark, job, spec, topic_reader)
        sid = job.sink["id"]
        results[sid] = results[sid].unionByName(rows) if sid in results else rows
    return results


def dest_schema(sink: dict, fields, existing: T.StructType | None = None) -> T.StructType:
    """A column-store sink's table: the schema its node carries (Spark's own
    or its JSON form), else that of the ``existing`` table if the declared
    columns fit it, else the one the sink would create."""
    given = (sink.get("properties") or {}).get("dest_schema")
    if given is None:
        return align.fitted_schema(align.column_store_schema(fields, node_key(sink, fields)), existing)
    return given if isinstance(given, T.StructType) else T.StructType.fromJson(given)


def node_topic(node: dict) -> str:
    props = node.get("properties") or {}
    return props.get("topic") or str(node.get("label", node["id"])).lower().replace(" ", "_")


def feeders(edges: list[dict]) -> dict[str, list[str]]:
    """Adjacency of the graph against its edges: node id to the ids that feed
    it, in the order of the edges."""
    into: dict[str, list[str]] = {}
    for e in edges:
        into.setdefault(e["target_id"], []).append(e["source_id"])
    return into


def upstream_sources(node_id: str, nodes: dict, edges: list[dict]) -> list[str]:
    """Topic sources that feed ``node_id``, through any other nodes; a topic
    ends its path.  Each once, in the order in which a walk that follows the
    edges in their order first meets it (U2)."""
    into = feeders(edges)
    met: dict[str, None] = {}

    def walk(at: str) -> None:
        for nid in into.get(at, ()):
            if nid in nodes and nid not in met:
                met[nid] = None
                if nodes[nid]["node_type"] != KAFKA:
                    walk(nid)

    walk(node_id)
    return [nid for nid in met if nodes[nid]["node_type"] == KAFKA]


def read_node(topic_reader: Callable[..., DataFrame], node: dict) -> DataFrame:
    """A topic node's messages.  The reader gets the topic and, where the node
    names one, its consumer group as ``group_id``."""
    return topic_reader(node_topic(node), **tp.node_reader_options(node))


def decode_source(messages: DataFrame, node: dict, mode: str) -> DataFrame:
    """Decode one topic node's messages.  ``mode``: ``fail`` (document
    sink, the job fails on a bad record), ``skip`` (column store) or
    ``drop`` (wide-column consumer; count with ``count_bad`` separately)."""
    how = {"mode": "FAILFAST"} if mode == "fail" else {"drop_bad": True}
    return D.with_declared(tp.decode_json(messages, node_fields(node), **how), node_declaration(node))


def sink_ids(spec: dict) -> list[str]:
    return [n["id"] for n in spec["nodes"] if n["node_type"] in SINK_TYPES]


def sink_sources(sink: dict, nodes: dict, edges: list[dict]) -> list[str]:
    ids = upstream_sources(sink["id"], nodes, edges)
    if sink["node_type"] == MONGODB:
        return ids
    # native sinks key their routes by topic
    by_topic: dict[str, str] = {}
    for sid in ids:
        t = node_topic(nodes[sid])
        if sink["node_type"] == SCYLLADB or t not in by_topic:
            by_topic[t] = sid
    return list(by_topic.values())


def build_sink(sink: dict, nodes: dict, edges: list[dict], topic_reader: Callable[[str], DataFrame],
               order=tp.KAFKA_ORDER, ttl_seconds: int | None = None,
               with_inserted_at: bool = True, reduce_wide: bool = True,
               table_schema: Callable[[dict], T.StructType | None] = lambda sink: None) -> DataFrame | None:
    """One sink node's result, or None when no source feeds it.
    ``table_schema(sink)`` gives the schema of a column store's existing table.  With
    ``reduce_wide=False`` a wide-column sink's aligned rows are returned
    unfolded, with their order columns (streams fold them per micro-batch)."""
    src_ids = sink_sources(sink, nodes, edges)
    if not src_ids:
        log.warning("sink %s has no upstream topic source; nothing flows in", sink["id"])
        return None
    props = sink.get("properties") or {}
    fields = node_fields(sink)
    key = node_key(sink, fields)
    kind = sink["node_type"]
    keep = tuple(order) + ("_topic",) if "_topic" not in order else tuple(order)

    if kind == MONGODB:
        mapping = props.get("field_mappings") or {}
        frames = [align.align_mapped(decode_source(read_node(topic_reader, nodes[s]), nodes[s], "fail"),
                                     s, fields, mapping, passthrough=keep) for s in src_ids]
        u = merge.union_all(frames)
        if len(frames) == 1:
            return merge.upsert_last_row(u, fields, key, order)
        if ttl_seconds:
            if u.isStreaming:       # window functions are batch-only: state TTL instead
                from streamfold.streaming.state import idle_merge_stream
                vals = [f.name for f in fields if f.name not in key]
                return idle_merge_stream(u, key, vals, list(order), ttl_seconds).select(
                    *[f.name for f in fields])
            return merge.merge_idle_ttl(u, fields, key, order, ts_col=order[0], ttl_seconds=ttl_seconds)
        return merge.merge_latest_nonnull(u, fields, key, order)

    if kind == SCYLLADB:
        frames = [align.align_null_fill(decode_source(read_node(topic_reader, nodes[s]), nodes[s], "drop"),
                                        fields, passthrough=keep) for s in src_ids]
        u = merge.union_all(frames)
        return merge.upsert_last_row(u, fields, key, order) if reduce_wide else u

    if kind == CLICKHOUSE:
        dest = dest_schema(sink, fields, table_schema(sink))
        frames = [align.align_default_fill(decode_source(read_node(topic_reader, nodes[s]), nodes[s], "skip"),
                                           dest, passthrough=("_topic", "_offset")) for s in src_ids]
        out = merge.append_fanin(frames)
        if with_inserted_at:
            out = out.withColumn("inserted_at", F.current_timestamp())
        return out

    raise ValueError(f"not a sink type: {kind}")


def build_with_errors(spec: dict, topic_reader: Callable[[str], DataFrame], only=None,
                      **kw) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """The sinks of a spec (all, or the ids in ``only``) and the sinks that
    failed to build: ``({sink id: DataFrame}, {sink id: error})``.  A
    failing sink does not stop the others, as a failing node does not stop
    the reference's run."""
    nodes = {n["id"]: n for n in spec["nodes"]}
    edges = spec.get("edges", [])
    out, errors = {}, {}
    for n in spec["nodes"]:
        if n["node_type"] in SINK_TYPES and (only is None or n["id"] in only):
            try:
                df = build_sink(n, nodes, edges, topic_reader, **kw)
            except Exception as ex:  # noqa: BLE001
                log.error("sink %s failed to build: %s", n["id"], ex)
                errors[n["id"]] = f"{type(ex).__name__}: {ex}"
                continue
            if df is not None:
                out[n["id"]] = df
    return out, errors


def build(spec: dict, topic_reader: Callable[[str], DataFrame], only=None, strict: bool = True,
          **kw) -> dict[str, DataFrame]:
    """The sinks of a spec: ``{sink id: DataFrame}``.  ``strict=False``
    logs and skips a sink that fails to build; by default the first failure
    raises."""
    out, errors = build_with_errors(spec, topic_reader, only=only, **kw)
    if strict and errors:
        raise ValueError(f"sinks failed to build: {errors}")
    return out


# ---------------------------------------------------------------- X1
def run_user_sql(spark: SparkSession, text: str, views: dict[str, DataFrame] | None = None) -> DataFrame | None:
    """Register ``views`` as temp views and run the user's SQL (Spark SQL
    dialect).  Text starting with CREATE is a declaration and runs nothing;
    otherwise it is split at each ';' outside quotes and every statement runs;
    the last result is returned."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    body = (text or "").strip()
    if not body or body.upper().startswith("CREATE"):
        return None
    result = None
    for stmt in D.split_top(body, ";"):
        result = spark.sql(stmt)
    return result
