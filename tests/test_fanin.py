"""One query for many sinks: marks, routes, counters, guarded writers, SQL jobs."""
import datetime as dt
import json
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from streamfold.operators import merge, metrics
from streamfold.plans import catalog
from streamfold.plans import spec as X
from streamfold.sinks import guarded
from streamfold.sources import tables as tb
from streamfold.sources import topics as tp
from streamfold.streaming import fanin, jobs

SF = "/root/testdata/sf0.001"
NOW = "2024-01-15 00:00:00"


def _send(spark, df, path, n_files=1):
    df.repartition(n_files, F.rand(11)).write.mode("append").parquet(path)


def _stream(spark, path, files=1):
    return jobs.envelope_files_stream(spark, path, max_files_per_trigger=files)


def _run(spark, spec, d, stream, name, **kw):
    return jobs.start_spec(spark, spec, lambda t: stream.filter(F.col("topic") == t), f"{d}/out", name=name,
                           trigger="1 second", checkpoint_root=f"{d}/ck", **kw)


def _drain(queries):
    try:
        for q in queries.values():
            q.processAllAvailable()
    finally:
        for q in queries.values():
            q.stop()


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_one_query_for_all_sinks_equals_batch_with_counters(spark):
    d = tempfile.mkdtemp(prefix="sf-fanin-")
    msgs = tb.topics_union(spark, SF)
    _send(spark, msgs, f"{d}/in", 4)
    spec = catalog.stand_in_spec()
    qs = _run(spark, spec, d, _stream(spark, f"{d}/in", 2), "one", now=F.lit(NOW).cast("timestamp"))
    assert list(qs) == ["fanin"] and not qs.errors
    _drain(qs)
    nodes = {n["id"]: n for n in spec["nodes"]}
    batch = catalog._spec_sinks(spark, SF, with_inserted_at=False)
    for sid in ("doc", "wide"):
        assert _rows(fanin.stored_result(spark, f"{d}/out/{sid}", nodes[sid], 3)) == _rows(batch[sid]), sid
    col = fanin.stored_result(spark, f"{d}/out/col", nodes["col"], 3).select(*batch["col"].columns)
    assert _rows(col) == _rows(batch["col"])
    # counters of the batches together are the batch queries' figures
    c = fanin.read_counters(spark, f"{d}/out/_counters")
    assert c.select("batch").distinct().count() == 2
    total = {(r["metric"], r["name"]): r["n"] for r in c.groupBy("metric", "name").agg(F.sum("n").alias("n")).collect()}
    n_of = {r["topic"]: r["n"] for r in msgs.groupBy("topic").agg(F.count("*").alias("n")).collect()}
    for t, n in n_of.items():
        assert total["kafka_read", t] == n and total["parse_errors", t] == 0
    for sid in ("doc", "wide", "col"):
        assert total["written", sid] == msgs.count() and total["rejected", sid] == 0
    lag = metrics.consumer_lag(msgs, now=F.lit(NOW).cast("timestamp")).groupBy("topic").agg(
        F.count("*").alias("n"), (F.max("lag_s") * 1000).alias("top")).collect()
    top = {(r["metric"], r["name"]): r["n"] for r in c.groupBy("metric", "name").agg(F.max("n").alias("n")).collect()}
    for r in lag:
        assert total["kafka_lag_n", r["topic"]] == r["n"]
        assert top["kafka_lag_max", r["topic"]] == pytest.approx(r["top"])


def _small_spec():
    h = [["k", "STRING"], ["v", "BIGINT"]]
    node = lambda i, kind, **p: {"id": i, "node_type": kind, "properties": {"_handles": h, **p}}
    return {"nodes": [node("s1", X.KAFKA, topic="a"), node("s2", X.KAFKA, topic="b"),
                      node("m", X.MONGODB), node("w", X.SCYLLADB), node("c", X.CLICKHOUSE)],
            "edges": [{"source_id": s, "target_id": t} for s in ("s1", "s2") for t in ("m", "w", "c")]}


def _env(spark, *rows):
    """(topic, value, offset, second)"""
    return spark.createDataFrame([(t, "x", v, 0, o, dt.datetime(2024, 1, 1, 0, 0, s), 0) for t, v, o, s in rows], tb.ENVELOPE)


def test_failing_sink_replays_alone(spark):
    """The wide-column store fails once: the others write the batch once, and
    after the restart only that sink gets it."""
    d = tempfile.mkdtemp(prefix="sf-fail-")
    _send(spark, _env(spark, ("a", '{"k":"x","v":1}', 1, 1), ("b", '{"k":"y","v":2}', 1, 2), ("a", '{"k":null,"v":3}', 2, 3),
                      ("a", "junk", 3, 4)), f"{d}/in")
    got, broken = [], [True]

    def store(kind, fails):
        def write(rows, batch_id, node):
            if fails and broken:
                broken.clear()
                raise OSError("store is down")
            got.extend((kind, batch_id, r["k"], r["v"]) for r in rows.collect())
        return write

    spec = _small_spec()
    spec["nodes"] = [n for n in spec["nodes"] if n["id"] != "m"]        # its decoding fails at the junk
    writers = {X.SCYLLADB: store("w", True), X.CLICKHOUSE: store("c", False)}
    counted = []
    for attempt in range(2):
        qs = _run(spark, spec, d, _stream(spark, f"{d}/in"), "fail_once", writers=writers, on_counters=counted.extend)
        if attempt == 0:
            with pytest.raises(Exception, match="store is down"):
                _drain(qs)
            assert {g[0] for g in got} == {"c"} and not counted
        else:
            _drain(qs)
    w = [("w", 0, "x", 1), ("w", 0, "y", 2)]
    assert sorted(got, key=str) == sorted([("c", 0, "x", 1), ("c", 0, "y", 2), ("c", 0, "", 3), *w], key=str)
    n = {(m, name): v for _, _, m, name, v in counted}
    assert (n["written", "c"], n["written", "w"], n["rejected", "w"]) == (3, 2, 1)
    assert (n["kafka_read", "a"], n["parse_errors", "a"], n["kafka_read", "b"]) == (2, 1, 1)
    assert spark.read.parquet(f"{d}/out/_rejects/w").select("v").collect()[0]["v"] == 3


def test_bad_message_fails_the_document_sink_only(spark):
    d = tempfile.mkdtemp(prefix="sf-bad-")
    _send(spark, _env(spark, ("a", '{"k":"x","v":1}', 1, 1), ("a", "junk", 2, 2)), f"{d}/in")
    with pytest.raises(Exception, match="bad message"):
        _drain(_run(spark, _small_spec(), d, _stream(spark, f"{d}/in"), "bad"))
    assert spark.read.parquet(f"{d}/out/c").count() == 1 and spark.read.parquet(f"{d}/out/w").count() == 1


def test_replayed_batch_keeps_its_routes(spark):
    """A batch that failed goes, after a change of the routes and a restart,
    where it would have gone; the next batch follows the new routes."""
    d = tempfile.mkdtemp(prefix="sf-routes-")
    spec = _small_spec()
    spec["edges"] = [{"source_id": "s1", "target_id": "c"}]
    _send(spark, _env(spark, ("a", '{"k":"x","v":1}', 1, 1), ("b", '{"k":"y","v":2}', 1, 2)), f"{d}/in")
    got, broken = [], [True]

    def write(rows, batch_id, node):
        if broken:
            broken.clear()
            raise OSError("down")
        got.extend((node["id"], batch_id, r["k"]) for r in rows.collect())

    writers = {k: write for k in X.SINK_TYPES}
    with pytest.raises(Exception, match="down"):
        _drain(_run(spark, lambda: spec, d, None, "routes", writers=writers, messages=_stream(spark, f"{d}/in")))
    spec["edges"] = [{"source_id": "s2", "target_id": "w"}]           # another topic, another table
    qs = _run(spark, lambda: spec, d, None, "routes", writers=writers, messages=_stream(spark, f"{d}/in"))
    qs["fanin"].processAllAvailable()
    assert got == [("c", 0, "x")]
    _send(spark, _env(spark, ("a", '{"k":"z","v":1}', 2, 3), ("b", '{"k":"q","v":2}', 2, 4)), f"{d}/in")
    qs["fanin"].processAllAvailable()
    spec["edges"] += [{"source_id": "s1", "target_id": "c"}]          # without a restart
    _send(spark, _env(spark, ("a", '{"k":"r","v":1}', 3, 5)), f"{d}/in")
    _drain(qs)
    assert got == [("c", 0, "x"), ("w", 1, "q"), ("c", 2, "r")]


def test_sinks_that_cannot_be_built(spark):
    spec = _small_spec()
    spec["nodes"][2]["properties"]["primary_key"] = ["nope"]
    spec["nodes"].append({"id": "q", "node_type": "transform", "sql": "INSERT INTO nowhere SELECT 1"})
    d = tempfile.mkdtemp(prefix="sf-err-")
    _send(spark, _env(spark, ("a", '{"k":"x","v":1}', 1, 1)), f"{d}/in")
    with pytest.raises(ValueError, match="nope"):
        _run(spark, spec, d, _stream(spark, f"{d}/in"), "err")
    qs = _run(spark, spec, d, _stream(spark, f"{d}/in"), "err", strict=False)
    assert set(qs.errors) == {"m", "q_sql0"}
    _drain(qs)
    assert spark.read.parquet(f"{d}/out/c").count() == 1


def test_progress_listener_appends_counters(spark):
    d = tempfile.mkdtemp(prefix="sf-listen-")
    _send(spark, tb.topic_messages(spark, SF, "trades"), f"{d}/in", 2)
    got = []
    listener = fanin.Progress(got.extend)
    spark.streams.addListener(listener)
    try:
        rows = _stream(spark, f"{d}/in").observe("messages", F.count(F.lit(1)).alias("n"))
        q = rows.writeStream.format("noop").queryName("listened").option("checkpointLocation", f"{d}/ck").start()
        _drain({"q": q})
        import time
        for _ in range(50):
            if len({b for _, b, *_ in got}) == 2:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    n = tb.topic_messages(spark, SF, "trades").count()
    assert sum(v for _, _, m, _, v in got if m == "input_rows") == n
    assert sum(v for _, _, m, name, v in got if (m, name) == ("n", "messages")) == n


# ------------------------------------------------------------ guarded writers
def _apply_update(doc, stages):
    """The part of update pipelines that ``document_update`` uses."""
    def value(e, d):
        if isinstance(e, str) and e.startswith("$"):
            for part in e[1:].split("."):
                d = d.get(part) if isinstance(d, dict) else None
            return d
        if isinstance(e, list):
            return [value(x, d) for x in e]
        if isinstance(e, dict):
            (op, args), = e.items()
            if op == "$literal":
                return args
            a = [value(x, d) for x in args]
            return {"$ifNull": lambda x, y: y if x is None else x, "$gte": lambda x, y: x >= y,
                    "$cond": lambda t, x, y: x if t else y}[op](*a)
        return e

    for stage in stages:
        new = {path: value(e, doc) for path, e in stage["$set"].items()}
        for path, v in new.items():
            *up, name = path.split(".")
            at = doc
            for u in up:
                at = at.setdefault(u, {})
            at[name] = v


@pytest.mark.parametrize("seed", range(3))
def test_guarded_statements_in_any_order_equal_the_merges(spark, seed):
    """Batches shuffled and repeated, statements applied to a dict: A1 and A2."""
    rnd = random.Random(seed)
    spec = catalog.stand_in_spec()
    nodes = {n["id"]: n for n in spec["nodes"]}
    msgs = tb.topics_union(spark, SF)
    batches = [F.pmod(F.xxhash64("offset"), F.lit(4)) == i for i in range(4)]
    plays = [0, 1, 2, 3, rnd.randrange(4), rnd.randrange(4)]
    rnd.shuffle(plays)
    docs, wide, width = {}, {}, len(X.node_fields(nodes["wide"]))
    order = tp.KAFKA_ORDER
    for i in plays:
        for sid in ("doc", "wide"):
            sink, fields = nodes[sid], X.node_fields(nodes[sid])
            key = X.node_key(sink, fields)
            rows = fanin.sink_rows(sink, {t: X.decode_source(msgs.filter(batches[i] & (F.col("topic") == t)), nodes[t], "drop")
                                          for t in ("trades", "quotes", "clicks")}, order)
            out = fanin.sink_increment(sink, rows, 3, order)
            if sid == "doc":
                for r in out.collect():
                    st = json.loads(json.dumps(guarded.document_update(r.asDict(), fields, key)))
                    _apply_update(docs.setdefault(st["filter"]["_id"]["symbol"], {}), st["update"])
            else:
                for r in guarded.insert_values(out, fields).collect():
                    cells = wide.setdefault(r["symbol"], {})
                    for c, v in list(r.asDict().items())[:width]:
                        if c not in cells or r["write_time"] >= cells[c][0]:
                            cells[c] = (r["write_time"], v)
    batch = catalog._spec_sinks(spark, SF)
    exp = {r["symbol"]: r.asDict() for r in batch["doc"].collect()}
    assert {k: {c: d.get(c) for c in exp[k] if c != "symbol"} for k, d in docs.items()} == \
        {k: {c: v for c, v in d.items() if c != "symbol"} for k, d in exp.items()}
    assert {k: {c: v for c, (_, v) in d.items()} for k, d in wide.items()} == \
        {r["symbol"]: r.asDict() for r in batch["wide"].collect()}


def test_statements_and_flush_sizes(spark):
    node = {"id": "w", "node_type": X.SCYLLADB, "label": "Wide Merged", "properties": {
        "keyspace": "ks", "_handles": [["k", "STRING"], ["v", "BIGINT"]]}}
    assert guarded.insert_statement(node, X.node_fields(node)) == \
        "INSERT INTO ks.wide_merged (k, v) VALUES (?, ?) USING TIMESTAMP ?"
    d = tempfile.mkdtemp(prefix="sf-flush-")

    def connect(statement):
        def run(values):
            import os
            import uuid
            with open(os.path.join(d, uuid.uuid4().hex), "w") as f:
                f.write(f"{len(values)}|{statement}|{values[0]}")
        return run

    rows = spark.range(1250).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"),
                                    F.lit("2024-01-01").cast("timestamp_ntz").alias("_kafka_ts"), F.col("id").alias("_offset"))
    guarded.wide_writer(connect)(rows.coalesce(1), 0, node)
    import os
    seen = [open(os.path.join(d, f)).read().split("|") for f in os.listdir(d)]
    assert sorted(int(n) for n, *_ in seen) == [250, 500, 500]
    assert {s for _, s, _ in seen} == {"INSERT INTO ks.wide_merged (k, v) VALUES (?, ?) USING TIMESTAMP ?"}
    assert [len(c) for c in guarded.in_groups(range(7), 3)] == [3, 3, 1] and list(guarded.in_groups([])) == []


def test_rows_or_time_options():
    o = tp.kafka_options("t", "h:1", min_offsets_per_trigger=500, max_trigger_delay="1s", max_offsets_per_trigger=9)
    assert (o["minOffsetsPerTrigger"], o["maxTriggerDelay"], o["maxOffsetsPerTrigger"]) == ("500", "1s", "9")
    assert "maxTriggerDelay" not in tp.kafka_options("t", "h:1")


# --------------------------------------------------------------------- X1 jobs
def _sql_spec():
    spec = catalog.stand_in_spec()
    spec["nodes"] = [n for n in spec["nodes"] if n["node_type"] == X.KAFKA]
    spec["edges"] = []
    spec["nodes"] += [
        {"id": "totals", "node_type": X.MONGODB, "label": "per symbol", "properties": {
            "_handles": [["symbol", "STRING"], ["n", "BIGINT"], ["top", "DOUBLE"]]}},
        {"id": "big", "node_type": X.CLICKHOUSE, "label": "big-trades", "properties": {
            "_handles": [["symbol", "STRING"], ["price", "DOUBLE"], ["note", "STRING"]]}},
        {"id": "q", "node_type": "transform", "sql":
            "INSERT INTO totals SELECT symbol, count(*), max(price) FROM trades GROUP BY symbol; "
            "INSERT INTO `big_trades` (price, symbol) SELECT price, symbol FROM trades WHERE price > 50 AND symbol <> ';'"}]
    return spec


def test_insert_into_runs_as_stream_and_batch(spark):
    d = tempfile.mkdtemp(prefix="sf-sql-")
    _send(spark, tb.topics_union(spark, SF), f"{d}/in", 3)
    spec = _sql_spec()
    stream = _stream(spark, f"{d}/in")
    qs = _run(spark, spec, d, stream, "sql")
    assert set(qs) == {"q_sql0", "q_sql1"}
    _drain(qs)
    env = spark.read.parquet(f"{d}/in")
    batch = X.run_node_sql(spark, spec, lambda t: env.filter(F.col("topic") == t))
    from streamfold.sinks.stores import newest_rows
    assert _rows(newest_rows(spark.read.parquet(f"{d}/out/totals"), ["symbol"])) == _rows(batch["totals"])
    big = spark.read.parquet(f"{d}/out/big").select("symbol", "price", "note")
    assert _rows(big) == _rows(batch["big"]) and big.count() > 0
    assert X.is_aggregated(batch["totals"]) and not X.is_aggregated(batch["big"])


def test_insert_into_from_the_command_line(spark, tmp_path):
    from streamfold.__main__ import main
    tb.topics_union(spark, SF).write.parquet(str(tmp_path / "topics"))
    (tmp_path / "spec.json").write_text(json.dumps(_sql_spec()))
    args = ["batch", "--spec", str(tmp_path / "spec.json"), "--topics", str(tmp_path / "topics"), "--out", str(tmp_path / "out")]
    main(args)
    assert spark.read.parquet(str(tmp_path / "out" / "totals")).count() == 15
    spec = _sql_spec()
    spec["nodes"][-1]["sql"] = "INSERT INTO totals SELECT symbol, price, 1, 2 FROM trades"
    (tmp_path / "spec.json").write_text(json.dumps(spec))
    with pytest.raises(SystemExit, match="sql"):
        main(args)


def test_insert_positions_and_unknown_columns(spark):
    msgs = tb.topic_messages(spark, SF, "trades")
    job = X.node_inserts(_sql_spec())[1]
    assert job.columns == ["price", "symbol"] and job.sink["id"] == "big"
    job.columns = ["price", "nope"]
    with pytest.raises(ValueError, match="nope"):
        X.insert_rows(spark, job, _sql_spec(), lambda t: msgs)
    assert merge.check_key(X.node_fields(job.sink), ["symbol"]) is None


# ------------------------------------------------------------ K3 existing tables
def test_column_store_aligns_to_the_table_that_is_there(spark):
    """A table with a NOT NULL column of its own and another numeric type: the
    second run writes its columns; one that cannot hold the rows is refused."""
    from pyspark.sql import types as T

    from streamfold.operators import align
    from streamfold.sinks import stores
    d = tempfile.mkdtemp(prefix="sf-table-")
    spec = _small_spec()
    spec["nodes"] = [n for n in spec["nodes"] if n["id"] in ("s1", "s2", "c")]
    table = T.StructType([T.StructField("v", T.DoubleType()), T.StructField("k", T.StringType(), False),
                          T.StructField("grade", T.IntegerType(), False), T.StructField("note", T.StringType())])
    stores.create_table(spark, f"{d}/out/c", table)
    _send(spark, _env(spark, ("a", '{"k":"x","v":1}', 1, 1)), f"{d}/in")
    _drain(_run(spark, spec, d, _stream(spark, f"{d}/in"), "table"))
    assert stores.table_schema(spark, f"{d}/out/c") == table
    r = spark.read.parquet(f"{d}/out/c").select("k", "v", "grade", "note").first()
    assert tuple(r) == ("x", 1.0, 0, None) and isinstance(r["v"], float)
    # the first run made this one
    _drain(_run(spark, {**spec, "nodes": spec["nodes"][:2] + [{**spec["nodes"][2], "id": "new"}],
                        "edges": [{"source_id": "s1", "target_id": "new"}]}, d, _stream(spark, f"{d}/in"), "table2"))
    made = stores.table_schema(spark, f"{d}/out/new")
    assert [(f.name, f.nullable) for f in made.fields] == [("k", False), ("v", True)]
    declared = align.column_store_schema(X.node_fields(spec["nodes"][2]), ["k"])
    for bad in (T.StructType([T.StructField("k", T.StringType())]),
                T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.BooleanType())])):
        with pytest.raises(ValueError, match="does not fit"):
            align.fitted_schema(declared, bad)
    assert stores.table_schema(spark, f"{d}/nowhere") is None
