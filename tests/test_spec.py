import pytest

from streamfold.operators.routing import dedupe_first_seen, first_seen
from streamfold.plans import spec as X

K = X.KAFKA


def _nodes(*spec):
    return {i: {"id": i, "node_type": t} for i, t in spec}


def _edges(*pairs):
    return [{"source_id": a, "target_id": b} for a, b in pairs]


def test_tracing_fan_in_chain_dangling():
    nodes = _nodes(("k1", K), ("k2", K), ("m", X.MONGODB), ("c", X.CLICKHOUSE), ("s", X.SCYLLADB))
    edges = _edges(("k1", "m"), ("k2", "m"), ("m", "c"), ("ghost", "c"), ("k1", "s"), ("k1", "s"))
    assert sorted(X.upstream_sources("m", nodes, edges)) == ["k1", "k2"]
    assert sorted(X.upstream_sources("c", nodes, edges)) == ["k1", "k2"]   # through the document sink
    assert X.upstream_sources("s", nodes, edges) == ["k1"]                  # deduplicated
    assert X.upstream_sources("k1", nodes, edges) == []


def test_dedupe_first_seen():
    assert dedupe_first_seen(["b", "a", "b", "c", "a"]) == ["b", "a", "c"]


def test_first_seen_over_rows(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, "b", 3), (1, None, 4), (1, "a", 0), (2, "c", 9), (2, "c", 9),
                                (2, "b", 9), (None, "x", 1)], "g int, item string, at int")
    got = {(r.g, r.item): r.place for r in first_seen(df, "g", "item", ["at"]).collect()}
    assert got == {(1, "a"): 1, (1, "b"): 2, (1, None): 3, (2, "b"): 1, (2, "c"): 2, (None, "x"): 1}
    assert first_seen(df.limit(0), "g", "item", ["at"]).count() == 0


def test_user_sql(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "s string, n long")
    assert X.run_user_sql(spark, "CREATE TABLE x (a INT)", {"t": df}) is None
    out = X.run_user_sql(spark, "SELECT 1 AS x; SELECT s, n * 2 AS m FROM t ORDER BY s;", {"t": df})
    assert [tuple(r) for r in out.collect()] == [("a", 2), ("b", 4)]


def test_build_single_source_orphan_and_same_topic(spark):
    env = "topic string, key string, value string, partition int, offset long, timestamp timestamp, timestampType int"
    import datetime as dt
    d = dt.datetime(2024, 1, 1)
    msgs = {"a": spark.createDataFrame([("a", "x", '{"k":"x","v":1}', 0, 1, d, 0),
                                        ("a", "x", '{"k":"x"}', 0, 2, d, 0)], env)}
    h = [["k", "STRING"], ["v", "BIGINT"]]
    spec = {"nodes": [
        {"id": "s1", "node_type": K, "properties": {"topic": "a", "_handles": h}},
        {"id": "s2", "node_type": K, "properties": {"topic": "a", "_handles": [["k", "STRING"]]}},
        {"id": "m", "node_type": X.MONGODB, "properties": {"_handles": h}},
        {"id": "w", "node_type": X.SCYLLADB, "properties": {"_handles": h}},
        {"id": "c", "node_type": X.CLICKHOUSE, "properties": {"_handles": h}},
        {"id": "o", "node_type": X.SCYLLADB, "properties": {"_handles": h}}],
        "edges": _edges(("s1", "m"), ("s1", "w"), ("s2", "w"), ("s1", "c"), ("s2", "c"))}
    out = X.build(spec, lambda t: msgs[t])
    assert "o" not in out                                     # no source: skipped
    # single source into the document sink: last row replaces the document
    assert [tuple(r) for r in out["m"].collect()] == [("x", None)]
    # wide-column: the same topic on two nodes keeps the last node's fields
    assert [tuple(r) for r in out["w"].collect()] == [("x", None)]
    # column store: one view per topic, the first node's fields; appended
    assert sorted(r["v"] or 0 for r in out["c"].collect()) == [0, 1]


def test_cli_batch_mode(spark, tmp_path):
    import json

    from streamfold.__main__ import main
    from streamfold.plans import catalog
    from streamfold.sources import tables as tb
    sf = "/root/testdata/sf0.001"
    tb.topics_union(spark, sf).write.parquet(str(tmp_path / "topics"))
    (tmp_path / "spec.json").write_text(json.dumps(catalog.stand_in_spec()))
    main(["batch", "--spec", str(tmp_path / "spec.json"), "--topics", str(tmp_path / "topics"),
          "--out", str(tmp_path / "out"), "--ttl", "0"])
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out" / "doc")).collect())
    exp = sorted(tuple(r) for r in catalog.q_declarative_spec(spark, sf).collect())
    assert got == exp
    assert spark.read.parquet(str(tmp_path / "out" / "col")).count() == tb.topics_union(spark, sf).count()


def test_cli_batch_default_ttl_is_idle_merge(spark, tmp_path):
    import json

    from streamfold.__main__ import main
    from streamfold.operators import merge
    from streamfold.plans import catalog
    from streamfold.plans import sinks_spec as S
    from streamfold.sources import tables as tb
    from streamfold.sources import topics as tp
    sf = "/root/testdata/sf0.001"
    tb.topics_union(spark, sf).write.parquet(str(tmp_path / "topics"))
    (tmp_path / "spec.json").write_text(json.dumps(catalog.stand_in_spec()))
    main(["batch", "--spec", str(tmp_path / "spec.json"), "--topics", str(tmp_path / "topics"),
          "--out", str(tmp_path / "out")])
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out" / "doc")).collect())
    env = spark.read.parquet(str(tmp_path / "topics"))
    frames = [catalog.align.align_mapped(tp.decode_json(env.filter(env.topic == t), f, mode="FAILFAST"),
                                         t, S.DOC_FIELDS, S.DOC_MAPPING, passthrough=tp.KAFKA_ORDER)
              for t, f in tb.TOPIC_FIELDS.items()]
    exp = merge.merge_idle_ttl(merge.union_all(frames), S.DOC_FIELDS, S.DOC_KEY, tp.KAFKA_ORDER,
                               ts_col="_kafka_ts", ttl_seconds=3600)
    assert got == sorted(tuple(r) for r in exp.collect())


def test_failing_sink_does_not_stop_others(spark):
    import datetime as dt

    import pytest
    env = "topic string, key string, value string, partition int, offset long, timestamp timestamp, timestampType int"
    msgs = spark.createDataFrame([("a", "x", '{"k":"x","v":1}', 0, 1, dt.datetime(2024, 1, 1), 0)], env)
    h = [["k", "STRING"], ["v", "BIGINT"]]
    spec = {"nodes": [
        {"id": "s1", "node_type": K, "properties": {"topic": "a", "_handles": h}},
        {"id": "bad", "node_type": X.MONGODB, "properties": {"_handles": h, "primary_key": ["nope"]}},
        {"id": "ok", "node_type": X.SCYLLADB, "properties": {"_handles": h}}],
        "edges": _edges(("s1", "bad"), ("s1", "ok"))}
    out, errors = X.build_with_errors(spec, lambda t: msgs)
    assert list(out) == ["ok"] and list(errors) == ["bad"]
    with pytest.raises(ValueError):
        X.build(spec, lambda t: msgs)


def test_node_text_declares_fields_and_runs_sql(spark):
    from streamfold.plans import spec as X
    from streamfold.sources import tables as tb
    node = {"id": "n", "node_type": X.KAFKA, "properties": {
        "topic": "trades", "_handles": [["x", "INT"]], "sql": "CREATE TABLE t (symbol STRING, price DOUBLE)"}}
    assert [(f.name, f.type) for f in X.node_fields(node)] == [("symbol", "STRING"), ("price", "DOUBLE")]
    with pytest.raises(ValueError, match="column list"):
        X.node_fields({"id": "n", "sql": "CREATE TABLE t"})
    spec = {"nodes": [node, {"id": "q", "node_type": "transform", "sql": "SELECT count(*) AS n FROM trades"}], "edges": []}
    msgs = tb.topic_messages(spark, "/root/testdata/sf0.001", "trades")
    out = X.run_node_sql(spark, spec, lambda t: msgs)
    assert set(out) == {"q"} and out["q"].first()["n"] == msgs.count()


def test_upstream_sources_follow_edges_once():
    from streamfold.plans import spec as X
    nodes = {i: {"id": i, "node_type": X.KAFKA if i.startswith("k") else X.MONGODB} for i in ("k1", "k2", "k3", "m", "s")}
    edges = [{"source_id": a, "target_id": b} for a, b in
             (("k2", "s"), ("m", "s"), ("k1", "m"), ("k2", "m"), ("s", "m"), ("k3", "k1"), ("gone", "s"))]
    assert X.upstream_sources("s", nodes, edges) == ["k2", "k1"]
