"""Streaming forms equal the batch forms on the same input."""
import os
import tempfile

from pyspark.sql import functions as F

from streamfold.operators import enrich, merge
from streamfold.plans import sinks_spec as S
from streamfold.sinks.stores import append_column_store, newest_rows, query_id, topic_rows
from streamfold.sources import tables as tb
from streamfold.sources import topics as tp
from streamfold.streaming import jobs, state

SF = "/root/testdata/sf0.001"


def _write_envelopes(spark, df, path, n_files):
    # shuffled into several files: arrival order differs from event order
    df.repartition(n_files, F.rand(11)).write.mode("overwrite").parquet(path)


def test_doc_merge_stream_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="sf-stream-")
    _write_envelopes(spark, tb.topics_union(spark, SF, with_bad=True), f"{d}/in", 5)
    msgs = jobs.envelope_files_stream(spark, f"{d}/in", max_files_per_trigger=2)
    srcs = {t: jobs.decoded_stream(msgs.filter(F.col("topic") == t), f) for t, f in tb.TOPIC_FIELDS.items()}
    merged = jobs.doc_merge_stream(srcs, S.DOC_FIELDS, S.DOC_KEY, S.DOC_MAPPING, tp.KAFKA_ORDER)
    q = jobs.start_merge(merged, f"{d}/snap", "doc_merge_test", trigger="1 second", checkpoint=f"{d}/ck")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    snap = newest_rows(spark.read.parquet(f"{d}/snap"), S.DOC_KEY)
    got = sorted(tuple(r) for r in snap.select(*[f.name for f in S.DOC_FIELDS]).collect())
    bmsgs = spark.read.parquet(f"{d}/in")
    bsrcs = {t: tp.skip_bad(tp.decode_json(bmsgs.filter(F.col("topic") == t), f))
             for t, f in tb.TOPIC_FIELDS.items()}
    exp_df = jobs.doc_merge_stream(bsrcs, S.DOC_FIELDS, S.DOC_KEY, S.DOC_MAPPING, tp.KAFKA_ORDER)
    exp = sorted(tuple(r) for r in exp_df.collect())
    assert len(got) == 15 and got == exp   # 15 users at sf0.001


def test_new_checkpoint_neither_skips_nor_overwrites(spark):
    """Two queries, two checkpoints, one folder each for K1 and K3: the second
    one's batches start at 0 again, and every row of both is there."""
    d = tempfile.mkdtemp(prefix="sf-own-")
    schema = "k string, v long"
    for n, rows in (("1", [("a", 1), ("b", 2)]), ("2", [("b", 3), ("c", 4)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/in{n}")
    for n in ("1", "2"):
        s = spark.readStream.schema(schema).parquet(f"{d}/in{n}")
        for q in (jobs.start_merge(s, f"{d}/keyed", f"own_m{n}", trigger="1 second", checkpoint=f"{d}/ckm{n}", mode="append"),
                  jobs.start_append(s, f"{d}/append", ["k"], f"own_a{n}", trigger="1 second", checkpoint=f"{d}/cka{n}")):
            q.processAllAvailable()
            q.stop()
    stored = spark.read.parquet(f"{d}/keyed")
    assert sorted(tuple(r) for r in newest_rows(stored, ["k"]).collect()) == [("a", 1), ("b", 3), ("c", 4)]
    assert {r["query"] for r in stored.collect()} == {query_id(spark, f"{d}/ckm{n}") for n in "12"}
    out = spark.read.parquet(f"{d}/append")
    assert sorted((r["k"], r["v"]) for r in out.collect()) == [("a", 1), ("b", 2), ("b", 3), ("c", 4)]
    append_column_store(spark.createDataFrame([("z", 1)], schema), f"{d}/plain", ["k"])
    assert spark.read.parquet(f"{d}/plain").count() == 1


def test_enrichment_job(spark):
    """S7 + S8 -> J1 -> P4 -> K4 as one streaming query."""
    import json
    d = tempfile.mkdtemp(prefix="sf-enr-job-")
    schema = tb.ENVELOPE
    at = "timestamp '2024-01-01 00:00:{:02d}'"
    def env(topic, key, value, offset, sec):
        return spark.sql(f"select '{topic}' topic, '{key}' key, '{value}' value, 0 partition, {offset}L offset, "
                         f"{at.format(sec)} timestamp, 0 timestampType")
    env("q", "A", '{"c":9,"h":1,"l":1,"o":1,"pc":8,"t":1}', 1, 1).write.parquet(f"{d}/q")
    env("t", "x", '{"type":"trade","data":[{"s":"A","p":10,"v":1,"t":5},{"s":"B","p":1,"v":1,"t":5}]}', 1, 5) \
        .write.parquet(f"{d}/t")
    read = lambda p: spark.readStream.schema(schema).parquet(p)
    got = []
    q = jobs.start_enrichment(read(f"{d}/t"), read(f"{d}/q"), "enr_job", checkpoint=f"{d}/ck",
                              writer=lambda b, i: got.extend(tuple(r) for r in b.collect()))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert [k for k, _ in got] == ["A"]
    assert json.loads(got[0][1])["pct_change"] == 25.0


def _asof_out(spark, d, trades, quotes, parts, name, **kw):
    """Runs the streaming as-of join over the parts of both sides, one
    micro-batch a part, and returns the rows it wrote, by batch."""
    from streamfold.streaming.asof import start_asof
    got, plans, qs = {}, [], None

    def write(rows, batch_id):
        got[batch_id] = [tuple(r) for r in rows.drop("_ts").collect()]
        plans.append(rows._jdf.queryExecution().executedPlan().toString())

    for t, q in parts(trades, quotes):
        t.select(F.lit("t").alias("side"), F.struct("*").alias("t"), F.lit(None).cast(_kind(quotes)).alias("q")) \
            .unionByName(q.select(F.lit("q").alias("side"), F.lit(None).cast(_kind(trades)).alias("t"), F.struct("*").alias("q"))) \
            .coalesce(1).write.mode("append").parquet(f"{d}/in")
        if qs is None:
            s = spark.readStream.schema(spark.read.parquet(f"{d}/in").schema).parquet(f"{d}/in")
            qs = start_asof(s.filter("side = 't'").select("t.*"), s.filter("side = 'q'").select("q.*"), ["symbol"], "_ts",
                            "_seq", enrich.QUOTE_FIELDS, name, write, checkpoint=f"{d}/ck", **kw)
        qs.processAllAvailable()
    qs.stop()
    return got, plans


def _kind(df):
    return df.select(F.struct("*").alias("x")).schema["x"].dataType


def test_asof_stream_equals_batch_across_batches(spark):
    """Four micro-batches in time order, a third of the rows on one symbol:
    the batch result, dealt out by symbol and chunk."""
    d = tempfile.mkdtemp(prefix="sf-enrich-")
    hot = F.when(F.pmod("_seq", F.lit(3)) == 0, F.lit("hot")).otherwise(F.col("symbol")).alias("symbol")
    trades = tb.trades(spark, SF).withColumn("symbol", hot)
    quotes = tb.quotes(spark, SF).withColumn("symbol", hot)
    cuts = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2025-01-01"]

    def parts(t, q):
        for a, b in zip(cuts, cuts[1:]):
            p = (F.col("_ts") >= a) & (F.col("_ts") < b)
            yield t.filter(p), q.filter(p)

    got, plans = _asof_out(spark, d, trades, quotes, parts, "asof_hot")
    exp = enrich.asof_latest(trades, quotes, ["symbol"], "_ts", "_seq", enrich.QUOTE_FIELDS, prefix="quote_")
    assert len(got) == 4
    assert sorted(r for rows in got.values() for r in rows) == sorted(tuple(r) for r in exp.drop("_ts").collect())
    assert all("hashpartitioning(symbol" in p and "_chunk" in p for p in plans)
    assert not any("MapInPandas" in p or "TransformWithState" in p for p in plans)


def test_asof_stream_takes_quotes_by_arrival_and_replays_alike(spark):
    """A quote that arrived in an earlier batch holds for a trade with an older
    time; a batch that runs again reads the book it read before."""
    from streamfold.streaming.asof import AsofBatches
    d = tempfile.mkdtemp(prefix="sf-book-")
    schema = "left struct<symbol:string,price:double,at:timestamp,seq:long>, right struct<symbol:string,pc:double,at:timestamp,seq:long>"
    import datetime as dt
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    b0 = spark.createDataFrame([(None, ("a", 1.0, at(50), 1)), (("a", 9.0, at(40), 1), None), (None, (None, 7.0, at(1), 2))], schema)
    b1 = spark.createDataFrame([(("a", 8.0, at(10), 2), None), (None, ("a", 2.0, at(20), 3)), (("a", 7.0, at(30), 4), None),
                                (("b", 6.0, at(30), 5), None)], schema)
    b2 = spark.createDataFrame([(("a", 5.0, at(1), 6), None)], schema)
    got = []
    work = AsofBatches(spark, f"{d}/book", ["symbol"], "at", "seq", ["pc"], "quote_",
                       lambda rows, i: got.append((i, sorted((r["price"], r["quote_pc"]) for r in rows.collect()))))
    for i, b in ((0, b0), (1, b1), (2, b2), (1, b1), (2, b2)):
        work(b, i)
    assert got == [(0, []), (1, [(7.0, 2.0), (8.0, 1.0)]), (2, [(5.0, 2.0)]), (1, [(7.0, 2.0), (8.0, 1.0)]), (2, [(5.0, 2.0)])]
    assert work.additions() == [0, 1] and work.folds() == []


def test_quote_book_is_folded_and_batches_replay_alike(spark, monkeypatch):
    """Many small batches: few tables are kept, and every batch that runs again
    gives what it gave, also the one that folded."""
    from streamfold.streaming import asof
    monkeypatch.setattr(asof, "FOLD_EVERY", 2)
    d = tempfile.mkdtemp(prefix="sf-book-")
    schema = "left struct<symbol:string,price:double,at:timestamp,seq:long>, right struct<symbol:string,pc:double,at:timestamp,seq:long>"
    import datetime as dt
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    got = {}
    work = asof.AsofBatches(spark, f"{d}/book", ["symbol"], "at", "seq", ["pc"], "quote_",
                            lambda rows, i: got.setdefault(i, []).append(sorted((r["symbol"], r["quote_pc"]) for r in rows.collect())))
    current, want = {}, {}
    for i in range(9):
        rows = [((s, 1.0, at(i), 10 * i), None) for s in "abc"] + [(None, ("abc"[i % 3], float(i), at(30 + i), i))]
        want[i] = sorted(current.items())
        work(spark.createDataFrame(rows, schema), i)
        work(spark.createDataFrame(rows, schema), i)
        current["abc"[i % 3]] = float(i)
    assert got == {i: [w, w] for i, w in want.items()}
    assert len(work.folds()) == asof.KEPT_FOLDS and len(work.additions()) <= 6
    assert len(work._tables_before(9)) <= asof.FOLD_EVERY + 1


def test_topic_rows_keep_nulls(spark):
    df = spark.createDataFrame([("A", None, 2.0)], "symbol string, price double, volume double")
    r = topic_rows(df, "symbol").collect()[0]
    assert r["key"] == "A" and r["value"] == '{"symbol":"A","price":null,"volume":2.0}'


def test_windowed_counts_stream(spark):
    d = tempfile.mkdtemp(prefix="sf-win-")
    tb.read_table(spark, SF, "events").write.parquet(f"{d}/in")
    schema = tb.read_table(spark, SF, "events").schema
    s = spark.readStream.schema(schema).parquet(f"{d}/in")
    q = (jobs.windowed_counts(s, "ts", "event_type", "1 hour").writeStream.format("memory")
         .queryName("win_mem").outputMode("append").option("checkpointLocation", f"{d}/ck").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    n = spark.sql("SELECT sum(total) AS n FROM win_mem").collect()[0]["n"]
    # the last windows stay open behind the watermark in append mode
    assert 0 < n <= 1000


def test_append_and_fanout_streams(spark):
    d = tempfile.mkdtemp(prefix="sf-append-")
    _write_envelopes(spark, tb.topics_union(spark, SF), f"{d}/in", 3)
    msgs = jobs.envelope_files_stream(spark, f"{d}/in", max_files_per_trigger=1)
    rows = jobs.decoded_stream(msgs.filter("topic = 'trades'"), tb.TRADES_FIELDS)
    q = jobs.start_append(rows, f"{d}/out", ["symbol"], "append_test", trigger="1 second",
                          checkpoint=f"{d}/ck1")
    got = {}
    q2 = jobs.start_fanout(msgs, {"n": lambda b, i: got.__setitem__(i, b.count())}, "fanout_test",
                           trigger="1 second", checkpoint=f"{d}/ck2")
    try:
        q.processAllAvailable()
        q2.processAllAvailable()
    finally:
        q.stop()
        q2.stop()
    out = spark.read.parquet(f"{d}/out")
    assert out.count() == tb.trades(spark, SF).count()
    assert "inserted_at" in out.columns
    assert sum(got.values()) == tb.topics_union(spark, SF).count()


def test_route_refresh_between_batches(spark):
    from streamfold.operators.routing import refreshing_router
    routes = {"a": ["trades"]}
    seen = []
    each = refreshing_router(lambda: dict(routes), {"a": lambda b, i: seen.append((i, b.count())),
                                                    "b": lambda b, i: seen.append((i, -b.count()))})
    msgs = tb.topics_union(spark, SF)
    each(msgs, 0)
    routes["b"] = ["quotes", "quotes"]        # picked up on the next batch
    each(msgs, 1)
    import pytest
    routes["new"] = ["clicks"]
    with pytest.raises(ValueError, match="new"):       # no row is passed over in silence
        each(msgs, 2)
    n_t, n_q = tb.trades(spark, SF).count(), tb.quotes(spark, SF).count()
    assert seen == [(0, n_t), (1, n_t), (1, -n_q)]


def test_idle_merge_stream_merges_latest_nonnull(spark):
    import datetime as dt
    state.use_rocksdb(spark)
    d = tempfile.mkdtemp(prefix="sf-ttl-")
    t0 = dt.datetime(2024, 1, 1)
    spark.createDataFrame([("x", 1.0, "a", t0, 1), ("x", None, "b", t0 + dt.timedelta(seconds=1), 2),
                           ("y", 5.0, None, t0, 3), ("x", 9.0, None, t0 - dt.timedelta(seconds=9), 4)], "k string, a double, b string, ts timestamp, id long") \
        .write.parquet(f"{d}/in")
    s = spark.readStream.schema("k string, a double, b string, ts timestamp, id long").parquet(f"{d}/in")
    out = state.idle_merge_stream(s, "k", ["a", "b"], ["ts", "id"], ttl_seconds=3600)
    q = (out.writeStream.format("memory").queryName("ttl_mem").outputMode("update")
         .trigger(processingTime="1 second").option("checkpointLocation", f"{d}/ck").start())
    # a ProcessingTime-mode query keeps running timer batches, so
    # processAllAvailable() does not return: poll the sink instead
    import time
    got = []
    try:
        deadline = time.time() + 120
        while time.time() < deadline and len(got) < 2:
            time.sleep(2)
            got = sorted(tuple(r) for r in spark.sql("SELECT * FROM ttl_mem").collect())
    finally:
        q.stop()
    assert got == [("x", 1.0, "b"), ("y", 5.0, None)]


def test_shared_checkpoint_dir_reads_session(spark):
    from streamfold.session import checkpoint_subdir, shared_checkpoint_dir
    d = shared_checkpoint_dir(spark)
    assert d and d == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert checkpoint_subdir(spark, "x").startswith(d)


def test_increments_equal_full_merge(spark):
    """Increments in any order, one of them twice, fold to the merge of all rows."""
    from streamfold.plans import catalog
    order = ["_ts", "_seq"]
    cuts = ["2024-01-10", "2024-01-20"]
    parts = [F.col("_ts") >= cuts[1], F.col("_ts") < cuts[0], (F.col("_ts") >= cuts[0]) & (F.col("_ts") < cuts[1]),
             F.col("_ts") < cuts[0]]
    doc, wide = catalog._aligned_doc(spark, SF), catalog._aligned_wide(spark, SF)
    stored = merge.union_all([merge.partial_nonnull(doc.filter(p), S.DOC_FIELDS, S.DOC_KEY, order) for p in parts])
    assert sorted(tuple(r) for r in merge.fold_nonnull(stored, S.DOC_FIELDS, S.DOC_KEY).collect()) == \
        sorted(tuple(r) for r in merge.merge_latest_nonnull(doc, S.DOC_FIELDS, S.DOC_KEY, order).collect())
    stored = merge.union_all([merge.last_rows(wide.filter(p), S.WIDE_FIELDS, S.WIDE_KEY, order) for p in parts])
    assert sorted(tuple(r) for r in merge.upsert_last_row(stored, S.WIDE_FIELDS, S.WIDE_KEY, order).collect()) == \
        sorted(tuple(r) for r in merge.upsert_last_row(wide, S.WIDE_FIELDS, S.WIDE_KEY, order).collect())


def test_spec_stream_with_ttl_single_batch(spark):
    import time

    from streamfold.plans import catalog
    d = tempfile.mkdtemp(prefix="sf-spec-ttl-")
    _write_envelopes(spark, tb.topics_union(spark, SF), f"{d}/in", 2)
    stream = jobs.envelope_files_stream(spark, f"{d}/in", max_files_per_trigger=10)
    spec = catalog.stand_in_spec()
    spec["nodes"] = [n for n in spec["nodes"] if n["id"] not in ("col", "wide", "orphan")]
    qs = jobs.start_spec(spark, spec, lambda t: stream.filter(F.col("topic") == t), f"{d}/out",
                         name="spec_ttl", trigger="1 second", checkpoint_root=f"{d}/ck", ttl_seconds=3600)
    got = []
    try:
        deadline = time.time() + 150
        while time.time() < deadline:
            time.sleep(3)
            if not os.path.exists(f"{d}/out/doc"):
                continue
            cur = newest_rows(spark.read.parquet(f"{d}/out/doc"), ["symbol"])
            if cur.count() == 15:
                got = sorted(tuple(r) for r in cur.collect())
                break
    finally:
        for q in qs.values():
            q.stop()
    # one micro-batch, nothing idle for an hour: equals the batch merge
    exp = sorted(tuple(r) for r in catalog._spec_sinks(spark, SF, only=["doc"])["doc"].collect())
    assert got == exp


def test_cluster_defaults_skip_local(spark):
    from streamfold.session import CLUSTER_DEFAULTS, apply_cluster_defaults, cluster_defaults_for
    assert apply_cluster_defaults(spark) == {}
    assert cluster_defaults_for("yarn", lambda k: False) == CLUSTER_DEFAULTS
    user_set = {"spark.sql.shuffle.partitions"}
    got = cluster_defaults_for("k8s://https://h:443", user_set.__contains__)
    assert "spark.sql.shuffle.partitions" not in got and got
    assert cluster_defaults_for("local[8]", lambda k: False) == {}
