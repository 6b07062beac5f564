"""Run a declarative spec (nodes + edges JSON) as Spark jobs.

    python -m streamfold stream --spec spec.json --bootstrap host:9092 --out /shared/out
    python -m streamfold batch  --spec spec.json --topics /shared/topics --out /shared/out
    python -m streamfold enrich --bootstrap host:9092 --trades raw_trades --quotes raw_quotes --out enriched

``stream`` reads the spec's topics from Kafka and runs its sinks in one
streaming query (checkpoints under ``spark.checkpoint.dir``); the spec file is
read again for every micro-batch, so routes change without a restart.  A node's
``INSERT INTO <sink> SELECT ...`` runs as a query of its own.  ``enrich`` runs
the enrichment job: trade and quote topics in, enriched messages out.  ``batch``
reads parquet envelope dumps (``topic, key, value, partition, offset,
timestamp, timestampType``) from ``--topics`` and writes each sink's
result under ``--out``.  Lay the dumps out partitioned by topic
(``topics/topic=<name>/``): each source filters on its topic, and Spark then
reads only that topic's folder.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import functions as F

from streamfold.plans import spec as X
from streamfold.session import get_session


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="streamfold")
    ap.add_argument("mode", choices=["stream", "batch", "enrich"])
    ap.add_argument("--spec")
    ap.add_argument("--out", required=True, help="output folder; the topic of enriched messages for enrich")
    ap.add_argument("--trades", default="raw_trades")
    ap.add_argument("--quotes", default="raw_quotes")
    ap.add_argument("--bootstrap")
    ap.add_argument("--topics")
    ap.add_argument("--trigger", default="10 seconds")
    ap.add_argument("--ttl", type=int, default=3600,
                    help="idle TTL (s) of document-sink state, as the reference's generated job sets; 0 = none")
    ap.add_argument("--max-offsets-per-trigger", type=int, default=1_000_000,
                    help="messages of one micro-batch at most, of each topic; 0 = no bound")
    ap.add_argument("--min-offsets-per-trigger", type=int, default=None)
    ap.add_argument("--max-trigger-delay", default=None)
    ap.add_argument("--keep-going", action="store_true",
                    help="start the sinks that can be built; those that cannot still make the exit code non-zero")
    a = ap.parse_args(argv)
    if a.mode != "enrich" and not a.spec:
        ap.error("--spec is required")
    spark = get_session(app="streamfold-spec")

    def read_spec():
        with open(a.spec) as f:
            return json.load(f)

    def reader(topic, **kw):
        from streamfold.sources.topics import read_topic
        return read_topic(spark, topic, a.bootstrap, stream=True,
                          max_offsets_per_trigger=a.max_offsets_per_trigger or None,
                          min_offsets_per_trigger=a.min_offsets_per_trigger, max_trigger_delay=a.max_trigger_delay, **kw)

    if a.mode == "enrich":
        from streamfold.streaming.jobs import start_enrichment
        start_enrichment(reader(a.trades), reader(a.quotes), "enrichment", bootstrap=a.bootstrap, topic=a.out,
                         trigger=a.trigger).awaitTermination()
        return
    if a.mode == "stream":
        from streamfold.streaming.jobs import start_spec
        queries = start_spec(spark, read_spec, reader, a.out, trigger=a.trigger, ttl_seconds=a.ttl or None,
                             strict=not a.keep_going)
        for q in queries.values():
            q.awaitTermination()
        if queries.errors:
            raise SystemExit(f"sinks failed: {queries.errors}")
        return
    from streamfold.sinks.stores import table_schema
    spec = read_spec()

    envelopes = spark.read.parquet(a.topics)
    reader = lambda t, **kw: envelopes.filter(F.col("topic") == t)
    sinks, errors = X.build_with_errors(spec, reader, ttl_seconds=a.ttl or None,
                                         table_schema=lambda sink: table_schema(spark, os.path.join(a.out, sink["id"])))
    try:
        for sid, df in X.run_node_sql(spark, spec, reader).items():
            if sid in sinks:
                raise ValueError(f"{sid} is fed by its sources and by INSERT INTO")
            sinks[sid] = df
    except Exception as ex:  # noqa: BLE001
        errors["sql"] = f"{type(ex).__name__}: {ex}"
    for sid, df in sinks.items():
        try:
            df.write.mode("overwrite").parquet(os.path.join(a.out, sid))
        except Exception as ex:  # noqa: BLE001  (a failing sink does not stop the others)
            errors[sid] = f"{type(ex).__name__}: {ex}"
    if errors:
        raise SystemExit(f"sinks failed: {sorted(errors)}")


if __name__ == "__main__":
    main()
