import datetime as dt
import random

from pyspark.sql import functions as F

from streamfold.operators import runs
from conftest import rows

D = dt.datetime(2024, 1, 1)
LOGS = "id long, run_id long, node_id string, node_label string, level string, message string, timestamp timestamp"


def test_node_status_rules(spark):
    logs = spark.createDataFrame([
        (1, 1, "a", "A", "INFO", "start", D), (2, 1, "a", "A", "ERROR", "✓ boom", D),
        (3, 1, "b", "B", "INFO", "✓ done", D), (4, 1, "b", "B", "INFO", "later", D),
        (5, 1, "c", "C", "INFO", "working", D), (6, 1, None, None, "INFO", "whole run", D)], LOGS)
    nodes = spark.createDataFrame([(0, "a", "A", "kafka"), (0, "b", "B", "kafka"), (0, "c", "C", "kafka"),
                                   (0, "d", "D", "sink")], "pipeline_id long, node_id string, node_label string, node_type string")
    rs = spark.createDataFrame([(1, 0)], "run_id long, pipeline_id long")
    out = {r["node_id"]: r for r in runs.run_summary(rs, nodes, logs).collect()}
    assert out["a"]["status"] == "failed" and out["a"]["error_count"] == 1 and out["a"]["last_message"] == "✓ boom"
    assert out["b"]["status"] == "success" and out["b"]["last_message"] == "later" and out["b"]["log_count"] == 2
    assert out["c"]["status"] == "running"
    assert out["d"]["status"] == "pending" and out["d"]["log_count"] == 0 and out["d"]["last_level"] is None


RUNS = "id long, pipeline_id long, status string, job_id string, started_at timestamp"


def test_job_health_cases(spark):
    parents = spark.createDataFrame([(1, "p1"), (2, "p2"), (3, "p3"), (4, "p4"), (5, "p5")], "id long, name string")
    rs = spark.createDataFrame([(10, 1, "running", "j1", D), (11, 2, "pending", "submitted", D),
                                (12, 3, "running", "gone", D), (13, 4, "success", "j4", D),
                                (9, 4, "running", "j1", D)], RUNS)
    jobs = spark.createDataFrame([("j1", "RUNNING"), ("j4", "FINISHED")], "job_id string, state string")
    out = {r["pipeline_id"]: (r["healthy"], r["state"], r["job_id"])
           for r in runs.job_health(parents, rs, jobs).collect()}
    assert out == {1: (True, "RUNNING", "j1"), 2: (None, "pending", None), 3: (False, "UNREACHABLE", "gone"),
                   4: (False, "FINISHED", "j4"), 5: (None, None, None)}


def test_top_runs_matches_brute_force(spark):
    rnd = random.Random(3)
    data = [(i, rnd.choice([1, 1, 1, 2, 3]), "running", None, D) for i in rnd.sample(range(10_000), 500)]
    df = spark.createDataFrame(data, RUNS)
    got = sorted((r["pipeline_id"], r["id"], r["rank"]) for r in runs.top_runs(df, 7, salt_buckets=5).collect())
    exp = []
    for p in {d[1] for d in data}:
        ids = sorted((d[0] for d in data if d[1] == p), reverse=True)[:7]
        exp += [(p, i, n + 1) for n, i in enumerate(ids)]
    assert got == sorted(exp)


def test_search_blank_lists_all(spark):
    df = spark.createDataFrame([("Alpha",), ("beta",)], "name string")
    assert runs.search_by_name(df, "  ").count() == 2
    assert rows(runs.search_by_name(df, "ALP")) == [{"name": "Alpha"}]


def test_filter_logs_sorted(spark):
    logs = spark.createDataFrame([(3, 1, "a", "A", "INFO", "x", D), (1, 1, "a", "A", "INFO", "y", D),
                                  (2, 2, "a", "A", "INFO", "z", D)], LOGS)
    assert [r["id"] for r in runs.filter_logs(logs, run_id=1, node_id="a").collect()] == [1, 3]


def test_job_health_spreads_unmatched_keys(spark):
    """Runs without a job id get distinct never-matching join keys, and the
    result is unchanged: healthy NULL, state = run status."""
    parents = spark.createDataFrame([(i, f"p{i}") for i in range(6)], "id long, name string")
    rs = spark.createDataFrame([(10 + i, i, "running", None if i % 2 else "submitted", D) for i in range(6)], RUNS)
    jobs = spark.createDataFrame([("job-1", "RUNNING")], "job_id string, state string")
    out = rows(runs.job_health(parents, rs, jobs))
    assert len(out) == 6
    assert all(r["healthy"] is None and r["state"] == "running" and r["job_id"] is None for r in out)
    keys = (parents.select("id").withColumn("job_id", F.lit(None).cast("string"))
            .select(runs.unmatched_key_spread(F.col("job_id"), F.col("job_id").isNotNull(), F.col("id")).alias("k")))
    assert keys.distinct().count() == 6


def test_empty_job_id_is_no_job(spark):
    p = spark.createDataFrame([("p",)], "id string")
    r = spark.createDataFrame([(1, "p", "DONE", "")], "id long, pipeline_id string, status string, job_id string")
    j = spark.createDataFrame([], "job_id string, state string")
    assert tuple(runs.job_health(p, r, j).first()) == ("p", None, "DONE", None)


def test_null_target_is_not_the_total(spark):
    from streamfold.operators import routing
    df = spark.createDataFrame([("a",), (None,), (None,)], "target_table string")
    got = {r["metric"]: r["n"] for r in routing.write_counts(df).collect()}
    assert got == {"written": 3, "written:a": 1, "written:NULL": 2}
