"""Run and log analytics.

Inputs are DataFrames:

* ``parents``: id, name, ... (pipelines)
* ``runs``: id, pipeline_id, status, job_id, started_at
* ``logs``: id, run_id, node_id, node_label, level, message, timestamp
* ``nodes``: pipeline_id, node_id, ... (the nodes of each pipeline)
* ``jobs``: job_id, state (what the job manager reports)

Per-group "last row" fields use ``max_by(struct, id)`` and per-group
counts use ``count``/``count_if``: all partial aggregations, so a run or
pipeline holding a large share of the rows is reduced map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamfold.functions.scalar import contains_ci

# Log level and message marker that decide a node's status;
# the node statuses; the job state counted as running; the placeholder job
# id of a run not yet confirmed; the state reported for an unknown job.
ERROR_LEVEL = "ERROR"
SUCCESS_MARK = "✓"
PENDING, FAILED, SUCCESS, RUNNING_STATUS = "pending", "failed", "success", "running"
RUNNING = "RUNNING"
PLACEHOLDER_JOB_ID = "submitted"
UNREACHABLE = "UNREACHABLE"


def filter_logs(logs: DataFrame, run_id=None, node_id=None) -> DataFrame:
    """P6 + O3: logs of a run, optionally of one node, by id ascending."""
    out = logs
    if run_id is not None:
        out = out.filter(F.col("run_id") == run_id)
    if node_id is not None:
        out = out.filter(F.col("node_id") == node_id)
    return out.orderBy("id")


def search_by_name(parents: DataFrame, query: str | None, col: str = "name") -> DataFrame:
    """Case-insensitive substring search; a blank query lists all."""
    return parents.filter(contains_ci(col, query))


def node_log_summary(logs: DataFrame) -> DataFrame:
    """A8 + A9 + R1 per (run_id, node_id): counts, last row, status flags."""
    is_err = F.col("level") == ERROR_LEVEL
    ok_mark = F.coalesce(F.col("message"), F.lit("")).startswith(SUCCESS_MARK)
    return (logs.filter(F.col("node_id").isNotNull())
            .groupBy("run_id", "node_id")
            .agg(F.count("*").alias("log_count"),
                 F.count_if(is_err).alias("error_count"),
                 F.bool_or(ok_mark).alias("_any_ok"),
                 F.max_by(F.struct("level", "message", "timestamp"), "id").alias("_last")))


def node_status(log_count, error_count, any_ok):
    """No logs -> pending; any ERROR -> failed; any message starting
    with the success marker -> success; else running."""
    return (F.when(F.coalesce(log_count, F.lit(0)) == 0, PENDING)
            .when(error_count > 0, FAILED)
            .when(any_ok, SUCCESS)
            .otherwise(RUNNING_STATUS))


def run_summary(runs: DataFrame, nodes: DataFrame, logs: DataFrame) -> DataFrame:
    """R2: one row per (run, node of the run's pipeline), nodes without logs
    kept.  ``runs``: run_id, pipeline_id; ``nodes``: pipeline_id, node_id,
    node_label, node_type.

    The run x node rows come from an equi-join on pipeline_id (a run gets
    its own pipeline's nodes; Spark broadcasts a small node list by itself),
    then a left join on the per-node log aggregates.
    """
    per_node = node_log_summary(logs)
    grid = runs.join(nodes, "pipeline_id")
    j = grid.join(per_node, ["run_id", "node_id"], "left")
    return j.select(
        "run_id", "node_id", "node_label", "node_type",
        node_status(F.col("log_count"), F.col("error_count"), F.col("_any_ok")).alias("status"),
        F.col("_last.level").alias("last_level"),
        F.col("_last.message").alias("last_message"),
        F.col("_last.timestamp").alias("timestamp"),
        F.coalesce("log_count", F.lit(0)).alias("log_count"),
        F.coalesce("error_count", F.lit(0)).alias("error_count"),
    )


def latest_run(runs: DataFrame, status: str | None = None) -> DataFrame:
    """Newest run (max id) per pipeline, optionally among runs of one
    status (O4: newest running run)."""
    r = runs if status is None else runs.filter(F.col("status") == status)
    cols = [c for c in r.columns if c not in ("pipeline_id",)]
    return (r.groupBy("pipeline_id")
            .agg(F.max_by(F.struct(*cols), "id").alias("_r"))
            .select("pipeline_id", *[F.col("_r")[c].alias(c) for c in cols]))


def latest_run_per_parent(parents: DataFrame, runs: DataFrame, node_counts: DataFrame) -> DataFrame:
    """J2 + O2: every pipeline with its node count and newest run (NULL when
    it has none), listed by ``updated_at`` descending (id descending when
    the pipelines carry no ``updated_at``).  ``node_counts``: pipeline_id,
    node_count."""
    lr = latest_run(runs).select("pipeline_id", F.col("status").alias("last_run_status"),
                                 F.col("started_at").alias("last_run_at"), F.col("id").alias("last_run_id"))
    p = parents.join(node_counts, parents.id == node_counts.pipeline_id, "left").drop("pipeline_id")
    out = p.join(lr, p.id == lr.pipeline_id, "left").drop("pipeline_id")
    out = out.withColumn("node_count", F.coalesce("node_count", F.lit(0)).cast("long"))
    recency = "updated_at" if "updated_at" in parents.columns else "id"
    return out.orderBy(F.col(recency).desc(), F.col("id").desc())


def top_runs(runs: DataFrame, k: int = 20, salt_buckets: int = 16) -> DataFrame:
    """O1: the newest ``k`` runs (id descending) of every pipeline.

    Two rounds so a pipeline with a huge share of runs never sits in one
    task: first top-k within (pipeline, salt) where the salt is a hash of
    the run id, then top-k over the at most ``k * salt_buckets`` survivors.
    """
    salt = F.pmod(F.xxhash64("id"), F.lit(salt_buckets))
    w1 = Window.partitionBy("pipeline_id", "_salt").orderBy(F.col("id").desc())
    w2 = Window.partitionBy("pipeline_id").orderBy(F.col("id").desc())
    first = (runs.withColumn("_salt", salt).withColumn("_r1", F.row_number().over(w1))
             .filter(F.col("_r1") <= k).drop("_salt", "_r1"))
    return first.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= k)


# Prefix of join keys that stand for "cannot match" (no real id starts
# with a NUL character).
NO_MATCH_PREFIX = "\u0000"


def unmatched_key_spread(key, matchable, unique):
    """Join key for an outer join: ``key`` where the row may match, else a
    unique value no other row has, so unmatched rows spread evenly."""
    return F.when(matchable, key).otherwise(F.concat(F.lit(NO_MATCH_PREFIX), unique.cast("string")))


def job_health(parents: DataFrame, runs: DataFrame, jobs: DataFrame) -> DataFrame:
    """Is the job behind each pipeline's newest run running?

    No run -> healthy NULL, state NULL.  No (or an empty) job id or the placeholder
    ``submitted`` -> healthy NULL, state = run status.  Job unknown to the
    job manager -> healthy false, state UNREACHABLE.  Else healthy =
    state = RUNNING.
    """
    lr = latest_run(runs).select("pipeline_id", F.col("status").alias("_run_status"), "job_id")
    p = parents.select("id").join(lr, F.col("id") == F.col("pipeline_id"), "left")
    no_job = F.col("job_id").isNull() | F.col("job_id").isin("", PLACEHOLDER_JOB_ID)
    # A pipeline without a job id can never match a job; give it a unique
    # key that matches nothing, so such rows (possibly most of them) spread
    # over the shuffle instead of all hashing NULL to one partition.
    p = p.withColumn("_jkey", unmatched_key_spread(F.col("job_id"), ~no_job, F.col("id")))
    j = p.join(jobs.withColumnRenamed("job_id", "_jid"), F.col("_jkey") == F.col("_jid"), "left")
    no_run = F.col("pipeline_id").isNull()
    healthy = (F.when(no_run | no_job, F.lit(None).cast("boolean"))
               .when(F.col("_jid").isNull(), F.lit(False))
               .otherwise(F.col("state") == RUNNING))
    state = (F.when(no_run, F.lit(None).cast("string"))
             .when(no_job, F.col("_run_status"))
             .when(F.col("_jid").isNull(), F.lit(UNREACHABLE))
             .otherwise(F.col("state")))
    job_id = F.when(no_run | no_job, F.lit(None).cast("string")).otherwise(F.col("job_id"))
    return j.select(F.col("id").alias("pipeline_id"), healthy.alias("healthy"), state.alias("state"),
                    job_id.alias("job_id"))


def jobs_by_state(jobs: DataFrame) -> DataFrame:
    """A10: number of jobs and of running jobs."""
    return jobs.agg(F.count("*").alias("n_jobs"),
                    F.count_if(F.col("state") == RUNNING).alias("n_running"))
