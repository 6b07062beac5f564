"""Topic -> table routing (S5, J3, U2) and per-table write counts.

One subscription reads several topics; a route table maps each topic to
the tables it feeds (one topic may feed many).  The route table comes from
a declarative spec; Spark chooses the join by its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def dedupe_first_seen(items) -> list:
    """Drop repeats, keep first-seen order (driver-side spec step)."""
    seen, out = set(), []
    for x in items:
        if x not in seen:
            seen.add(x)
            out.append(x)
    return out


def first_seen(rows: DataFrame, group, item: str, order) -> DataFrame:
    """U2 over rows: the distinct items of each group with their place in
    first-seen order (``order`` columns, ties by item).  One row per group,
    item and map task is shuffled."""
    group = [group] if isinstance(group, str) else list(group)
    firsts = rows.groupBy(*group, item).agg(F.min(F.struct(*order)).alias("_first"))
    return firsts.select(*group, item, F.row_number().over(
        Window.partitionBy(*group).orderBy("_first", item)).alias("place"))


def route_table(spark: SparkSession, routes: dict[str, list[str]]) -> DataFrame:
    """``{target_table: [topic, ...]}`` -> DataFrame(topic, target_table)."""
    rows = []
    for target, topics in routes.items():
        for t in dedupe_first_seen(topics):
            rows.append((t, target))
    return spark.createDataFrame(rows, "topic string, target_table string")


def fan_out(messages: DataFrame, routes: DataFrame, topic_col: str = "topic") -> DataFrame:
    """Every message once per table its topic feeds."""
    return messages.join(routes.withColumnRenamed("topic", topic_col), topic_col)


def project_target(rows: DataFrame, target_fields, passthrough: tuple[str, ...] = ()) -> DataFrame:
    """What one target table of a fan-out receives: the decoded rows by
    the target's own columns, absent ones NULL (P3)."""
    from streamfold.operators.align import align_null_fill

    return align_null_fill(rows, target_fields, passthrough=passthrough)


def write_counts(routed: DataFrame, target_col: str = "target_table", name: str = "written") -> DataFrame:
    """Total rows written plus one counter per target table
    (``written`` and ``written:<table>``), via ``rollup``."""
    g = routed.rollup(target_col).agg(F.count("*").alias("n"), F.grouping(target_col).alias("_total"))
    # a NULL target is a group of its own, not the total
    metric = F.when(F.col("_total") == 1, F.lit(name)).otherwise(
        F.concat(F.lit(name + ":"), F.coalesce(F.col(target_col), F.lit("NULL"))))
    return g.select(metric.alias("metric"), "n")


def refreshing_router(load_routes, writers: dict):
    """A ``foreachBatch`` function that re-reads the route table for
    every micro-batch, so route changes apply without a restart (subscribe
    with a topic pattern so new topics arrive too).

    ``load_routes()`` returns ``{target_table: [topic, ...]}`` (read from the
    route file or table each time); ``writers[target](rows, batch_id)``
    writes one target's rows; ``writers`` may be a function of the target
    that makes the writer of a new table.  A routed target without a writer
    fails the batch, so none of its rows is passed over.  The batch is
    persisted once for all targets.
    """
    def each(batch: DataFrame, batch_id: int):
        routes = load_routes()
        to = {t: writers(t) if callable(writers) else writers.get(t) for t in routes}
        if missing := sorted(t for t, w in to.items() if w is None):
            raise ValueError(f"no writer for routed targets {missing}")
        batch.persist()
        try:
            for target, topics in routes.items():
                to[target](batch.filter(F.col("topic").isin(dedupe_first_seen(topics))), batch_id)
        finally:
            batch.unpersist()
    return each
