"""J1 on a stream, for hot keys as well.

Every micro-batch is joined by the batch plan (``enrich.asof_latest``), whose
rows are dealt out by key and time chunk, so a key that holds a third of a
batch is shared by many tasks. What earlier batches leave behind is one quote
a key: the *book*, tables beside the checkpoint.  A batch that brings quotes
adds the newest of each of its keys, under its own number; every
``FOLD_EVERY`` such additions the book is folded into one table.  A batch reads
the newest fold before its own number and the additions since, so a batch that
runs again finds the same quotes, and of these only the keys of its own left
rows: what it shuffles follows the batch, not the book.

Across batches the quote that arrived last is the current one, inside a batch
the one last by (time, sequence).  The book has one row per key that ever had
a quote.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamfold.operators.enrich import asof_latest
from streamfold.session import checkpoint_subdir
from streamfold.sinks import stores

# Additions that make a fold, and folds that are kept for replays.
FOLD_EVERY = 16
KEPT_FOLDS = 2
# The time of the book's quotes: before every message of the batch.
EARLIEST = "0001-01-01 00:00:00"


class AsofBatches:
    """The work of one micro-batch, for ``foreachBatch`` over rows
    (``left``, ``right``), one of them NULL."""

    def __init__(self, spark: SparkSession, folder: str, key: list[str], ts_col: str, seq_col: str,
                 right_cols: list[str], prefix: str, write, **options):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.key, self.ts, self.seq = list(key), ts_col, seq_col
        self.right_cols, self.prefix, self.write, self.options = right_cols, prefix, write, options

    def _done(self, kind: str) -> list[int]:
        """Numbers of the tables ``kind=<n>`` that are complete."""
        fs, p = stores._fs(self.spark, f"{self.folder}/{kind}=*/_SUCCESS")
        return sorted(int(st.getPath().getParent().getName().split("=")[1]) for st in fs.globStatus(p) or [])

    def additions(self) -> list[int]:
        return self._done("batch")

    def folds(self) -> list[int]:
        return self._done("fold")

    def _tables_before(self, batch_id: int) -> list[tuple[str, int]]:
        fold = max((n for n in self.folds() if n < batch_id), default=-1)
        return [("fold", fold)] * (fold >= 0) + [("batch", n) for n in self.additions() if fold < n < batch_id]

    def book_before(self, batch_id: int, schema, keys: DataFrame | None = None) -> DataFrame:
        """The quotes current when a batch begins, of ``keys`` if given."""
        held = None
        for kind, n in self._tables_before(batch_id):
            t = self.spark.read.schema(schema).parquet(f"{self.folder}/{kind}={n}").withColumn("_n", F.lit(n))
            held = t if held is None else held.unionByName(t)
        if held is None:
            return self.spark.createDataFrame([], schema)
        if keys is not None:
            held = held.join(keys, self.key, "left_semi")
        return self._newest(held, schema)

    def _newest(self, rows: DataFrame, schema) -> DataFrame:
        """One row a key: of the last number, then by (time, sequence)."""
        row = F.max_by(F.struct(*[c for c in schema.names if c not in self.key]), F.struct("_n", "_qt", "_qs"))
        return rows.groupBy(*self.key).agg(row.alias("_row")).select(*self.key, "_row.*").select(*schema.names)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            left = batch.filter("left is not null").select("left.*")
            right = batch.filter("right is not null").select("right.*")
            quotes = right.select(*self.key, F.col(self.ts).cast("timestamp").alias("_qt"),
                                  F.col(self.seq).cast("long").alias("_qs"), *self.right_cols)
            held = self.book_before(batch_id, quotes.schema, left.select(*self.key).distinct())
            known = held.withColumn("_qt", F.lit(EARLIEST).cast("timestamp")).unionByName(quotes)
            self.write(asof_latest(left, known, self.key, self.ts, self.seq, self.right_cols, prefix=self.prefix,
                                   right_ts_col="_qt", right_seq_col="_qs", **self.options), batch_id)
            self._add(quotes, batch_id)
        finally:
            batch.unpersist()

    def _add(self, quotes: DataFrame, batch_id: int) -> None:
        new = quotes.filter(F.col("_qt").isNotNull())
        for k in self.key:
            new = new.filter(F.col(k).isNotNull())
        if new.isEmpty():
            return              # the book stays as it is
        (self._newest(new.withColumn("_n", F.lit(batch_id)), quotes.schema)
         .write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}"))
        if len(self._tables_before(batch_id + 1)) > FOLD_EVERY:
            (self.book_before(batch_id + 1, quotes.schema).write.mode("overwrite")
             .parquet(f"{self.folder}/fold={batch_id}"))
            folds = self.folds()
            if len(folds) >= KEPT_FOLDS:        # a replay reads the fold before its batch and what came after
                oldest = folds[-KEPT_FOLDS]
                for kind, n in [("fold", n) for n in folds if n < oldest] + [("batch", n) for n in self.additions() if n <= oldest]:
                    fs, p = stores._fs(self.spark, f"{self.folder}/{kind}={n}")
                    fs.delete(p, True)


def start_asof(left: DataFrame, right: DataFrame, key: list[str], ts_col: str, seq_col: str, right_cols: list[str],
               name: str, write, prefix: str = "quote_", checkpoint: str | None = None, trigger: str = "1 second",
               **options):
    """One query over two streams: every left row with the latest right row of
    its key, to ``write(rows, batch_id)``.  Both have ``key``, ``ts_col`` and
    ``seq_col``; ``options`` go to ``asof_latest``."""
    spark = left.sparkSession
    ck = checkpoint or checkpoint_subdir(spark, os.path.join("streams", name))

    def kind(df):
        return df.select(F.struct("*").alias("x")).schema["x"].dataType

    rows = (left.select(F.struct("*").alias("left"), F.lit(None).cast(kind(right)).alias("right"))
            .unionByName(right.select(F.lit(None).cast(kind(left)).alias("left"), F.struct("*").alias("right"))))
    work = AsofBatches(spark, f"{ck}/book", key, ts_col, seq_col, right_cols, prefix, write, **options)
    return (rows.writeStream.foreachBatch(work).option("checkpointLocation", ck)
            .trigger(processingTime=trigger).queryName(name).start())
