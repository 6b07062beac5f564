"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamfold.session import checkpoint_subdir

DEFAULT_TOKENIZERS = "public_tokenizers"


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Place of a vocabulary file: in ``folder``, else where the installed
    vocabulary package says (each machine has its own copy)."""
    if folder:
        return os.path.join(folder, name)
    import importlib
    return importlib.import_module(DEFAULT_TOKENIZERS).path(name)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once a session, unless
    they find it by the ``PYTHONPATH`` they share or by ``--py-files``."""
    import shutil
    import tempfile

    sc = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or root.endswith(".zip") \
            or getattr(sc, "_streamfold_shipped", False):
        return
    # Spark serves the driver's file to the executors
    sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), "streamfold"), "zip", root, "streamfold"))
    sc._streamfold_shipped = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared ``spark.checkpoint.dir`` and
    read it back: what follows restarts from these files when an executor is
    lost.  The folder goes when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{checkpoint_subdir(spark, 'llm')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sorted_groups(batches, keys: list[str]):
    """The maximal runs of equal ``keys`` in a stream of Arrow batches, as
    Arrow tables; holds one run and one batch at a time.  For partitions that
    are sorted by ``keys``."""
    import numpy as np

    held: list[pa.Table] = []
    held_key = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        t = pa.Table.from_batches([batch])
        cols = [t.column(k).combine_chunks().to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(t.num_rows, dtype=bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), t.num_rows]
        for a, b in zip(starts[:-1], starts[1:]):
            key = tuple(c[a] for c in cols)
            if held and key != held_key:
                yield pa.concat_tables(held)
                held = []
            held_key = key
            held.append(t.slice(a, b - a))
    if held:
        yield pa.concat_tables(held)
