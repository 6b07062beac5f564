"""Embedding near-duplicates: sign hashing, exact cosine, components.

Vectors with equal components and label are one class first.  Each class is
hashed by the signs of random hyperplanes in several tables; classes of one
label that share a table's code are compared by exact cosine in double
precision.  Tables deal out hashes of codes only; a vector goes out once for
each table in which its code has company.  Buckets are cut into blocks of
bounded size and compared block against block, so a hot bucket becomes many
tasks; a pair that meets in several tables counts in the first only.  Tasks
return link counts and stars, never pair lists.

Bits and tables follow the count of the largest (label, dimension): ``SPARE``
bits more than it takes to number its classes, so that a vector meets few unlike
ones by chance at any size (random ones of 64 dimensions: 0.42 of 4,000, 0.89 of
64,000), and as many tables as keep
the chance to miss a pair at the limit under ``MISS``.  Two vectors at cosine
0.98 agree in one sign with probability 1 - acos(0.98)/pi = 0.936, so in 20
signs with 0.267 and in at least one of 27 tables with 0.9997; closer pairs are
found more surely, copies always.  None below the limit is linked.  Signs are
taken of integer products, which no order of summation changes, so each task
finds the same codes again.

Defined results: a null label, a null, empty or zero vector, or one with a null
or non-finite component links with nothing; vectors of different length do not
link; repeated ids are separate rows that link as copies of each other; a null
id keeps its row; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamfold.llm.common import scratch, ship, shuffle_partitions, sorted_groups
from streamfold.llm.components import components, local_stars

MIN_COSINE = 0.98
SPARE = 6
MISS = 3e-4
LEAST_BITS, MOST_BITS = 14, 48
SEED = 20240
BLOCK = 512


def bits_for(n: int) -> int:
    """Bits of a code for n classes of one label."""
    return min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(n, 2))) + SPARE))


def tables_for(bits: int, min_cosine: float) -> int:
    same = (1 - math.acos(min(1.0, max(-1.0, min_cosine))) / math.pi) ** bits
    return 1 if same >= 1 else math.ceil(math.log(MISS) / math.log1p(-same))


@lru_cache(maxsize=16)
def hyperplanes(dim: int, tables: int, bits: int, seed: int) -> np.ndarray:
    return np.rint(np.random.default_rng([seed, dim]).standard_normal((dim, tables * bits)) * 4096)


def codes_of(x: np.ndarray, tables: int, bits: int, seed: int) -> np.ndarray:
    """Per vector and table, the signs as one integer."""
    # components are below 2 in size: sums of up to 2^18 whole products are exact in double precision
    signs = (np.rint(x * (1 << 18)) @ hyperplanes(x.shape[1], tables, bits, seed) >= 0).reshape(len(x), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def _matrix(col) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def compare(t: pa.Table, table_no: int, min_cosine: float, tables: int, bits: int, seed: int):
    """One tile of a bucket: rows of side 0 (block i) against those of side 1
    (block j), or block i among itself where i = j.  Returns (class index, link weight) and
    star edges (index, index)."""
    x, size = _matrix(t["v"]).astype(np.float64), t["n"].to_numpy()
    codes, side = codes_of(x, tables, bits, seed), t["side"].to_numpy()
    norm = np.linalg.norm(x, axis=1)
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    alone = t["i"][0].as_py() == t["j"][0].as_py()
    if alone:
        b = a
    cos = (x[a] @ x[b].T) / (norm[a][:, None] * norm[b][None, :])
    i, j = np.nonzero(cos >= min_cosine)
    if alone:
        i, j = i[i < j], j[i < j]
    i, j = a[i], b[j]
    same = codes[i] == codes[j]
    first = same[:, table_no] & (same.argmax(axis=1) == table_no)
    weight = np.zeros(len(x), dtype=np.int64)
    np.add.at(weight, i[first], size[j[first]])
    np.add.at(weight, j[first], size[i[first]])
    star = local_stars(len(x), i, j) if len(i) else np.arange(len(x))
    moved = np.flatnonzero(star != np.arange(len(x)))
    return np.flatnonzero(weight), weight[weight > 0], moved, star[moved]


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    min_cosine: float = MIN_COSINE, tables: int | None = None, bits: int | None = None,
                    seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id`` and ``kept``."""
    spark = df.sparkSession
    ship(spark)
    # vectors of floats travel as floats; cosines are taken in double precision
    item = "float" if dict(df.dtypes)[vector_col] == "array<float>" else "double"
    d = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"),
                  F.col(label_col).alias("label"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & ~bad & F.exists("v", lambda c: c != 0), F.lit(False))
    # a power of two brings very large and very small vectors into range without changing a cosine
    top = F.array_max(F.transform("v", F.abs))
    scale = F.pow(F.lit(2.0), -F.greatest(F.lit(-1000), F.least(F.lit(1000), F.floor(F.log2(top)))))
    d = d.withColumn("usable", usable).withColumn(
        "v", F.when(usable, F.transform("v", lambda c: c * scale + F.lit(0.0))).cast(f"array<{item}>"))
    d = d.withColumn("class", F.when(F.col("usable"), F.unhex(F.md5(F.to_json(F.struct("label", "v"))))))
    classes = scratch(d.filter("usable").groupBy("class", "label", "v")
                      .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")), "vector-classes")
    kind = dict(classes.dtypes)
    if bits is None:
        most = classes.groupBy("label", F.size("v")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()
        bits = bits_for(most["n"] or 0)
    tables = tables or tables_for(bits, min_cosine)

    def hashed(batches):
        for batch in batches:
            sizes = batch.column("v").value_lengths().to_numpy()
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim))
                codes = codes_of(_matrix(part.column("v")).astype(np.float64), tables, bits, seed)
                yield pa.RecordBatch.from_arrays(
                    [part.column("c"), part.column("label"), pa.array(np.full(len(codes), dim), pa.int32()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1) * tables, pa.int32()),
                                              pa.array(codes.ravel()))], names=["c", "label", "dim", "codes"])

    # a class goes by the hash of its name; where two share it, a tile gets a row that has another code
    short = F.xxhash64("class").alias("c")
    flat = (classes.select(short, "label", "v")
            .mapInArrow(hashed, f"c long, label {kind['label']}, dim int, codes array<long>")
            .select("c", "label", "dim", F.posexplode("codes").alias("table_no", "code"))
            .select("c", F.col("table_no").cast("short").alias("table_no"),
                    F.xxhash64("label", "dim", "table_no", "code").alias("bucket")))
    # buckets of one class hold no pair; the vectors of the others are dealt out
    full = scratch(flat.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
                   .withColumn("n_blocks", F.ceil(F.col("rows") / block).cast("int")).drop("rows"), "buckets")
    wide = (flat.join(full, "bucket").join(classes.select(short, "class", "label", "v", "n"), "c")
            .withColumn("dim", F.size("v"))
            .withColumn("block", F.pmod(F.xxhash64("class"), F.col("n_blocks")).cast("int")))
    # block i meets block j in tile (i, j), i <= j: as side 0 from i, as side 1 from j
    other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    tile = ["bucket", "table_no", "label", "dim", "i", "j"]
    tiles = (wide.withColumn("other", other)
             .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
             .withColumn("side", F.when(F.col("block") == F.col("i"), 0).otherwise(1))
             .withColumn("tile", F.xxhash64(*tile))
             .select("tile", *tile, "side", "class", "n", "v")
             .repartition(shuffle_partitions(spark), "tile").sortWithinPartitions("tile", *tile))

    def compared(batches):
        for t in sorted_groups(batches, ["tile", *tile]):
            if t.num_rows < 2:
                continue
            who, weight, moved, star = compare(t, t["table_no"][0].as_py(), min_cosine, tables, bits, seed)
            name = t["class"]
            pick = lambda k: name.take(pa.array(k)).combine_chunks()
            n, m = len(who), len(moved)
            if n + m:
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([pick(who), pick(moved)]),
                     pa.concat_arrays([pa.nulls(n, pa.binary()), pick(star)]),
                     pa.array(np.concatenate([weight, np.zeros(m, np.int64)]))], names=["a", "b", "w"])

    found = scratch(tiles.mapInArrow(compared, "a binary, b binary, w long"), "links")
    weights = found.filter("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("w").alias("w"))
    linked = components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "class")
    reps = classes.select("class", "rep", "n")
    least = reps.join(linked, "class").groupBy("component").agg(F.min("rep").alias("component_id"))
    named = linked.join(least, "component").select("class", "component_id")
    per_class = (reps.join(weights, "class", "left").join(named, "class", "left")
                 .select("class", (F.col("n") - 1 + F.coalesce("w", F.lit(0))).alias("n_links"),
                         F.coalesce("component_id", "rep").alias("component_id")))
    out = d.select("vec_id", "class").join(per_class, "class", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
