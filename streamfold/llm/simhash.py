"""SimHash near-duplicates by tiled exact comparison.

Every document gets a 64-bit fingerprint.  Distinct fingerprints are dealt
into cells by the population counts of their two halves, and cells into
blocks of bounded size.  Two blocks form a tile pair only if their population
counts differ by at most the radius; a skipped pair cannot hold a link,
because the counts of two words differ by no more than their Hamming distance.
Inside a tile pair the same test is made again over the counts of the four
16-bit quarters, on runs of sorted fingerprints, and what is left is compared
with numpy exclusive-or and bit counts.  The comparison is exact: no pair
within the radius is lost.

A task returns links as stars (each fingerprint with the smallest one its tile
pair connects it to), so a large group of near copies costs no pair list.
Equal fingerprints are one node, however many documents carry them.

Defined results: a null text counts as empty; a text without words has
fingerprint 0 and links like any other; a null id keeps its row and counts as
no id when the smallest is taken; repeated rows give repeated results; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamfold.llm.common import scratch, ship, shuffle_partitions, text_or_empty
from streamfold.llm.components import components, local_stars

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
BLOCK = 8192        # fingerprints of a block, about
RUN = 256           # sorted fingerprints compared at once


def shingles(text: str, n: int = SHINGLE_WORDS) -> list[bytes]:
    """Shingles of ``n`` words, repeats included; fewer words: all of them as
    one; no words: none.  Only A-Z is lower-cased and only ASCII white space
    divides words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if len(words) < n:
        return [b" ".join(words)] if words else []
    return [b" ".join(s) for s in zip(*(words[i:] for i in range(n)))]


def fingerprint(text: str, n: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit fingerprint: a bit is set if over half the shingle
    hashes have it set."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    hashes = [digest(s, seed) for s in shingles(text, n)]
    ones = np.zeros(64, dtype=np.int64)
    for a in range(0, len(hashes), 100_000):
        h = np.array(hashes[a:a + 100_000], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def text_hash(text_col: str = "text"):
    return F.unhex(F.sha2(text_or_empty(text_col), 256))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS, hashed: bool = False) -> DataFrame:
    """Per row: ``doc_id`` and ``fp`` (the fingerprint as a signed long), with
    ``hashed`` between them ``h``, the hash of the text."""
    ship(df.sparkSession)
    more = [text_hash(text_col).alias("h")] if hashed else []
    d = df.select(F.col(id_col).alias("doc_id"), *more, text_or_empty(text_col).alias("text"))
    names = [c for c in d.columns if c != "text"]

    def run(batches):
        for batch in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in batch.column("text")),
                             dtype=np.uint64, count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(fp.view(np.int64))],
                                             names=[*names, "fp"])

    kinds = [f"{c} {d.schema[c].dataType.simpleString()}" for c in names]
    return d.mapInArrow(run, ", ".join([*kinds, "fp long"]))


def _quarters(fp: np.ndarray) -> np.ndarray:
    return np.stack([np.bitwise_count((fp >> np.uint64(s)) & np.uint64(0xFFFF)) for s in (0, 16, 32, 48)],
                    axis=1).astype(np.int16)


def _sorted_runs(fp: np.ndarray):
    """The fingerprints in the order of their quarter counts, and per run of
    ``RUN`` of them the smallest and largest counts."""
    q = _quarters(fp)
    order = np.lexsort((fp, q[:, 3], q[:, 1], q[:, 2], q[:, 0]))
    fp, q = fp[order], q[order]
    starts = np.arange(0, len(fp), RUN)
    return fp, starts, np.minimum.reduceat(q, starts, axis=0), np.maximum.reduceat(q, starts, axis=0)


def links_between(a: np.ndarray, b: np.ndarray | None, radius: int = RADIUS):
    """Links within the radius between two arrays of distinct uint64
    fingerprints (``b`` None: within ``a``), as stars: (member, smallest
    member reached), both uint64, members other than the smallest only."""
    fa, sa, lo_a, hi_a = _sorted_runs(a)
    fb, sb, lo_b, hi_b = (fa, sa, lo_a, hi_a) if b is None else _sorted_runs(b)
    nodes = fa if b is None else np.concatenate([fa, fb])
    shift = 0 if b is None else len(fa)
    found_i, found_j, held = [], [], 0
    star = np.arange(len(nodes))

    def fold():
        nonlocal star, held
        if found_i:
            star = local_stars(len(nodes), np.concatenate([*found_i, np.arange(len(nodes))]),
                               np.concatenate([*found_j, star]))
            found_i.clear()
            found_j.clear()
            held = 0

    for x, s in enumerate(sa):
        # how far the two boxes of counts are apart, summed over the quarters
        gap = np.maximum(0, np.maximum(lo_b - hi_a[x], lo_a[x] - hi_b)).sum(axis=1)
        near = np.flatnonzero(gap <= radius)
        if b is None:
            near = near[near >= x]
        for y in near:
            t = sb[y]
            ones = np.bitwise_count(fa[s:s + RUN, None] ^ fb[None, t:t + RUN])
            i, j = np.nonzero(ones <= radius)
            if b is None and x == y:
                i, j = i[i < j], j[i < j]
            if len(i):
                found_i.append(i + s)
                found_j.append(j + t + shift)
                held += len(i)
                if held > 2_000_000:
                    fold()
    fold()
    # the smallest *value* of each star names it
    least = np.full(len(nodes), np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, star, nodes)
    to = least[star]
    other = nodes != to
    return nodes[other], to[other]


def links(distinct: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints (column ``fp``) to star edges (a, b)."""
    spark = distinct.sparkSession
    ship(spark)
    hi, lo = F.bit_count(F.shiftrightunsigned("fp", 32)), F.bit_count(F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)))
    d = distinct.select("fp", (hi * 64 + lo).cast("int").alias("cell"))
    # at most 33 x 33 cells
    cells = d.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n_blocks"))
    dealt = (d.join(F.broadcast(cells), "cell")
             .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("n_blocks")).cast("int")))
    # a block holds about `block` fingerprints, whatever the data
    blocks = scratch(dealt.groupBy("cell", "block", "n_blocks").agg(F.collect_list("fp").alias("fps")), "fp-blocks")
    steps = [(h, l) for h in range(-radius, radius + 1) for l in range(-radius, radius + 1)
             if abs(h) + abs(l) <= radius and (h, l) >= (0, 0)]
    meta = blocks.select("cell", "n_blocks").distinct()
    near = (meta.select(F.col("cell").alias("cell_a"), F.col("n_blocks").alias("n_a"),
                        F.explode(F.array(*[F.struct(F.lit(h).alias("h"), F.lit(l).alias("l")) for h, l in steps]))
                        .alias("step"))
            .withColumn("hi", F.expr("cell_a div 64") + F.col("step.h"))
            .withColumn("lo", F.col("cell_a") % 64 + F.col("step.l"))
            .filter("hi between 0 and 32 and lo between 0 and 32")
            .withColumn("cell_b", (F.col("hi") * 64 + F.col("lo")).cast("int"))
            .join(meta.select(F.col("cell").alias("cell_b"), F.col("n_blocks").alias("n_b")), "cell_b"))
    pairs = (near.withColumn("block_a", F.explode(F.sequence(F.lit(0), F.col("n_a") - 1)))
             .withColumn("block_b", F.explode(F.sequence(F.lit(0), F.col("n_b") - 1)))
             .filter("cell_a != cell_b or block_a <= block_b")
             .select("cell_a", "block_a", "cell_b", "block_b"))
    side = lambda s: blocks.select(F.col("cell").alias(f"cell_{s}"), F.col("block").alias(f"block_{s}"),
                                   F.col("fps").alias(f"fps_{s}"))
    tiles = (pairs.join(side("a"), ["cell_a", "block_a"]).join(side("b"), ["cell_b", "block_b"])
             .repartition(shuffle_partitions(spark), "cell_a", "block_a", "cell_b", "block_b"))

    def run(batches):
        for batch in batches:
            same = (np.asarray(batch.column("cell_a")) == np.asarray(batch.column("cell_b"))) & \
                   (np.asarray(batch.column("block_a")) == np.asarray(batch.column("block_b")))
            for k in range(batch.num_rows):
                a = np.asarray(batch.column("fps_a")[k].values).view(np.uint64)
                b = None if same[k] else np.asarray(batch.column("fps_b")[k].values).view(np.uint64)
                x, y = links_between(a, b, radius)
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))],
                                                     names=["a", "b"])

    return tiles.mapInArrow(run, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """Per row: ``doc_id``, ``fp`` and ``component_id``, the smallest id
    reachable over links."""
    fps = scratch(fingerprints(df, id_col, text_col, shingle_words), "fingerprints")
    first = scratch(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fps")
    linked = components(links(first.select("fp"), radius))
    # only fingerprints with a link are in `linked`; its components get their smallest id
    member = first.join(linked.withColumnRenamed("node", "fp"), "fp")
    least = member.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = member.join(least, "component").select("fp", "component_id")
    # written, so that the last join is one of two plain inputs, whose hot fingerprints Spark can split
    by_fp = scratch(first.join(named, "fp", "left")
                    .select("fp", F.coalesce("component_id", "first_id").alias("component_id")), "fp-components")
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def survivors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row of each component, with all its columns: the one with the
    smallest id, a null id last, then the smallest fingerprint, text hash and
    other columns.  Rows are told apart by id and text, so neither a repeated
    nor a null id takes or keeps another's row."""
    # written, so that the hot fingerprints of the join below are in a plain input, which Spark can split
    keys = scratch(fingerprints(df, id_col, text_col, shingle_words, hashed=True)
                   .groupBy("doc_id", "h", "fp").agg(F.count(F.lit(1)).alias("n_rows")), "near-keys")
    linked = scratch(components(links(scratch(keys.select("fp").distinct(), "distinct-fps"), radius))
                     .withColumnRenamed("node", "fp"), "fp-components")
    # a component is named by a fingerprint, which no other component has
    best = (keys.join(linked, "fp", "left").groupBy(F.coalesce("component", "fp").alias("component"))
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "h", "n_rows")).alias("r")))
    kept = scratch(best.select(F.col("r.doc_id").alias("kept_id"), F.col("r.h").alias("kept_h"),
                               F.col("r.n_rows").alias("n_rows")), "near-kept")
    gone = (keys.join(kept, keys["doc_id"].eqNullSafe(kept["kept_id"]) & (keys["h"] == kept["kept_h"]), "left_anti")
            .select(F.col("doc_id").alias("gone_id"), F.col("h").alias("gone_h")))
    # bound to its table, so that no column of the input clashes
    same = lambda i, h: df[id_col].eqNullSafe(i) & (text_hash(text_col) == h)
    gone = scratch(gone, "near-gone")
    left = df.join(gone, same(gone["gone_id"], gone["gone_h"]), "left_anti")
    repeated = kept.filter(F.col("n_rows") > 1).select("kept_id", "kept_h")
    if repeated.isEmpty():
        return left
    match = same(repeated["kept_id"], repeated["kept_h"])
    row = F.min(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(df.columns)])).alias("r")
    one = df.join(repeated, match, "left_semi").groupBy(F.col(id_col).alias("i"), text_hash(text_col).alias("h")).agg(row)
    return left.join(repeated, match, "left_anti").unionByName(
        one.select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(df.columns)]))


def hex_digits(fp: str = "fp"):
    """A signed long as 16 lower-case hex digits of its unsigned value."""
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
