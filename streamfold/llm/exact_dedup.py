"""Exact deduplication by content hash, in DataFrame operations only.

Texts are grouped by a 128-bit hash *and* by the text itself, so equal hashes
of different texts never merge (the grouping compares the bytes).  The
grouping pre-aggregates before its shuffle: a text that a third of all rows
share arrives once per map task.

Defined results: a null text counts as empty; a null id is kept as a row and
never wins over a non-null id; rows repeated with the same id are marked
alike (``survivors`` keeps one of them); an empty table gives an empty
result; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamfold.llm.common import scratch, text_or_empty


def content_hash(text):
    """128-bit hash of the UTF-8 bytes."""
    return F.unhex(F.md5(text))


def mark(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_fn=content_hash) -> DataFrame:
    """One row per input row: id, ``keep_id`` (largest id of the equal
    texts), ``group_size``, ``kept`` and ``text_sha256``."""
    d = df.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    d = d.withColumn("h", hash_fn(F.col("text")))
    groups = (d.groupBy("h", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    # per hash: how many texts it stands for (more than one: a collision)
    slots = scratch(groups.groupBy("h").agg(F.count(F.lit(1)).alias("n_texts"), F.max("keep_id").alias("keep_id"),
                                            F.max("group_size").alias("group_size")), "exact-groups")
    narrow = d.select("doc_id", "h", F.sha2("text", 256).alias("text_sha256"))
    alone = slots.filter(F.col("n_texts") == 1).drop("n_texts")
    out = narrow.join(alone, "h").select("doc_id", "keep_id", "group_size", "text_sha256")
    collided = slots.filter(F.col("n_texts") > 1).select("h")
    if not collided.isEmpty():
        wide = d.join(collided, "h", "left_semi")
        by_text = groups.join(collided, "h", "left_semi")
        out = out.unionByName(wide.withColumn("text_sha256", F.sha2("text", 256)).join(by_text, ["h", "text"])
                              .select("doc_id", "keep_id", "group_size", "text_sha256"))
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def survivors(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_fn=content_hash) -> DataFrame:
    """The rows that stay, one per distinct text, with all their columns."""
    t = text_or_empty(text_col)
    rest = [c for c in df.columns if c != text_col]
    # the id leads the struct, so the largest id wins; the other fields only
    # choose among rows repeated with that id
    row = F.struct(F.col(id_col).alias("id"), F.col(text_col).isNull().alias("was_null"),
                   *[F.col(c).alias(f"c{i}") for i, c in enumerate(rest)])
    g = (df.select(hash_fn(t).alias("h"), t.alias("t"), row.alias("r"))
         .groupBy("h", "t").agg(F.max("r").alias("r")))
    at = {c: F.col(f"r.c{i}").alias(c) for i, c in enumerate(rest)}
    at[text_col] = F.when(~F.col("r.was_null"), F.col("t")).alias(text_col)
    return g.select(*[at[c] for c in df.columns])
