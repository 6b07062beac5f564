"""Merkle manifest of a table: one tree per group (source), one over the groups.

Every row is a leaf: the SHA-256 of its fields.  Within a group the leaves
ascend by id, and runs of ``FANOUT`` consecutive nodes are hashed until one
node, the group's subroot, remains; the subroots in group order make the root
in the same way.  A row's proof is the digests beside its way to the root.

*Slot pivot.*  A level is one grouping by parent whose conditional aggregates
spread the children into ``FANOUT`` slot columns.  The concatenated columns
hash to the parent; the columns before and after a slot are that child's
siblings.  Each level is written to the shared folder (a sixteenth of the one
below), so the ways back down start from written levels.

*Positions.*  Rows get their place within the group from a range partitioning
by (group, id): the place inside the partition plus what earlier partitions
hold of the group.  A group that holds a third of all rows is spread over many
partitions and never meets in one task.  After that every grouping has at most
``FANOUT`` rows a key.

Digests travel as 32 bytes and are hashed as lower-case hexadecimal text.

Defined results: null fields hash as ``-``; the null group is a group of its
own, the first; a null id comes before the others of its group; rows that
repeat an id are ordered by their leaf, so equal rows are interchangeable; a
group of one row has the leaf itself as subroot, and a table of one group its
subroot as root; an empty table gives an empty result; columns that are not
named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamfold.llm.common import scratch

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 5


def encoded(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(*parts: Column) -> Column:
    """SHA-256, as bytes, of strings laid end to end."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hex_text(b: Column) -> Column:
    return F.lower(F.hex(b))


def leaf_of(fields, changed: dict[str, Column] | None = None) -> Column:
    """The leaf digest of a row; ``changed`` replaces some of its fields."""
    changed = changed or {}
    return digest(*[encoded(changed.get(f, F.col(f))) for f in fields])


def placed(nodes: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``nodes`` with ``idx`` (place within the rows of equal ``by``, in the
    ascending order of ``order``, nulls first) and ``n`` (how many there are).
    ``by`` columns must not be null."""
    cols = nodes.columns
    # monotonically_increasing_id breaks ties, so that repeated rows spread
    tied = scratch(nodes.withColumn("_tie", F.monotonically_increasing_id()), "merkle-nodes")
    keys = list(dict.fromkeys([*by, *order, "_tie"]))
    dealt = scratch(tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
                    .withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    dealt = dealt.withColumn("_part", F.shiftright("_at", 33))       # partition << 33 | row
    # one row per partition and group it holds a piece of
    runs = dealt.groupBy(*by, "_part").agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*by)
    runs = (runs.withColumn("n", F.sum("_n").over(group))
            .withColumn("_before", F.sum("_n").over(group.orderBy("_part")) - F.col("_n")).drop("_n"))
    return (dealt.join(runs, [*by, "_part"])
            .select(*cols, (F.col("_at") - F.col("_from") + F.col("_before")).alias("idx"), "n"))


def _slots() -> list[Column]:
    return [F.col(f"s{k}") for k in range(FANOUT)]


def _bytes(slot: Column) -> Column:
    return F.coalesce(slot["h"], F.lit(b""))


def _pivot(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """Nodes (tree, idx, n, h, payload) to their parents (tree, idx, n, h),
    with the children as structs in ``s0`` to ``s15``.  A tree's only node
    passes unhashed; its parent then stands for the same node."""
    child = F.struct("h", *payload)
    slot = F.pmod("idx", F.lit(FANOUT))
    wide = (nodes.groupBy("tree", F.floor(F.col("idx") / FANOUT).alias("parent"))
            .agg(F.max("n").alias("n_children"),
                 *[F.max(F.when(slot == k, child)).alias(f"s{k}") for k in range(FANOUT)]))
    all_of = hex_text(F.concat(*[_bytes(s) for s in _slots()]))
    return wide.select("tree", F.col("parent").alias("idx"), "n_children",
                       F.ceil(F.col("n_children") / FANOUT).alias("n"),
                       F.when(F.col("n_children") == 1, F.col("s0")["h"]).otherwise(digest(all_of)).alias("h"),
                       *[f"s{k}" for k in range(FANOUT)])


def grow(leaves: DataFrame, payload: list[str]) -> list[DataFrame]:
    """The levels of the trees over ``leaves`` (tree, idx, n, h, payload),
    lowest first; a tree's root is the row with ``n`` = 1, which goes no
    further up."""
    levels = [scratch(_pivot(leaves, payload), "merkle-level")]
    while not (above := levels[-1].filter(F.col("n") > 1)).isEmpty():
        levels.append(scratch(_pivot(above.select("tree", "idx", "n", "h"), []), "merkle-level"))
    return levels


def roots(levels: list[DataFrame]) -> DataFrame:
    """(tree, h) of every tree."""
    out = None
    for level in levels:
        top = level.filter(F.col("n") == 1).select("tree", "h")
        out = top if out is None else out.unionByName(top)
    return out


def _children(level: DataFrame, payload: list[str]) -> DataFrame:
    """Parents with their ``path`` to one row per child: its own step (the
    siblings left and right of its slot), then the path."""
    slots = _slots()
    step = [F.struct(F.concat(F.lit(b""), *[_bytes(s) for s in slots[:k]]).alias("left"),
                     F.concat(F.lit(b""), *[_bytes(s) for s in slots[k + 1:]]).alias("right"))
            for k in range(FANOUT)]
    each = F.array(*[F.when(s.isNotNull(), F.struct(F.lit(k).alias("k"), s.alias("s"), st.alias("step")))
                     for k, (s, st) in enumerate(zip(slots, step))])
    kept = [c for c in level.columns if c not in {f"s{k}" for k in range(FANOUT)} | {"n", "h"}]
    rows = level.select(*kept, F.explode(F.filter(each, lambda x: x.isNotNull())).alias("c"))
    path = F.when(F.col("n_children") == 1, F.col("path")).otherwise(
        F.concat(F.array(F.col("c.step")), F.col("path")))
    others = [c for c in kept if c not in ("tree", "idx", "n_children", "path")]
    return rows.select("tree", (F.col("idx") * FANOUT + F.col("c.k")).alias("idx"), path.alias("path"),
                       *others, F.col("c.s.h").alias("h"), *[F.col(f"c.s.{p}").alias(p) for p in payload])


def paths(levels: list[DataFrame], top: DataFrame, payload: list[str]) -> DataFrame:
    """Per leaf: tree, idx, h, payload and ``path`` (array of the siblings
    left and right, leaf level first), extended by what ``top`` has for each
    tree: its columns (tree, path, ...) come with every leaf."""
    below = None
    for i in range(len(levels) - 1, -1, -1):
        level = levels[i]
        at = level.filter(F.col("n") == 1).join(top, "tree")
        if below is not None:
            at = at.unionByName(level.filter(F.col("n") > 1).join(below.drop("h"), ["tree", "idx"]))
        below = _children(at, payload if i == 0 else [])
    return below


def manifest(df: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields=FIELDS,
             changed: dict[str, Column] | None = None, changed_where: Column | None = None) -> DataFrame:
    """Per row: ``doc_id``, ``leaf``, ``subroot``, ``root`` (bytes), ``path``
    and ``claimed``, the leaf of the row as a reader would find it: with
    ``changed`` fields where ``changed_where`` holds, else the leaf."""
    leaf = leaf_of(fields)
    claimed = leaf if changed is None else F.when(F.coalesce(changed_where, F.lit(False)), leaf_of(fields, changed))
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(group_col).cast("string").alias("grp"), leaf.alias("h"),
                     *([] if changed is None else [claimed.alias("other")]))
    payload = [c for c in rows.columns if c not in ("grp", "h")]
    rows = rows.withColumn("tree", encoded(F.col("grp")))
    # (tree, grp) are in step; the order of the trees is that of grp
    leaves = placed(rows, ["tree"], ["doc_id", "h"]).select("tree", "idx", "n", "h", *payload, "grp")
    levels = grow(leaves, [*payload, "grp"])

    names = levels[0].groupBy("tree").agg(F.max("s0.grp").alias("grp"))
    subroots = roots(levels).join(names, "tree").withColumn("one", F.lit(0))
    upper = placed(subroots, ["one"], ["grp"]).select(F.lit("").alias("tree"), "idx", "n", "h", F.col("tree").alias("sub"))
    upper = grow(upper, ["sub"])
    root = roots(upper).select("tree", F.col("h").alias("root"),
                               F.array().cast("array<struct<left:binary,right:binary>>").alias("path"))
    top = scratch(paths(upper, root, ["sub"]).select(F.col("sub").alias("tree"), F.col("h").alias("subroot"),
                                                      "root", "path"), "merkle-top")
    out = paths(levels, top, [*payload, "grp"])
    return out.select("doc_id", F.col("h").alias("leaf"), "subroot", "root", "path",
                      (F.col("h") if changed is None else F.coalesce("other", "h")).alias("claimed"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda acc, s: digest(hex_text(F.concat(s["left"], acc, s["right"]))))


def proof_digest(path: Column) -> Column:
    """SHA-256 of the siblings, level by level, as hexadecimal text."""
    return F.sha2(F.array_join(F.transform(path, lambda s: hex_text(F.concat(s["left"], s["right"]))), ""), 256)


def lower_az(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digests(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` with its proofs checked: every fifth id
    hash claims a text in lower case, which verifies only if it was so."""
    odd = F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0
    m = manifest(docs, changed={"text": lower_az(F.col("text"))}, changed_where=odd)
    fold = folded(F.col("claimed"), F.col("path"))
    m = m.select("doc_id", hex_text(F.col("leaf")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"),
                 hex_text(F.col("root")).alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
                 hex_text(fold).alias("folded_root"))
    return m.withColumn("verified", F.col("folded_root") == F.col("root"))


# The same in DuckDB, for at most 16^LEVELS rows a group and as many groups.
LEVELS = 5


def _sql_levels(name: str, tree: str) -> str:
    """CTEs of the levels over ``{name}0`` and of the siblings at each."""
    out = []
    for k in range(LEVELS):
        out.append(f"""{name}_p{k} AS (SELECT {tree}, idx, n,
    string_agg(h, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
    string_agg(h, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r
  FROM {name}{k} WINDOW r AS (PARTITION BY {tree}, idx // 16 ORDER BY idx))""")
        out.append(f"""{name}{k + 1} AS (SELECT {tree}, idx // 16 AS idx, (n + 15) // 16 AS n,
    CASE WHEN n = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h
  FROM {name}{k} GROUP BY {tree}, idx // 16, n)""")
    return ",\n".join(out)


def _sql() -> str:
    enc = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen(CAST({0} AS VARCHAR)) || ':' || {0} END".format
    leaf = " || ".join(enc(f) for f in FIELDS)
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    claimed = " || ".join(enc("lowered") if f == "text" else enc(f) for f in FIELDS)
    # one fold per level, so that each digest is computed once
    steps, last = [], "c"
    for a in ("a", "b"):
        for k in range(LEVELS):
            steps.append(f"CASE WHEN {a}{k}.n > 1 THEN sha256(coalesce({a}{k}.l, '') || {last} || coalesce({a}{k}.r, '')) "
                         f"ELSE {last} END AS {a}f{k}")
            last = f"{a}f{k}"
    proof = " || ".join(f"coalesce({a}{k}.l, '') || coalesce({a}{k}.r, '')" for a in "ab" for k in range(LEVELS))
    joins = " ".join(f"JOIN t_p{k} a{k} ON a{k}.source IS NOT DISTINCT FROM d.source AND a{k}.idx = d.idx // {16 ** k}"
                     for k in range(LEVELS))
    joins += f" JOIN t{LEVELS} s ON s.source IS NOT DISTINCT FROM d.source"
    joins += " JOIN g0 ON g0.source IS NOT DISTINCT FROM d.source "
    joins += " ".join(f"JOIN g_p{k} b{k} ON b{k}.idx = g0.idx // {16 ** k}" for k in range(LEVELS))
    return f"""
WITH crc_bytes AS (SELECT list_transform(range(256), lambda b: list_reduce(range(8),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b)) AS t),
docs AS (SELECT *, {low} AS lowered, CASE WHEN doc_id IS NULL THEN false ELSE
    xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
      lambda c, b: xor(c // 256, t[1 + xor(c % 256, b)]), 4294967295), 4294967295) % {TAMPER_EVERY} = 0 END AS odd
  FROM documents, crc_bytes),
leaves AS (SELECT doc_id, source, sha256({leaf}) AS h,
    CASE WHEN odd THEN sha256({claimed}) ELSE sha256({leaf}) END AS c FROM docs),
d AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS idx,
    count(*) OVER (PARTITION BY source) AS n FROM leaves),
t0 AS (SELECT source, idx, n, h FROM d),
{_sql_levels("t", "source")},
g0 AS (SELECT source, 0 AS one, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n, h
  FROM t{LEVELS}),
{_sql_levels("g", "one")},
p AS (SELECT d.doc_id, d.h AS leaf, s.h AS subroot, sha256({proof}) AS proof_sha256, d.c,
    {", ".join(steps)} FROM d {joins})
SELECT p.doc_id, leaf, subroot, g{LEVELS}.h AS root, proof_sha256, {last} AS folded_root, {last} = g{LEVELS}.h AS verified
FROM p, g{LEVELS}
"""


SQL = _sql()
