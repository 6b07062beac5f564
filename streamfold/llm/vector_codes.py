"""Vector code compression: product codes by Lloyd rounds over cover trees.

Components become integers floor(``SCALE`` x); vectors are cut into ``PARTS``
equal parts, each with a codebook of ``ENTRIES``.  All arithmetic that decides
anything is exact.

*Cover trees.*  Each task cuts its rows into blocks and builds, once, a cover
tree of each part of a block: a node is a ball around one of its points, its
children are balls of half the radius whose centres lie further apart than
that.  The points of a node are consecutive, so running sums give the sum of
any node's points.  The blocks are written to the shared folder.

*Rounds.*  A node whose centre is nearer to one entry than to any other by
more than twice its radius has, by the triangle inequality, all its points
there: its count and sum are added at once.  Other nodes hand on to their
children, and the points of an ambiguous leaf are compared exactly, ties going
to the lower index.  A task returns one sum per entry and component, so what
the driver collects has the size of the codebooks.

Defined results: vectors that are null or hold null or non-finite components
are dropped; the vector of the smallest id sets the length, and vectors of
another length keep their row with null code and error; a length that the
parts do not divide is filled up with zeros; components beyond
``LARGEST`` / ``SCALE`` count as that; with fewer than ``ENTRIES`` rows the
codebooks are shorter; null ids sort last and repeated ids are separate rows;
null labels are one label; an error sum beyond 64 bits is null; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamfold.llm.common import scratch, ship

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
BLOCK_VALUES = 1 << 20      # components of one block
LEAF = 48                   # points of a node that is not divided further
CHILDREN = 32               # balls of one node; points outside all of them are compared exactly
LARGEST = 1 << 24           # squared distances of up to 2^13 components stay below 2^63
EXACT_DOUBLE = 2.0 ** 53


def integers(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -LARGEST, LARGEST).astype(np.int64)


def square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two integer matrices."""
    top = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if 4.0 * top * top * a.shape[1] < EXACT_DOUBLE:      # every partial sum is a whole double
        x, y = a.astype(np.float64), b.astype(np.float64)
        return ((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T)).astype(np.int64)
    out = np.empty((len(a), len(b)), dtype=np.int64)
    for j, row in enumerate(b.astype(np.int64)):
        out[:, j] = ((a - row) ** 2).sum(1)
    return out


class CoverTree:
    """Balls over the rows of ``x``.

    ``order`` lists the rows so that every node's are consecutive.  A level
    holds, per node, ``start`` and ``end`` in that order, the row of its
    ``center``, its squared radius ``r2`` and where its ``children`` begin
    in the next level (-1: a leaf)."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF, children: int = CHILDREN):
        n = len(x)
        order = np.arange(n)
        level = {"start": np.array([0]), "end": np.array([n]), "center": np.array([0]),
                 "r2": np.array([((x - x[0]) ** 2).sum(1).max()]), "open": np.array([True])}
        self.levels: list[dict[str, np.ndarray]] = []
        while True:
            split = np.flatnonzero(level.pop("open") & (level["r2"] > 0) & (level["end"] - level["start"] > leaf))
            level["children"] = np.full(len(level["start"]), -1)
            level["n_children"] = np.zeros(len(level["start"]), dtype=np.int64)
            self.levels.append(level)
            if not len(split):
                break
            level = self._divide(x, order, level, split, children)
        small = np.uint16 if n <= 1 << 16 else np.int32
        self.order = order.astype(small)

    @staticmethod
    def _divide(x, order, level, split, children):
        """The children of the nodes ``split``; sorts ``order`` inside them."""
        sizes = (level["end"] - level["start"])[split]
        node = np.repeat(np.arange(len(split)), sizes)           # of each point, as a place in split
        at = np.repeat(level["start"][split] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(node))
        rows = order[at]
        r2 = level["r2"][split]
        child = np.full(len(rows), -1)
        found = []                                               # per turn: nodes, centres, radii
        free = np.arange(len(rows))
        center = level["center"][split]
        owner = np.arange(len(split))
        for turn in range(children):
            where = np.searchsorted(owner, node[free])
            d2 = ((x[rows[free]] - x[center[where]]) ** 2).sum(1)
            inside = 4 * d2 <= r2[node[free]]
            got = np.zeros(len(owner), dtype=np.int64)
            np.maximum.at(got, where[inside], d2[inside])
            child[free[inside]] = turn
            found.append((owner, np.full(len(owner), turn), center, got, np.ones(len(owner), dtype=bool)))
            free = free[~inside]
            if not len(free):
                break
            owner, first = np.unique(node[free], return_index=True)
            center = rows[free[first]]
        else:
            # outside all balls: one leaf for each node that has such points
            where = np.searchsorted(owner, node[free])
            d2 = ((x[rows[free]] - x[center[where]]) ** 2).sum(1)
            got = np.zeros(len(owner), dtype=np.int64)
            np.maximum.at(got, where, d2)
            child[free] = children
            found.append((owner, np.full(len(owner), children), center, got, np.zeros(len(owner), dtype=bool)))
        owner, turn, center, radius, open_ = (np.concatenate(c) for c in zip(*found))
        by = np.lexsort((turn, owner))
        owner, turn, center, radius, open_ = owner[by], turn[by], center[by], radius[by], open_[by]
        # points by (node, child); both lists have the same order of children
        key = node * (children + 1) + child
        order[at] = rows[np.argsort(key, kind="stable")]
        count = np.bincount(np.searchsorted(owner * (children + 1) + turn, key), minlength=len(owner))
        inside_node = np.cumsum(count) - count
        start = level["start"][split][owner] + inside_node - (np.cumsum(sizes) - sizes)[owner]
        level["n_children"][split] = np.bincount(owner, minlength=len(split))
        level["children"][split] = np.cumsum(level["n_children"][split]) - level["n_children"][split]
        return {"start": start, "end": start + count, "center": center, "r2": radius, "open": open_}

    def assign(self, x: np.ndarray, book: np.ndarray, labels: np.ndarray | None = None):
        """(count, sum) of the rows nearest to each entry of ``book``; fills
        ``labels`` with the entry of each row if given."""
        entries, lowest = np.unique(book, axis=0, return_index=True)
        by = np.argsort(lowest)                                  # equal entries: the lower index
        entries, lowest = entries[by], lowest[by]
        upto = np.zeros((len(x) + 1, x.shape[1]), dtype=np.int64)
        order = self.order.astype(np.int64)
        np.cumsum(x[order], axis=0, out=upto[1:])
        count = np.zeros(len(book), dtype=np.int64)
        total = np.zeros((len(book), x.shape[1]), dtype=np.int64)
        todo = np.array([0])
        exact = []
        for level in self.levels:
            d2 = square_distances(x[level["center"][todo]], entries)
            near = d2.argmin(1)
            d = np.sqrt(d2.astype(np.float64))
            mine = d[np.arange(len(d)), near]
            d[np.arange(len(d)), near] = np.inf
            second = d.min(1)
            reach = 2 * np.sqrt(level["r2"][todo].astype(np.float64))
            sure = (level["r2"][todo] == 0) | (second - mine > reach + 1e-6 * (1 + mine))
            start, end, win = level["start"][todo[sure]], level["end"][todo[sure]], lowest[near[sure]]
            np.add.at(count, win, end - start)
            np.add.at(total, win, upto[end] - upto[start])
            if labels is not None:
                size = end - start
                places = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
                labels[order[places]] = np.repeat(win, size)
            todo = todo[~sure]
            leaf = level["children"][todo] < 0
            exact += [order[a:b] for a, b in zip(level["start"][todo[leaf]], level["end"][todo[leaf]])]
            todo = todo[~leaf]
            if not len(todo):
                break
            size = level["n_children"][todo]
            todo = np.repeat(level["children"][todo] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        if exact:
            rows = np.concatenate(exact)
            win = lowest[square_distances(x[rows], entries).argmin(1)]
            count += np.bincount(win, minlength=len(book))
            for j in range(x.shape[1]):
                np.add.at(total[:, j], win, x[rows, j])
            if labels is not None:
                labels[rows] = win
        return count, total


def _narrow(x: np.ndarray) -> np.ndarray:
    fits = np.abs(x).max(initial=0) < 1 << 15
    return x.astype(np.int16 if fits else np.int32)


def blocks_of(vectors: DataFrame, dim: int, values: int = BLOCK_VALUES) -> DataFrame:
    """Rows (vec_id, label, vec) to blocks: the lists of ids and labels, and
    the integer vectors with a cover tree of each part."""
    rows = max(ENTRIES, values // dim)
    width = -(-dim // PARTS)

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        x = np.zeros((t.num_rows, width * PARTS), dtype=np.int64)
        x[:, :dim] = integers(t.column("vec").combine_chunks().flatten().to_numpy()).reshape(-1, dim)
        trees = [CoverTree(x[:, p * width:(p + 1) * width]) for p in range(PARTS)]
        lists = [pa.ListArray.from_arrays(pa.array([0, t.num_rows], pa.int32()), t.column(c).combine_chunks())
                 for c in ("vec_id", "label")]
        return pa.RecordBatch.from_arrays([*lists, pa.array([pickle.dumps((_narrow(x), trees))], pa.binary())],
                                          names=["ids", "labels", "trees"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            while n + batch.num_rows >= rows:
                yield block([*held, batch.slice(0, rows - n)])
                batch = batch.slice(rows - n)
                held, n = [], 0
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
        if held:
            yield block(held)

    kind = {c: vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    return vectors.select("vec_id", "label", "vec").mapInArrow(
        run, f"ids array<{kind['vec_id']}>, labels array<{kind['label']}>, trees binary")


def _parts(book_or_rows: np.ndarray) -> list[np.ndarray]:
    return np.split(book_or_rows, PARTS, axis=1)


def lloyd(blocks: DataFrame, book: np.ndarray) -> np.ndarray:
    """One round: every part to its nearest entry, then every entry that has
    parts to their mean, rounded down.  Entry i of part p is
    ``book[i]`` in that part's columns."""
    shared = blocks.sparkSession.sparkContext.broadcast(book)
    size, dim = book.shape

    def run(batches):
        count, total = np.zeros((PARTS, size), np.int64), np.zeros((size, dim), np.int64)
        books = _parts(shared.value)
        for batch in batches:
            for cell in batch.column("trees"):
                x, trees = pickle.loads(cell.as_buffer())
                for p, (part, tree) in enumerate(zip(_parts(x.astype(np.int64)), trees)):
                    n, s = tree.assign(part, books[p])
                    count[p] += n
                    total[:, p * part.shape[1]:(p + 1) * part.shape[1]] += s
        entry, at = np.divmod(np.arange(size * dim), dim)
        n = count[at // (dim // PARTS), entry]
        used = n > 0
        yield pa.RecordBatch.from_arrays([pa.array(a[used]) for a in (entry, at, n, total.ravel())],
                                         names=["entry", "at", "n", "s"])

    sums = (blocks.select("trees").mapInArrow(run, "entry long, at long, n long, s long")
            .groupBy("entry", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")))
    out = book.copy()
    for r in sums.collect():            # at most entries x components rows
        out[r["entry"], r["at"]] = r["s"] // r["n"]
    return out


def codes(blocks: DataFrame, book: np.ndarray) -> DataFrame:
    """Per vector: vec_id, label, ``code`` (one byte a part) and ``error``."""
    shared = blocks.sparkSession.sparkContext.broadcast(book)

    def run(batches):
        books = _parts(shared.value)
        for batch in batches:
            for i, cell in enumerate(batch.column("trees")):
                x, trees = pickle.loads(cell.as_buffer())
                code, error = np.zeros((len(x), PARTS), np.uint8), np.zeros(len(x), np.int64)
                for p, (part, tree) in enumerate(zip(_parts(x.astype(np.int64)), trees)):
                    labels = np.zeros(len(x), np.int64)
                    tree.assign(part, books[p], labels)
                    code[:, p] = labels
                    error += ((part - books[p][labels]) ** 2).sum(1)
                ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * PARTS)
                data = pa.Array.from_buffers(pa.binary(), len(x), [None, ends.buffers()[1], pa.py_buffer(code.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids").slice(i, 1).flatten(), batch.column("labels").slice(i, 1).flatten(),
                     data, pa.array(error)], names=["vec_id", "label", "code", "error"])

    kind = {c: blocks.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels")}
    return blocks.mapInArrow(run, f"vec_id {kind['ids']}, label {kind['labels']}, code binary, error long")


def compress(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The codes of all vectors, (vec_id, label, code, error), and the final
    codebooks as a matrix, entry by component."""
    ship(df.sparkSession)
    sound = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = (df.filter(F.col(vec_col).isNotNull() & sound)
            .select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec")))
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).collect()
    dim = len(first[0]["vec"]) if first else 0
    none = kept.select("vec_id", "label", F.lit(None).cast("binary").alias("code"),
                       F.lit(None).cast("long").alias("error"), F.size("vec").alias("dim"))
    if dim == 0:                # no vector, or vectors without components
        return none.drop("dim"), np.zeros((0, 0), np.int64)
    alike = [r["vec"] for r in first if len(r["vec"]) == dim]
    book = np.zeros((len(alike), -(-dim // PARTS) * PARTS), dtype=np.int64)
    book[:, :dim] = integers(np.array(alike))
    blocks = scratch(blocks_of(kept.filter(F.size("vec") == dim), dim), "vector-blocks")
    for _ in range(rounds):
        book = lloyd(blocks, book)
    return codes(blocks, book).unionByName(none.filter(F.col("dim") != dim).drop("dim")), book


def book_digest(book: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, comma-joined."""
    numbers = [str(v) for part in _parts(book) for v in part.ravel().tolist()] if book.size else []
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def digests(embeddings: DataFrame) -> DataFrame:
    coded, book = compress(embeddings)
    coded = scratch(coded, "vector-codes")
    # written first: a join of two plain inputs is split where a label is hot
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = scratch(coded.groupBy("label").agg(total.try_cast("long").alias("label_error"))
                   .withColumnRenamed("label", "of_label"), "vector-labels")
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("of_label")))
            .select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
                    F.lit(book_digest(book)).alias("codebooks_sha256")))


def _sql() -> str:
    def nearest(i: int) -> str:
        return f"""a{i} AS (SELECT w.rn, w.p, min(struct_pack(d := list_sum(list_transform(list_zip(w.s, b.s),
    lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := b.e)) AS m FROM w JOIN b{i} b ON b.p = w.p GROUP BY w.rn, w.p)"""

    rounds = []
    for i in range(ROUNDS):
        rounds.append(nearest(i))
        rounds.append(f"""m{i} AS (SELECT p, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY k) AS s FROM (
    SELECT w.p, a{i}.m.e AS e, k, sum(CAST(w.s[k] AS DOUBLE)) AS s, count(*) AS n
    FROM w JOIN a{i} USING (rn, p), unnest(range(1, len(w.s) + 1)) AS u(k) GROUP BY ALL) GROUP BY p, e),
b{i + 1} AS (SELECT b.p, b.e, coalesce(m.s, b.s) AS s FROM b{i} b LEFT JOIN m{i} m USING (p, e))""")
    return f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
r AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, q) AS rn FROM v),
w AS (SELECT rn, p, q[p * (len(q) // {PARTS}) + 1:(p + 1) * (len(q) // {PARTS})] AS s
  FROM r, unnest(range({PARTS})) AS u(p)),
b0 AS (SELECT p, rn - 1 AS e, s FROM w WHERE rn <= {ENTRIES}),
{", ".join(rounds)},
{nearest(ROUNDS)},
c AS (SELECT rn, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM a{ROUNDS} GROUP BY rn),
h AS (SELECT sha256(string_agg(array_to_string(s, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM r JOIN c USING (rn), h
"""


# The same in DuckDB, for vectors of one length that the parts divide.
SQL = _sql()
