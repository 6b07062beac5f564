"""Packing documents into sequences of at most ``WINDOW`` tokens.

Documents are tokenized once and written to the shared folder.  A document's
whole windows are sequences of their own; what is left of it (its rest, below
one window) is packed with others.  Only the histogram of rests (at most
``WINDOW`` - 1 lengths) reaches the driver, which plans with it:

1. enumerate shallow combinations of lengths that fill a window exactly;
2. solve non-negative least squares for how often to use each, so that
   together they use up the histogram;
3. round, never using more rests of a length than there are;
4. pack the residual greedily, largest first, cutting a rest only where
   nothing fits the space that is left.

The tokens that fill no window at the end go into sequences of power-of-two
length.  So there is no padding at all, and rests packed by steps 1-3 are not
cut.

A plan is a list of runs: the rests of one length with ranks a..b go to
sequences s, s+1, ... at one offset.  Its size depends on the number of
combinations, not on the number of documents.  Each rest gets its rank within
its length from a window over (length, salt); then tasks look their rows up in
the runs.  The number of salts of a length follows its count, so that all groups
are of about the same size and at most ``WINDOW + GROUPS`` in number; salts are
hashes of the written row's own number, so equal rows spread as well.

Defined results: a null text counts as empty and is one piece, the end id; a
null id keeps its tokens; repeated rows are packed each; an empty table gives
no piece; other columns are not read.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamfold.llm.common import scratch, ship, text_or_empty, tokenizer_path
from streamfold.llm.token_count import VOCAB, chunks, load, memory

WINDOW = 4096
END_ID = 2
GROUPS = 1 << 18         # (length, salt) groups beside one for each length, at most
GROUP_ROWS = 256         # rows of a group, at least, before a length is divided
COMBINATIONS = 12        # kept for each length
PARTNERS = 24            # lengths tried as the second of three
TIMES = 8                # copies of the first and the second length, at most

def tokenized(df: DataFrame, id_col: str, text_col: str, path: str, end_id: int = END_ID) -> DataFrame:
    """Per row: ``doc_id``, ``ids`` (little-endian 32-bit, the end id last)
    and ``n`` (tokens)."""
    ship(df.sparkSession)
    # bounded by the vocabulary
    whole = df.sparkSession.sparkContext.broadcast(load(path).whole_tokens())
    d = df.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))

    def run(batches):
        known = memory(path, whole.value)
        for batch in batches:
            a = 0
            for texts in chunks(batch.column("text")):
                ids, size = known.encode(texts)
                ids = np.insert(ids, np.cumsum(size), end_id).astype("<u4")
                ends = np.concatenate([[0], np.cumsum(size + 1)])
                data = pa.Array.from_buffers(pa.large_binary(), len(texts),
                                             [None, pa.py_buffer(4 * ends), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, len(texts)), data.cast(pa.binary()), pa.array(size + 1)],
                    names=["doc_id", "ids", "n"])
                a += len(texts)

    return d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, ids binary, n long")


# ------------------------------------------------------------ plan (driver)
def combinations(hist: np.ndarray, window: int, each: int = COMBINATIONS, partners: int = PARTNERS) -> list[tuple]:
    """Combinations ((length, times), ...) of at most three different lengths
    of the histogram that fill the window exactly: some copies of a length,
    some of a partner, and one rest that closes the window.  For every length
    the ``each`` that the histogram could repeat most often are kept, with
    partners drawn in proportion to their counts (from a fixed seed)."""
    lengths = np.flatnonzero(hist)
    if not len(lengths):
        return []
    rng = np.random.default_rng(0)
    weight = hist[lengths] / hist[lengths].sum()
    found: dict[tuple, None] = {}
    times = np.arange(1, TIMES + 1)
    for n in lengths.tolist():
        others = rng.choice(lengths, size=min(partners, len(lengths)), p=weight)
        k, m, q = (x.ravel() for x in np.meshgrid(times, others, np.concatenate([[0], times]), indexing="ij"))
        k = np.concatenate([k, [window // n]])
        m, q = np.append(m, n), np.append(q, 0)
        left = window - k * n - q * m
        ok = (k > 0) & (left >= 0) & ((left == 0) | (hist[np.maximum(left, 0)] > 0))
        k, m, q, left = k[ok], m[ok], q[ok], left[ok]
        often = np.minimum(hist[n] / k, np.minimum(np.where(q > 0, hist[m] / np.maximum(q, 1), np.inf),
                                                   np.where(left > 0, hist[left], np.inf)))
        kept = 0
        for j in np.argsort(-often, kind="stable"):
            parts: dict[int, int] = {}
            for size, count in ((n, int(k[j])), (int(m[j]), int(q[j])), (int(left[j]), 1)):
                if size and count:
                    parts[size] = parts.get(size, 0) + count
            combo = tuple(sorted(parts.items(), reverse=True))
            if all(hist[size] >= count for size, count in combo) and combo not in found:
                found[combo] = None
                kept += 1
                if kept == each:
                    break
    return list(found)


def nnls(combos: list[tuple], target: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - target|, where column j of A
    counts the lengths of combination j: accelerated projected gradient over
    the sparse columns, scaled by their norms."""
    rows = np.array([n for c in combos for n, _ in c])
    cols = np.array([j for j, c in enumerate(combos) for _ in c])
    vals = np.array([k for c in combos for _, k in c], dtype=float)
    norm = np.sqrt(np.bincount(cols, weights=vals ** 2, minlength=len(combos)))
    vals = vals / norm[cols]

    def forward(x):
        return np.bincount(rows, weights=vals * x[cols], minlength=len(target))

    def backward(y):
        return np.bincount(cols, weights=vals * y[rows], minlength=len(combos))

    v = np.ones(len(combos))
    for _ in range(20):             # the largest eigenvalue of A'A
        v = backward(forward(v))
        size = np.linalg.norm(v)
        v /= size
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - backward(forward(y) - target) / (1.05 * size))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x / norm


class Plan:
    """Runs that tell every rest its pieces.

    A run: rests of ``length`` with ranks from ``rank`` on, ``count`` of them,
    from ``start`` on, ``size`` tokens each; the first is number ``at`` of its
    group, number k of a group lies in sequence ``seq + k // times`` at
    ``offset + k % times * size``.  Runs of one generation (how often a rest
    was cut before) do not overlap."""

    FIELDS = ("length", "rank", "count", "start", "size", "seq", "times", "at", "offset")

    def __init__(self, hist: np.ndarray, window: int = WINDOW):
        self.window = window
        self.hist = hist
        self.pool: dict[int, deque] = {int(n): deque([(int(n), 0, int(hist[n]), 0, 0)])
                                       for n in np.flatnonzero(hist)}
        self.left = hist.astype(np.int64).copy()
        self.runs: list[list[tuple]] = []
        self.sequences = 0
        self.by_combination = 0      # rests packed uncut by the least-squares plan
        self._combine()
        self._greedy()
        self._last()

    def _take(self, size: int, count: int):
        """Runs (length, rank, count, start, generation) of ``count`` pieces."""
        self.left[size] -= count
        runs = self.pool[size]
        while count:
            n, rank, have, start, gen = runs.popleft()
            used = min(have, count)
            if used < have:
                runs.appendleft((n, rank + used, have - used, start, gen))
            count -= used
            yield n, rank, used, start, gen

    def _put(self, size: int, run: tuple) -> None:
        self.left[size] += run[2]
        self.pool.setdefault(size, deque()).append(run)

    def _place(self, taken, size: int, seq: int, times: int, offset: int, cut_from: int = 0) -> None:
        """Pieces of ``size`` to a group of slots; what a cut leaves of them
        goes back to the pool."""
        at = 0
        for n, rank, count, start, gen in taken:
            while len(self.runs) <= gen:
                self.runs.append([])
            self.runs[gen].append((n, rank, count, start, size, seq, times, at, offset))
            at += count
            if cut_from:
                self._put(cut_from - size, (n, rank, count, start + size, gen + 1))

    def _use(self, combo, repeats: int) -> None:
        offset = 0
        for n, k in combo:
            self._place(self._take(n, k * repeats), n, self.sequences, k, offset)
            offset += n * k
        self.sequences += repeats

    def _combine(self) -> None:
        combos = combinations(self.hist, self.window)
        if not combos:
            return
        wanted = nnls(combos, self.hist.astype(float))
        for j in np.argsort(-wanted, kind="stable"):
            repeats = min([int(round(wanted[j])), *(int(self.left[n] // k) for n, k in combos[j])])
            if repeats > 0:
                self._use(combos[j], repeats)
                self.by_combination += repeats * sum(k for _, k in combos[j])

    def _greedy(self) -> None:
        sizes = np.arange(len(self.left))
        total = int((self.left * sizes).sum())
        while total >= self.window:
            left, combo, space = self.left.copy(), {}, self.window
            cut = 0
            while space:
                fits = np.flatnonzero(left[1:space + 1])
                if len(fits):
                    n = int(fits[-1]) + 1
                    k = min(int(left[n]), space // n)
                    combo[n] = combo.get(n, 0) + k
                    left[n] -= k
                    space -= n * k
                else:               # nothing fits: cut the smallest that is longer
                    cut = space + 1 + int(np.flatnonzero(left[space + 1:])[0])
                    break
            repeats = min(int(self.left[n] // (k + (n == cut))) for n, k in combo.items()) if combo else self.left[cut]
            if cut:
                repeats = min(int(repeats), int(self.left[cut]))
            first = self.sequences
            self._use(list(combo.items()), int(repeats))
            if cut:
                self._place(list(self._take(cut, int(repeats))), space, first, 1, self.window - space, cut)
            total -= int(repeats) * self.window

    def _last(self) -> None:
        """Less than a window is left: sequences of its binary digits."""
        total = int((self.left * np.arange(len(self.left))).sum())
        room = [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]
        offset = 0
        while room:
            n = int(np.flatnonzero(self.left)[-1])
            size = min(n, room[0] - offset)
            self._place(list(self._take(n, 1)), size, self.sequences, 1, offset, n if size < n else 0)
            offset += size
            if offset == room[0]:
                room.pop(0)
                self.sequences += 1
                offset = 0

    def tables(self) -> list[dict[str, np.ndarray]]:
        """Per generation, the runs as columns sorted by (length, rank)."""
        out = []
        for runs in self.runs:
            a = np.array(runs, dtype=np.int64).reshape(-1, len(self.FIELDS))
            a = a[np.lexsort((a[:, 1], a[:, 0]))]
            out.append({f: a[:, i].copy() for i, f in enumerate(self.FIELDS)})
        return out


def look_up(tables, length: np.ndarray, rank: np.ndarray):
    """Pieces of the rests, as (row, start, size, sequence, offset) arrays."""
    got = []
    row = np.flatnonzero(length > 0)
    done = np.zeros(len(length), dtype=np.int64)
    for t in tables:
        if not len(row):
            break
        key = t["length"] << 44 | t["rank"]
        i = np.searchsorted(key, length[row] << 44 | rank[row], side="right") - 1
        k = t["at"][i] + rank[row] - t["rank"][i]
        got.append((row, t["start"][i], t["size"][i], t["seq"][i] + k // t["times"][i],
                    t["offset"][i] + k % t["times"][i] * t["size"][i]))
        done[row] += t["size"][i]
        row = row[done[row] < length[row]]
    return [np.concatenate(x) for x in zip(*got)] if got else [np.zeros(0, np.int64)] * 5


# ---------------------------------------------------------------- operator
def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         vocab: str = VOCAB, folder: str | None = None, groups: int = GROUPS) -> DataFrame:
    """Per piece: ``doc_id``, ``start``, ``length``, ``ids`` (little-endian
    32-bit), ``doc_tokens``, ``sequence_id`` and ``offset``."""
    sc = df.sparkSession.sparkContext
    d = scratch(tokenized(df, id_col, text_col, tokenizer_path(vocab, folder))
                .withColumn("rest", (F.col("n") % window).cast("int"))
                .withColumn("full", F.floor(F.col("n") / window))
                .withColumn("row", F.monotonically_increasing_id()), "tokenized")
    # at most window rows
    of_rest = np.zeros(window, dtype=np.int64)
    for rest, count in d.groupBy("rest").count().collect():
        of_rest[rest] = count
    salts = np.maximum(1, -(-of_rest // max(GROUP_ROWS, -(-int(of_rest.sum()) // groups))))
    d = d.withColumn("salt", F.pmod(F.xxhash64("row"), F.element_at(F.lit(salts.tolist()), F.col("rest") + 1)))
    # at most window + groups rows
    counts = np.array([tuple(r) for r in d.groupBy("rest", "salt").agg(
        F.count(F.lit(1)), F.sum("full")).collect()], dtype=np.int64).reshape(-1, 4)
    first = np.cumsum(salts) - salts                  # group (rest, salt) is number first[rest] + salt
    rows, full = np.zeros(salts.sum(), np.int64), np.zeros(salts.sum(), np.int64)
    rows[first[counts[:, 0]] + counts[:, 1]] = counts[:, 2]
    full[first[counts[:, 0]] + counts[:, 1]] = counts[:, 3]
    upto = np.cumsum(rows) - rows
    hist = of_rest.copy()
    hist[0] = 0
    plan = Plan(hist, window)
    rank_from = upto - np.repeat(upto[first], salts)
    full_from = plan.sequences + np.cumsum(full) - full
    shared = sc.broadcast((plan.tables(), first, rank_from, full_from))
    order = Window.partitionBy("rest", "salt").orderBy("row")
    ranked = (d.withColumn("rank", F.row_number().over(order) - 1)
              .withColumn("full_before", F.coalesce(
                  F.sum("full").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))

    def assigned(batches):
        tables, first, rank_from, full_from = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {c: batch.column(c).to_numpy() for c in ("n", "rest", "full", "salt", "rank", "full_before")}
            rest = col["rest"].astype(np.int64)
            group = first[rest] + col["salt"]
            row, start, size, seq, offset = look_up(tables, rest, col["rank"] + rank_from[group])
            start = start + col["full"][row] * window
            # whole windows
            whole = np.repeat(np.arange(batch.num_rows), col["full"])
            nth = np.arange(len(whole)) - np.repeat(np.cumsum(col["full"]) - col["full"], col["full"])
            row = np.concatenate([row, whole])
            start = np.concatenate([start, nth * window])
            size = np.concatenate([size, np.full(len(whole), window)])
            seq = np.concatenate([seq, (full_from[group] + col["full_before"])[whole] + nth])
            offset = np.concatenate([offset, np.zeros(len(whole), np.int64)])
            ids = batch.column("ids")
            for a in range(0, len(row), 2000):
                part = slice(a, a + 2000)
                pieces = [ids[r].as_buffer()[4 * s:4 * (s + z)].to_pybytes()
                          for r, s, z in zip(row[part].tolist(), start[part].tolist(), size[part].tolist())]
                at = pa.array(row[part])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(at), pa.array(start[part]), pa.array(size[part]),
                     pa.array(pieces, pa.binary()), batch.column("n").take(at), pa.array(seq[part]),
                     pa.array(offset[part])],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    kind = d.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(assigned, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, "
                                       "sequence_id long, offset long")


def pieces(docs: DataFrame, **options) -> DataFrame:
    """The packing with a checksum of each piece's ids in their place."""
    return pack(docs, **options).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                                        "doc_tokens", "sequence_id", "offset")
