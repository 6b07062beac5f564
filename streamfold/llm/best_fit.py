"""Best-fit packing: whole documents into as few windows as possible.

A document longer than ``WINDOW`` tokens is cut into whole windows and what is
left; nothing else is cut.  Only the histogram of piece lengths (at most
``WINDOW`` numbers) reaches the driver, which plans with it:

1. *Configuration linear program.*  A configuration says how many pieces of
   which lengths share a window.  The program covers the histogram by
   configurations, in as few windows as possible.
2. *Multiplicative weights.*  Each length has a weight that falls
   exponentially with the share of its pieces that is covered, and when a
   configuration asks for more of them than are left.  A piece's price is its
   length times its weight: equal weights are the optimal prices where windows
   can be filled without a gap.
3. *Knapsack pricing.*  Dynamic programming over the window's tokens gives the
   configuration of highest price for every capacity, and so, for each of the
   lengths least covered so far, the best configuration that holds it.
4. *Rounding.*  Whole repeats of each configuration are used as far as the
   histogram goes; the pieces left are packed longest first, each window with
   the longest pieces that fit it.

The plan is a list of runs: the pieces of one length with ranks a..b go to
sequences s, s+1, ... at one offset.  Its size depends on the configurations,
not on the documents, and is what goes out by broadcast.

A piece's rank within its length comes from a window over (length, salt).
The number of salts of a length follows its count, so that all groups are of
about the same size and at most ``WINDOW + GROUPS`` in number; salts are hashes
of the written row's own number, so equal rows spread as well.

Defined results: a null text counts as empty and is one piece, the end id; a
null id keeps its tokens; repeated rows are packed each; an empty table gives
no piece; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamfold.llm.common import scratch, ship, tokenizer_path
from streamfold.llm.packing import tokenized
from streamfold.llm.token_count import VOCAB

WINDOW = 4096
END_ID = 1
GROUPS = 1 << 18         # (length, salt) groups beside one for each length, at most
GROUP_ROWS = 256         # rows of a group, at least, before a length is divided
ROUNDS = 60              # knapsack solutions
COLUMNS = 96             # configurations taken from each
STEP = 0.25              # share of a length's pieces one configuration may cover at once
FALL = 1.0               # weight of a length that is covered: exp(-FALL)


# ------------------------------------------------------------ plan (driver)
def knapsack(price: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per capacity 0..window the highest price of pieces that fit it, and
    the last length taken (0: none).  ``price[l]`` is that of one piece of
    length l; lengths of price 0 are not taken."""
    window = len(price) - 1
    best, last = np.zeros(window + 1), np.zeros(window + 1, dtype=np.int64)
    sizes = np.flatnonzero(price)[::-1]             # of equal prices the fewest pieces
    worth = price[sizes]
    fits = np.searchsorted(-sizes, -np.arange(window + 1))
    for c in range(1, window + 1):
        best[c] = best[c - 1]                       # a token of the window stays free
        k = fits[c]
        if k < len(sizes):
            total = best[c - sizes[k:]] + worth[k:]
            i = int(total.argmax())
            if total[i] > best[c]:
                best[c], last[c] = total[i], sizes[k + i]
    return best, last


def configuration(last: np.ndarray, capacity: int) -> dict[int, int]:
    """The pieces behind ``knapsack``'s best price for a capacity."""
    out: dict[int, int] = {}
    while capacity > 0:
        n = int(last[capacity])
        if n:
            out[n] = out.get(n, 0) + 1
        capacity -= n or 1
    return out


def solve(hist: np.ndarray, rounds: int = ROUNDS, columns: int = COLUMNS) -> dict[tuple, float]:
    """Configurations ((length, count), ...) and how often to use each.  No
    length is used more often than the histogram has it."""
    total = hist.astype(float)
    left = total.copy()
    sizes = np.arange(len(hist))
    # of equal fills, the one of the more common lengths
    weight = 1 - 0.5 / len(hist) / (1 + total)
    plan: dict[tuple, float] = {}
    for _ in range(rounds):
        open_ = left >= 1
        if not open_.any():
            break
        _, last = knapsack(np.where(open_, sizes * weight, 0.0))
        # the lengths with most tokens to cover, and the window as a whole
        wanted = np.argsort(-(left * sizes), kind="stable")[:columns]
        for n in [0, *wanted[left[wanted] >= 1].tolist()]:
            config = configuration(last, len(hist) - 1 - n)
            if n:
                config[n] = config.get(n, 0) + 1
            lengths = np.array(list(config))
            counts = np.array(list(config.values()), dtype=float)
            # as often as pieces are left, and no length by more than a step
            uses = np.minimum(np.maximum(STEP * total[lengths], counts), left[lengths]) / counts
            if len(uses) and uses.min() >= 1:
                times = uses.min()
                key = tuple(sorted(config.items(), reverse=True))
                plan[key] = plan.get(key, 0.0) + times
                left[lengths] -= counts * times
                weight[lengths] *= np.exp(-FALL * counts * times / total[lengths])
            else:               # more pieces of a length than there are
                weight[lengths[uses < 1]] *= np.exp(-FALL * STEP)
    return plan


class Plan:
    """Runs that tell every piece its place.

    A run (length, rank, seq, times, offset): the pieces of ``length`` from
    ``rank`` on, up to the next run, lie ``times`` to a sequence from ``seq``
    and ``offset`` on."""

    FIELDS = ("length", "rank", "seq", "times", "offset")

    def __init__(self, hist: np.ndarray, rounds: int = ROUNDS, columns: int = COLUMNS):
        self.window = len(hist) - 1
        self.left = hist.astype(np.int64).copy()
        self.used = np.zeros_like(self.left)
        self.runs: list[tuple] = []
        self.sequences = 0
        plan = solve(hist, rounds, columns)
        for config in sorted(plan, key=plan.get, reverse=True):
            self._use(config, min(int(plan[config] + 1e-9), *(int(self.left[n] // k) for n, k in config)))
        self.by_program = self.sequences
        self._longest_first()

    def _use(self, config, repeats: int) -> None:
        if repeats < 1:
            return
        offset = 0
        for n, k in config:
            self.runs.append((n, int(self.used[n]), self.sequences, k, offset))
            self.used[n] += k * repeats
            self.left[n] -= k * repeats
            offset += n * k
        self.sequences += repeats

    def _longest_first(self) -> None:
        while self.left.any():
            config, space = [], self.window
            left = self.left
            while len(fits := np.flatnonzero(left[:space + 1])):
                n = int(fits[-1])
                k = int(min(left[n], space // n))
                config.append((n, k))
                space -= n * k
                left = left[:n]          # shorter ones only
            # the same window again, as long as its lengths last
            self._use(config, int(min(self.left[n] // k for n, k in config)))

    def table(self) -> dict[str, np.ndarray]:
        a = np.array(self.runs, dtype=np.int64).reshape(-1, len(self.FIELDS))
        a = a[np.lexsort((a[:, 1], a[:, 0]))]
        return {f: a[:, i].copy() for i, f in enumerate(self.FIELDS)}


def look_up(table: dict, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces by length and rank within it."""
    key = table["length"] << 44 | table["rank"]
    i = np.searchsorted(key, length << 44 | rank, side="right") - 1
    k = rank - table["rank"][i]
    return table["seq"][i] + k // table["times"][i], table["offset"][i] + k % table["times"][i] * length


# ---------------------------------------------------------------- operator
def cut(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """``tokenized`` rows to pieces: doc_id, ``piece`` (from 0), ``start``,
    ``length`` and ``ids``."""
    rows = tokens.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / window).cast("int")))
                         .alias("piece"))
    start = F.col("piece").cast("long") * window
    return rows.select("doc_id", "piece", start.alias("start"),
                       F.least(F.lit(window).cast("long"), F.col("n") - start).alias("length"),
                       F.substring("ids", F.col("piece") * (4 * window) + 1, F.lit(4 * window)).alias("ids"))


def place(pieces: DataFrame, window: int = WINDOW, groups: int = GROUPS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, whatever columns they
    have beside ``length`` (1 to ``window``)."""
    spark = pieces.sparkSession
    ship(spark)
    cols = pieces.columns
    rows = scratch(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    hist = np.zeros(window + 1, dtype=np.int64)
    for n, count in rows.groupBy("length").count().collect():        # at most window rows
        hist[n] = count
    group_rows = max(GROUP_ROWS, -(-int(hist.sum()) // groups))
    salts = np.maximum(1, -(-hist // group_rows))
    salt = F.pmod(F.xxhash64("_row"), F.element_at(F.lit(salts.tolist()), F.col("length").cast("int") + 1))
    rows = rows.withColumn("_salt", salt)
    # at most window + groups rows
    held = np.array(sorted(tuple(r) for r in rows.groupBy("length", "_salt").count().collect()),
                    dtype=np.int64).reshape(-1, 3)
    upto = np.cumsum(held[:, 2]) - held[:, 2]
    # ranks before a group: those of its length's earlier salts
    first = np.searchsorted(held[:, 0], held[:, 0], side="left")
    before = upto - upto[first] if len(held) else upto
    groups = np.cumsum(salts) - salts                                # group number of (length, 0)
    rank_from = np.zeros(int(salts.sum()), dtype=np.int64)
    rank_from[groups[held[:, 0]] + held[:, 1]] = before
    shared = spark.sparkContext.broadcast((Plan(hist).table(), groups, rank_from))

    order = Window.partitionBy("length", "_salt").orderBy("_row")
    ranked = rows.withColumn("_rank", F.row_number().over(order) - 1).drop("_row")

    def assigned(batches):
        table, groups, rank_from = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            length, salt, rank = (batch.column(c).to_numpy().astype(np.int64) for c in ("length", "_salt", "_rank"))
            seq, offset = look_up(table, length, rank + rank_from[groups[length] + salt])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in cols], pa.array(seq), pa.array(offset)],
                                             names=[*cols, "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(assigned, f"{kinds}, sequence_id long, offset long")


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         end_id: int = END_ID, vocab: str = VOCAB, folder: str | None = None) -> DataFrame:
    """Per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids``
    (little-endian 32-bit), ``sequence_id`` and ``offset``."""
    return place(cut(tokenized(df, id_col, text_col, tokenizer_path(vocab, folder), end_id), window), window)


def digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The packing with a checksum of each piece's ids in their place, so no
    token is shuffled."""
    pieces = cut(tokenized(docs, "doc_id", "text", tokenizer_path(VOCAB), END_ID), window)
    return place(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), window)
