"""Chat formatting: roles from raw transcripts by a hidden Markov model.

A transcript is a sequence of text blocks (conversation id, position, text)
without role labels.  A block holds one turn or many; some turns open with a
speaker marker (``User:``, ``### Assistant``, ``Q:``, ``<|user|>``), some have
none, and a line of a turn may look like a marker.  The hidden states are role
x (first line of a turn, later line); a transcript also has one hidden marker
style, which all its lines share.  A line emits its marker (of the transcript's
style or of another, with its role), its place (opens a block, after a blank
line, other), its length class and whether it ends with a question mark.
Viterbi finds the likeliest style and states; lines become turns, markers are
removed and turns are rendered canonically.

Parameters are frequencies in labelled turns, mixed with ``BACKGROUND`` parts
of the frequency in all states, so that what no state has shown favours none.
The labelled sample is bounded: about ``FIT_CONVERSATIONS`` conversations
chosen by hash, the first ``FIT_TURNS`` turns of each.

Features are Spark expressions.  One exchange sorts the blocks over ranges of
(id, position, text hash), so a long conversation lies in several partitions
one after another.  Viterbi is associative: a run of lines is a matrix of best
scores from its entry state to its exit state.  Each partition gives the
matrices of its first and its last conversation only; one small task joins
them up, two a partition whatever the input, and tells each partition the
states at its ends.  Partitions are then decided on their own, from the same
exchange.  Repeats of a block that has very many are grouped before, with
map-side aggregation.  A task holds one conversation's share of one partition (partitions
have about ``PART_CHARS`` characters).

Defined results: blocks of one conversation are ordered by position (null
first), then by the XXH64 of the text; exact repeats of a block in a
conversation count once; a null text counts as empty (one empty line); every
row with a null conversation id is a conversation of its own, repeats
included; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamfold.llm.common import ship, shuffle_partitions, sorted_groups, text_or_empty

ROLES = ("system", "user", "assistant")
STATES = [(r, first) for r in ROLES for first in (True, False)]
N = len(STATES)
HELD_OUT = (3, 1)           # crc32(id as text) mod 3 = 1
FIT_CONVERSATIONS = 2000
FIT_TURNS = 64
BACKGROUND = 0.01
PART_CHARS = 128 << 20
LINES_AT_ONCE = 20_000
ROWS_AT_ONCE = 2_000
HOT_ROWS = 100              # copies of one row from which it may be hot
HOT_SHARE = 1000

# Words that mark a speaker at the start of a line.
MARKERS = {
    "system": ("system", "instruction", "instructions", "context"),
    "user": ("user", "human", "question", "q", "me", "customer"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "agent", "model"),
}
STYLES = ("word", "heading", "letter", "tag")
_WORDS = "(?:" + "|".join(sorted((w for ws in MARKERS.values() for w in ws), key=len, reverse=True)) + ")"
MARKER = (rf"(?i)\A[ \t]*(?:#{{1,6}}[ \t]*{_WORDS}[ \t]*(?::|\z)|<\|?{_WORDS}\|?>:?|\[{_WORDS}\]:?"
          rf"|\*\*{_WORDS}(?::\*\*|\*\*[ \t]*:?)|{_WORDS}[ \t]*:)[ \t]?")
BLANKS = " \t\r\x0b\x0c"
LENGTHS = (0, 20, 60, 120, 200)          # characters without the marker: bounds of the length classes
N_LENGTHS = len(LENGTHS) + 1
N_MARKS = 1 + len(STYLES) * len(ROLES)   # none, then style x role
BLOCK, AFTER_BLANK, OTHER = range(3)     # places
N_CODES = N_MARKS * N_LENGTHS * 2 * 3
NEVER = -np.inf


# --------------------------------------------------------------- features
def features(text):
    """Array of (``e``, ``skip``) per line of a text: the feature code without
    its place, and the characters of the marker."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.struct(
        F.rtrim(x, F.lit(BLANKS)).alias("l"), F.regexp_extract(x, MARKER, 0).alias("m")))

    def code(s):
        m = s["m"]
        word = F.lower(F.regexp_replace(m, "[^A-Za-z]", ""))
        style = (F.when(m.contains("#"), STYLES.index("heading"))
                 .when(m.contains("<") | m.contains("["), STYLES.index("tag"))
                 .when(F.length(word) == 1, STYLES.index("letter")).otherwise(STYLES.index("word")))
        role = (F.when(word.isin(*MARKERS["system"]), 0).when(word.isin(*MARKERS["user"]), 1).otherwise(2))
        mark = F.when(m == "", 0).otherwise(1 + style * len(ROLES) + role)
        bare = F.length(s["l"]) - F.length(m)
        size = sum(((bare > b).cast("int") for b in LENGTHS), F.lit(0))
        return (mark * N_LENGTHS + size) * 2 + s["l"].endswith("?").cast("int")

    return F.transform(lines, lambda s: F.struct(code(s).cast("int").alias("e"), F.length(s["m"]).alias("skip")))


def placed(codes: np.ndarray) -> np.ndarray:
    """Codes of one block's lines with their places."""
    place = np.full(len(codes), OTHER)
    place[1:][codes[:-1] < 2] = AFTER_BLANK         # no marker, length class 0
    place[:1] = BLOCK
    return codes.astype(np.int64) * 3 + place


# ------------------------------------------------------------------ model
@dataclass
class Model:
    """Log probabilities: start (states), step (states x states), emit
    (styles x states x feature codes)."""

    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray


def _mixed(seen: np.ndarray) -> np.ndarray:
    """Log frequencies along the last axis, mixed with those of all rows."""
    rest = seen.sum(axis=0) + 1
    total = np.maximum(seen.sum(axis=-1, keepdims=True), 1)
    own = np.where(seen.sum(axis=-1, keepdims=True) > 0, seen / total, rest / rest.sum())
    return np.log((1 - BACKGROUND) * own + BACKGROUND * rest / rest.sum())


def held_out(id_col: str = "conv_id"):
    mod, left = HELD_OUT
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod == left, F.lit(False))


def _count(t: pa.Table) -> np.ndarray:
    """Counts over one conversation's turns in order: starts, steps, and
    emissions (states x marker relative to the style x place, length, mark)."""
    start, step = np.zeros(N), np.zeros((N, N))
    turns = [np.array(x, dtype=np.int64) for x in t["e"].to_pylist()]
    roles, pos = t["role"].to_pylist(), t["pos"].to_pylist()
    marks = [int(x[0]) // (2 * N_LENGTHS) for x in turns]
    style = np.bincount([(m - 1) // len(ROLES) for m in marks if m], minlength=len(STYLES)).argmax()
    marker, size, question = np.zeros((N, 7 * 3)), np.zeros((N, N_LENGTHS)), np.zeros((N, 2))
    start[2 * roles[0]] = 1
    at, block = [], []
    for i, (codes, role) in enumerate(zip(turns, roles)):
        at += [2 * role] + [2 * role + 1] * (len(codes) - 1)
        block.append(codes)
        if i + 1 < len(turns) and pos[i + 1] == pos[i]:
            continue
        e = placed(np.concatenate(block))
        s = np.array(at[-len(e):])
        np.add.at(marker, (s, _relative(e // (6 * N_LENGTHS), style) * 3 + e % 3), 1)
        np.add.at(size, (s, e // 6 % N_LENGTHS), 1)
        np.add.at(question, (s, e // 3 % 2), 1)
        block = []
    np.add.at(step, (at[:-1], at[1:]), 1)
    return np.concatenate([x.ravel() for x in (start, step, marker, size, question)])


def _relative(mark, style: int):
    """0 for no marker, 1 + role for the style's own, 4 + role for another."""
    role = (mark - 1) % len(ROLES)
    return np.where(mark == 0, 0, np.where((mark - 1) // len(ROLES) == style, 1 + role, 4 + role))


def fit(turns: DataFrame, id_col: str = "conv_id", block_col: str = "block", pos_col: str = "turn",
        text_col: str = "text", role_col: str = "role") -> Model:
    """The model of labelled turns: raw text, role, order and the block each
    is in.  Turns with another role, without an id or of held-out conversations
    are left out."""
    ship(turns.sparkSession)
    number = F.array_position(F.array(*map(F.lit, ROLES)), F.col(role_col)).cast("int") - 1
    known = (turns.filter(F.col(role_col).isin(*ROLES) & F.col(id_col).isNotNull() & ~held_out(id_col))
             .select(F.col(id_col).alias("conv"), F.col(block_col).alias("pos"), F.col(pos_col).alias("turn"),
                     number.alias("role"), text_or_empty(text_col).alias("text")))
    n = known.agg(F.approx_count_distinct("conv").alias("n")).first()["n"]
    share = min(1.0, FIT_CONVERSATIONS / max(n, 1))
    order = Window.partitionBy("conv").orderBy("turn", "tie", "role")
    sample = (known.filter(F.pmod(F.xxhash64("conv", F.lit("fit")), F.lit(1 << 20)) < int(share * (1 << 20)))
              .select("conv", "pos", "turn", "role", F.xxhash64("text").alias("tie"),
                      features(F.col("text"))["e"].alias("e"))
              .withColumn("no", F.row_number().over(order)).filter(F.col("no") <= FIT_TURNS)
              .select("conv", "no", "pos", "role", "e").withColumn("deal", F.xxhash64("conv"))
              .repartition(shuffle_partitions(turns.sparkSession), "deal")
              .sortWithinPartitions("deal", "conv", "no"))

    def run(batches):
        total = None
        for t in sorted_groups(batches, ["deal", "conv"]):
            c = _count(t)
            total = c if total is None else total + c
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["c"])

    sizes = (N, N * N, N * 21, N * N_LENGTHS, N * 2)
    total = np.zeros(sum(sizes))
    for r in sample.mapInArrow(run, "c array<double>").collect():       # one row of fixed length a partition
        total += np.array(r["c"])
    start, step, marker, size, question = np.split(total, np.cumsum(sizes)[:-1])
    return model_of(start, step.reshape(N, N), marker.reshape(N, 21), size.reshape(N, N_LENGTHS),
                    question.reshape(N, 2))


def model_of(start, step, marker, size, question) -> Model:
    # a transcript starts with a first line, and a later line has the role of the line before it
    may = np.array([[first or a == b for b, first in STATES] for a, _ in STATES])
    opens = np.array([first for _, first in STATES])
    with np.errstate(divide="ignore"):
        log_start = np.log((start + 1) * opens / ((start + 1) * opens).sum())
        step = (step + 1) * may
        log_step = np.log(step / step.sum(axis=1, keepdims=True))
    marker, size, question = _mixed(marker), _mixed(size), _mixed(question)
    e = np.arange(N_CODES)
    own = [marker[:, _relative(e // (6 * N_LENGTHS), s) * 3 + e % 3] for s in range(len(STYLES))]
    return Model(log_start, log_step, np.stack(own) + size[:, e // 6 % N_LENGTHS] + question[:, e // 3 % 2])


# ---------------------------------------------------------------- viterbi
def matrix_of(codes: np.ndarray, m: Model) -> np.ndarray:
    """Per style, the best score from entry state to exit state over lines;
    the entry state's emission is counted."""
    score = np.full((len(STYLES), N, N), NEVER)
    k = np.arange(N)
    score[:, k, k] = m.emit[:, :, codes[0]]
    for e in codes[1:]:
        score = (score[:, :, :, None] + m.step).max(axis=2) + m.emit[:, None, :, e]
    return score


def ends_of(parts: list[np.ndarray], m: Model) -> list[tuple[int, int, int]]:
    """Style, entry and exit state of consecutive runs on the best path of the
    whole conversation; ties go to the smaller style, then state."""
    score = [(m.start[None, :, None] + parts[0])]           # style, entry, exit
    via = []
    for p in parts[1:]:
        through = score[-1].max(axis=1)[:, :, None] + m.step
        via.append(through.argmax(axis=1))                  # the exit before, by entry
        score.append(through.max(axis=1)[:, :, None] + p)
    style, a, b = np.unravel_index(int(score[-1].argmax()), score[-1].shape)
    out = [(int(style), int(a), int(b))]
    for i in range(len(parts) - 1, 0, -1):
        b = via[i - 1][style, a]
        a = score[i - 1][style, :, b].argmax()
        out.append((int(style), int(a), int(b)))
    return out[::-1]


def viterbi(codes: np.ndarray, m: Model, ends: tuple[int, int, int] | None = None) -> np.ndarray:
    """States of the lines; ``ends`` fixes the style and both ends."""
    style, entry, leave = ends or (None, None, None)
    emit = m.emit if style is None else m.emit[style:style + 1]
    score = emit[:, :, codes[0]] + (m.start if entry is None else np.where(np.arange(N) == entry, 0.0, NEVER))
    back = np.zeros((len(codes), len(emit), N), dtype=np.int8)
    for i, e in enumerate(codes[1:], 1):
        through = score[:, :, None] + m.step
        back[i] = through.argmax(axis=1)
        score = through.max(axis=1) + emit[:, :, e]
    if leave is None:
        style, at = np.unravel_index(int(score.argmax()), score.shape)
    else:
        style, at = 0, leave
    states = np.zeros(len(codes), dtype=np.int8)
    states[-1] = at
    for i in range(len(codes) - 1, 0, -1):
        states[i - 1] = at = back[i, style, at]
    return states


def viterbi_many(codes: list[np.ndarray], m: Model) -> list[np.ndarray]:
    """``viterbi`` of many conversations, line by line for all at once, those
    of like length together."""
    size = np.array([len(c) for c in codes])
    order = np.argsort(size, kind="stable")
    out: list = [None] * len(codes)
    a = 0
    while a < len(order):
        # as many as fit a table of LINES_AT_ONCE cells, the longest last
        b = a + 1
        while b < len(order) and (b + 1 - a) * size[order[b]] <= LINES_AT_ONCE:
            b += 1
        which = order[a:b]
        n, longest = size[which], size[which[-1]]
        table = np.zeros((len(which), longest), dtype=np.int64)
        table[np.arange(longest) < n[:, None]] = np.concatenate([codes[k] for k in which])
        emit = m.emit.transpose(2, 0, 1)                            # code, style, state
        score = emit[table[:, 0]] + m.start
        back = np.zeros((longest, *score.shape), dtype=np.int8)
        lives = np.searchsorted(n, np.arange(longest), side="right")   # the first with more lines
        for i in range(1, longest):
            k = lives[i]
            through = score[k:, :, :, None] + m.step
            back[i, k:] = through.argmax(axis=2)
            score[k:] = through.max(axis=2) + emit[table[k:, i]]
        style, at = np.divmod(score.reshape(len(which), -1).argmax(axis=1), N)
        states = np.zeros((len(which), longest), dtype=np.int8)
        states[np.arange(len(which)), n - 1] = at
        for i in range(longest - 1, 0, -1):
            k = np.arange(lives[i], len(which))
            at[k] = back[i, k, style[k], at[k]]
            states[k, i - 1] = at[k]
        for k, row, x in zip(which, states, n):
            out[k] = row[:x]
        a = b
    return out


# --------------------------------------------------------------- decoding
def _ready(df: DataFrame) -> tuple[DataFrame, int]:
    """Rows without the repeats of the hottest ones, so that no group of copies
    is more than a ``HOT_SHARE``-th of a range exchange, and its partitions."""
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("text").cast("long")).alias("chars")).first()
    parts = max(shuffle_partitions(df.sparkSession), math.ceil((size["chars"] or 0) / PART_CHARS))
    key = F.xxhash64(*df.columns)
    many = (df.groupBy(key.alias("h")).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > max(HOT_ROWS, size["rows"] // HOT_SHARE)))
    hot = [r["h"] for r in many.select("h").collect()]         # fewer than HOT_SHARE
    if hot:
        df = df.filter(~key.isin(hot)).unionByName(df.filter(key.isin(hot)).distinct())
    return df, parts


def _changes(t: pa.Table, names: list[str]) -> np.ndarray:
    """Whether a row differs from the row before it; nulls are equal."""
    change = np.zeros(t.num_rows - 1, dtype=bool)
    for c in names:
        col = t[c].combine_chunks()
        a, b = col.slice(0, len(col) - 1), col.slice(1)
        same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
        change |= ~same.to_numpy(zero_copy_only=False)
    return change


def _distinct(rows: DataFrame) -> DataFrame:
    """Sorted rows without repeats."""

    def run(batches):
        last = None
        for b in batches:
            if b.num_rows == 0:
                continue
            t = pa.Table.from_batches([b])
            change = _changes(t if last is None else pa.concat_tables([last, t]), t.column_names)
            last = t.slice(t.num_rows - 1)
            yield from t.filter(pa.array(np.append(True, change)[-t.num_rows:])).to_batches()

    return rows.mapInArrow(run, rows.schema)


def _codes(t: pa.Table) -> list[np.ndarray]:
    """Placed codes of each block of a table."""
    col = t["e"].combine_chunks()
    ends = np.cumsum(col.value_lengths().to_numpy())
    return [placed(x) for x in np.split(col.flatten().to_numpy(), ends[:-1])]


def _runs(t: pa.Table, codes: list[np.ndarray], states: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """One row per block and run of lines of one turn."""
    block, line, role, opens, text = [], [], [], [], []
    at = 0
    skips = t["skip"].combine_chunks()
    for i, (raw, c) in enumerate(zip(t["text"].to_pylist(), codes)):
        lines, s = raw.split("\n"), states[at:at + len(c)]
        at += len(c)
        starts = np.union1d([0], np.flatnonzero(s % 2 == 0)).tolist()
        for a, b in zip(starts, [*starts[1:], len(lines)]):
            part = lines[a:b]
            mark = int(c[a]) // (6 * N_LENGTHS)
            if s[a] % 2 == 0 and mark and (mark - 1) % len(ROLES) == s[a] // 2:
                part[0] = part[0][skips[i][a].as_py():]
                if not part[0].strip() and len(part) > 1:
                    part = part[1:]                     # the marker had a line of its own
            while len(part) > 1 and not part[-1].strip():
                part.pop()
            block.append(i)
            line.append(a)
            role.append(ROLES[s[a] // 2])
            opens.append(bool(s[a] % 2 == 0))
            text.append("\n".join(part))
    cols = [t[c].combine_chunks().take(pa.array(block, pa.int64())) for c in ("conv", "pos", "tie")]
    return pa.RecordBatch.from_arrays(
        [*cols, pa.array(line, pa.int32()), pa.array(role, pa.string()), pa.array(opens, pa.bool_()),
         pa.array(text, pa.string())], names=names)


def decode(dealt: DataFrame, alone: DataFrame, model: Model) -> DataFrame:
    """Blocks (``conv``, ``pos``, ``tie``, ``text``) to runs.  ``dealt`` lies in
    ranges of (conv, pos, tie) and is sorted within them; the rows of ``alone``
    are conversations of their own.  Sorting and repeats are kept inside tasks
    after the exchange, so no later exchange can deal the ranges anew."""
    ship(dealt.sparkSession)
    shared = dealt.sparkSession.sparkContext.broadcast(model)       # fixed size
    f = features(F.col("text"))
    dealt = dealt.withColumn("pid", F.spark_partition_id()).withColumn("f", f) \
        .select("pid", "conv", "pos", "tie", "text", F.col("f")["e"].alias("e"), F.col("f")["skip"].alias("skip"))
    kind = dict(dealt.dtypes)

    def summaries(batches):
        """The matrices of the first and the last conversation."""
        m, pid, conv, held, done = shared.value, None, None, [], 0

        def row(part):
            return pa.RecordBatch.from_arrays(
                [pa.array([pid], pa.int32()), pa.array([part], pa.int32()), conv,
                 pa.array([matrix_of(np.concatenate([c for x in held for c in _codes(x)]), m).ravel().tolist()],
                          pa.list_(pa.float64()))], names=["pid", "part", "conv", "m"])

        for t in batches:
            if t.num_rows == 0:
                continue
            t = pa.Table.from_batches([t])
            pid = t["pid"][0].as_py()
            ids = t["conv"].combine_chunks()
            named = ids.to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(named[1:] != named[:-1]) + 1).tolist(), t.num_rows]
            # the second shows that the first has ended; those between it and the batch's last are not needed
            for a, b in [(cuts[i], cuts[i + 1]) for i in sorted({0, min(1, len(cuts) - 2), len(cuts) - 2})]:
                if conv is not None and conv[0].as_py() != ids[a].as_py():
                    if done == 0:
                        yield row(0)
                    done, held = done + 1, []
                conv = ids.slice(a, 1)
                held.append(t.select(["e"]).slice(a, b - a))
        if held:
            yield row(1)            # 0 rows of part 0: the whole partition is one conversation

    def joined(batches):
        """Per partition, style and end states of its first and last
        conversation; two matrices a partition come in, in order."""
        m, rows = shared.value, [r for b in batches for r in b.to_pylist()]
        out: dict[int, dict[int, tuple]] = {}
        a = 0
        while a < len(rows):
            b = a + 1
            while b < len(rows) and rows[b]["conv"] == rows[a]["conv"]:
                b += 1
            parts = [np.array(r["m"]).reshape(len(STYLES), N, N) for r in rows[a:b]]
            for r, ends in zip(rows[a:b], ends_of(parts, m)):
                out.setdefault(r["pid"], {})[r["part"]] = ends
            a = b
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(out), pa.int32()),
                 pa.array([[*(p.get(0) or p[1]), *p[1]] for p in out.values()], pa.list_(pa.int32()))],
                names=["of", "ends"])

    cells = f"pid int, part int, conv {kind['conv']}, m array<double>"
    ends = (dealt.select("pid", "conv", "e").mapInArrow(summaries, cells)
            .repartition(1).sortWithinPartitions("pid", "part")           # two rows a partition
            .mapInArrow(joined, "of int, ends array<int>"))
    names = ["conv", "pos", "tie", "line", "role", "opens", "text"]
    schema = f"conv {kind['conv']}, pos {kind['pos']}, tie long, line int, role string, opens boolean, text string"

    def solved(groups: list):
        """(table, end states or None) of conversations to rows."""
        codes = [_codes(t) for t, _ in groups]
        inner = [i for i, (_, ends) in enumerate(groups) if ends is None]
        found = dict(zip(inner, viterbi_many([np.concatenate(codes[i]) for i in inner], shared.value)))
        states = [found[i] if ends is None else viterbi(np.concatenate(c), shared.value, ends)
                  for i, ((_, ends), c) in enumerate(zip(groups, codes))]
        if groups:
            yield _runs(pa.concat_tables([t for t, _ in groups]).combine_chunks(), [x for c in codes for x in c],
                        np.concatenate(states), names)

    def decided(batches):
        before, held, lines, first = None, [], 0, True
        for t in sorted_groups(batches, ["pid", "conv"]):
            if before is not None:
                if before["pid"][0] != t["pid"][0]:
                    raise RuntimeError("a task holds rows of two ranges")
                held.append((before, tuple(before["ends"][0].as_py()[:3]) if first else None))
                first, lines = False, lines + before.num_rows
                if lines > ROWS_AT_ONCE:
                    yield from solved(held)
                    held, lines = [], 0
            before = t
        if before is not None:
            yield from solved([*held, (before, tuple(before["ends"][0].as_py()[3:]))])

    def each(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            yield from solved([(t.slice(i, 1), None) for i in range(t.num_rows)])

    many = dealt.join(F.broadcast(ends), F.col("pid") == F.col("of")).mapInArrow(decided, schema)
    single = (alone.withColumn("f", f).select("conv", "pos", "tie", "text", F.col("f")["e"].alias("e"),
                                              F.col("f")["skip"].alias("skip")).mapInArrow(each, schema))
    return (many.unionByName(single).withColumnRenamed("conv", "conv_id")
            .withColumn("rendered", F.when(F.col("opens"), F.concat(F.lit("<|turn|>"), "role", F.lit("\n"), "text"))
                        .otherwise(F.concat(F.lit("\n"), "text"))))


def format_chat(blocks: DataFrame, model: Model, id_col: str = "conv_id", pos_col: str = "turn",
                text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Per block and run of lines of one turn: ``conv_id``, ``pos``, ``tie``
    (XXH64 of the block), ``line`` (number of the run's first line), ``role``,
    ``opens`` (false: goes on with the turn before it), ``text`` and
    ``rendered``.  The rows of a conversation in the order of (pos, tie, line),
    put together, are its canonical form; blank lines at the end of a run go."""
    b = blocks.select(F.col(id_col).alias("conv"), F.col(pos_col).cast("long").alias("pos"),
                      text_or_empty(text_col).alias("text"))
    key = F.xxhash64("text").alias("tie")
    known, n = _ready(b.filter("conv is not null"))
    dealt = (known.select("conv", "pos", key, "text").repartitionByRange(parts or n, "conv", "pos", "tie")
             .sortWithinPartitions("conv", "pos", "tie", "text"))
    return decode(_distinct(dealt), b.filter("conv is null").select("conv", "pos", key, "text"), model)


# ------------------------------------- stand-in over `conversations`
def raw_turns(conversations: DataFrame, id_col: str = "conv_id", pos_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """The turns of ``conversations`` as they stand in raw transcripts:
    ``conv_id``, ``block`` (its first turn's number), ``turn``, ``role``,
    ``text``.  By conversation, one of four marker styles, one to eight turns a block, and in every other one a
    blank line after each turn.  One turn in six has no marker, where a block
    or a blank line shows its start; one in eight has a last line that looks
    like a marker of another style.  A turn without a position is a block of
    its own."""
    def pick(salt: str, n: int, *cols):
        return F.pmod(F.crc32(F.concat_ws(":", F.lit(salt), *[F.col(c).cast("string") for c in cols])), F.lit(n))

    style, spaced = pick("style", 4, id_col), pick("blank", 2, id_col) == 0
    size = 1 + pick("size", 8, id_col)
    user = F.col(role_col) == "user"
    role = F.coalesce(F.col(role_col), F.lit(""))
    marks = (F.when(style == 0, F.concat(F.initcap(role), F.lit(": ")))
             .when(style == 1, F.concat(F.lit("### "), F.when(user, "Human").otherwise(F.initcap(role)), F.lit(":\n")))
             .when(style == 2, F.when(user, "Q: ").when(F.col(role_col) == "assistant", "A: ").otherwise("Context: "))
             .otherwise(F.concat(F.lit("<|"), role, F.lit("|> "))))
    opens = F.col(pos_col) % size == 0
    bare = (F.col(pos_col) > 0) & (spaced | opens) & (pick("bare", 6, id_col, pos_col) == 0)
    odd = F.when(style == 2, "\nUser: a name in the second table").otherwise("\nA: the first of three answers")
    text = F.concat(F.when(bare, "").otherwise(marks), text_or_empty(text_col),
                    F.when(pick("odd", 8, id_col, pos_col) == 0, odd).otherwise(""), F.when(spaced, "\n").otherwise(""))
    return conversations.select(F.col(id_col).alias("conv_id"),
                                F.try_subtract(F.col(pos_col).cast("long"), F.pmod(F.col(pos_col), size)).alias("block"),
                                F.col(pos_col).cast("long").alias("turn"), F.col(role_col).alias("role"),
                                text.alias("text"))


def _transcripts(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw turns joined to blocks, dealt as ``decode`` takes them: those of
    known conversations, and the others, one turn each."""
    known, n = _ready(turns.filter("conv_id is not null")
                      .select(F.col("conv_id").alias("conv"), F.col("block").alias("pos"), "turn", "text"))
    own = F.when(F.col("pos").isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    dealt = (known.withColumn("tie", own).repartitionByRange(n, "conv", "pos", "tie")
             .sortWithinPartitions("conv", "pos", "tie", "turn", "text"))

    def joined(batches):
        for t in sorted_groups(batches, ["conv"]):
            cuts = [0, *(np.flatnonzero(_changes(t, ["pos", "tie"])) + 1).tolist(), t.num_rows]
            lines = t["text"].to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*(t[c].combine_chunks().take(pa.array(cuts[:-1])) for c in ("conv", "pos", "tie")),
                 pa.array(["\n".join(lines[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.string())],
                names=["conv", "pos", "tie", "text"])

    kind = dict(dealt.dtypes)
    dealt = _distinct(dealt).mapInArrow(joined, f"conv {kind['conv']}, pos long, tie long, text string")
    alone = turns.filter("conv_id is null").select(F.col("conv_id").alias("conv"), F.col("block").alias("pos"),
                                                   F.xxhash64("text").alias("tie"), "text")
    return dealt, alone


def transcripts(turns: DataFrame) -> DataFrame:
    """Raw turns joined to blocks: ``conv_id``, ``turn`` (the block's number)
    and ``text``."""
    dealt, alone = _transcripts(turns)
    return dealt.unionByName(alone).select(F.col("conv").alias("conv_id"), F.col("pos").alias("turn"), "text")


def over_conversations(conversations: DataFrame) -> DataFrame:
    turns = raw_turns(conversations)
    return decode(*_transcripts(turns), fit(turns))
