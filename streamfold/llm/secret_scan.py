"""Secret scanning: fixed patterns, and a guess-cost estimate of passwords.

Base kinds are the fixed patterns ``assign``, ``access`` and ``hex``.  The
method's own kind, ``guess``, looks at every value that stands in a credential
context (a credential word, then ``:``, ``=`` or ``is``, with any white space
around): in quotes the whole of what they hold, else up to white space or a
delimiter.  A dynamic program splits the value into dictionary words, dates,
repeats, keyboard walks and brute-force spans so that the guesses an attacker
needs are fewest (the least over all splits); a brute-force character costs the
size of the alphabet that the value uses.  A value that still costs at least
``MIN_GUESSES_LOG10`` is reported.  ``hunter2``, ``2024-01-01`` or
``qwertyuiop`` stay below it, ``x9$Lq!7v`` does not; nor, unless chance puts a
word or a walk there, do random values of 6 characters of both cases and digits,
of 7 of one case and digits, of 8 letters of one case, or of 10 digits.  Shorter
values cost less however random they are.

Dictionary words and their ranks come from the vocabulary file of a public
tokenizer (merge order, most frequent first), so no list is kept here.

Defined results: a null text counts as empty (no spans); positions count code
points, ends exclusive; a null id is kept; repeated rows give repeated
results; other columns are not read.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamfold.llm.common import ship, text_or_empty, tokenizer_path

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_VALUE = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")      # runs are whole, so 16+ characters
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "guess")

# Credential context of the method: a wider set of words and joints.  A value
# in quotes runs to the closing quote on its line, whatever is inside (a quote
# after a backslash does not close, unless no other does); any other value runs
# to white space, a quote, a bracket, a comma or a semicolon.
CONTEXT = re.compile(r"""(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|credentials?|api[_ -]?key)["']?"""
                     r"""(?:\s*[:=]\s*|\s+is\s+)"""
                     r"""(?:(?P<q>["'`])(?P<quoted>(?:\\.|(?!(?P=q))[^\\\r\n])++(?=(?P=q))"""
                     r"""|(?:(?!(?P=q))[^\r\n])++(?=(?P=q)))"""
                     r"""|["'`]?(?P<plain>[^\s"'`,;<>(){}\[\]]{4,}))""",
                     re.IGNORECASE | re.ASCII)
CONTEXT_WORDS = ("pass", "pwd", "pin", "secret", "token", "credential", "api")

MIN_GUESSES_LOG10 = 10.0
BRUTE_LOG10 = 1.0            # a brute-force character, if nothing is said of its alphabet: ten guesses
# What a character can be, by the classes that a value uses.
CLASSES = ((re.compile("[a-z]"), 26), (re.compile("[A-Z]"), 26), (re.compile("[0-9]"), 10),
           (re.compile(r"[ -/:-@\[-`{-~]"), 32), (re.compile(r"[^ -~]"), 100))
MAX_WORD = 24
LONGEST_PART = 32            # of words, dates and walks, and of a repeat's first two copies
FIRST_TRIED = 256            # characters of a long value that are tried first
# The rows of a keyboard, walked in either direction.
KEYBOARD = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
LEET = str.maketrans("4301$5@7", "aeolssat")
DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
                  r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)?\d\d"
                  r"|(?:19|20)\d\d")
DATE_LOG10 = math.log10(365 * 120)


def word_ranks(path: str) -> dict[str, int]:
    """Words of 3 letters and more in a word-end BPE vocabulary, by the order
    in which they were merged: word to rank from 1."""
    import json

    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    words = [w[:-4] for w, _ in sorted(vocab.items(), key=lambda x: x[1])
             if w.endswith("</w>") and len(w) >= 7 and w[:-4].isascii() and w[:-4].isalpha()]
    return {w: i for i, w in enumerate(words, 1)}


@lru_cache(maxsize=4)
def _ranks(path: str) -> dict[str, int]:
    return word_ranks(path)


def _walks(low: str):
    """(start, end) of maximal keyboard walks of 3 and more characters."""
    for row in KEYBOARD:
        for line in (row, row[::-1]):
            at = [line.find(c) for c in low]
            start = 0
            for i in range(1, len(low) + 1):
                if i == len(low) or at[i] < 0 or at[i - 1] < 0 or at[i] != at[i - 1] + 1:
                    if i - start >= 3 and at[start] >= 0:
                        yield start, i
                    start = i


def alphabet_log10(value: str) -> float:
    """log10 of the characters that a brute-force search of the classes in
    ``value`` tries at each place: 26 for one case, 36 with digits, 94 for all
    of ASCII."""
    return math.log10(sum(n for c, n in CLASSES if c.search(value)) or 1)


def guess_cost(value: str, ranks: dict[str, int], brute: float = BRUTE_LOG10,
               limit: float = math.inf) -> tuple[float, list[tuple[str, int, int]]]:
    """log10 of the guesses for a value, and the cheapest segmentation as
    (kind, start, end); a brute-force character costs ``brute``.  If no
    segmentation costs less than ``limit``, the result is infinity and no
    parts; a long value is tried on its beginning first, and given up where
    every state of that has reached the limit."""
    size = FIRST_TRIED
    while limit < math.inf and size < len(value):
        if not _segment(value[:size], ranks, brute, limit)[2]:
            return math.inf, []
        size *= 8
    return _segment(value, ranks, brute, limit)[:2]


def costs(value: str, ranks: dict[str, int], limit: float) -> bool:
    """Whether a value costs ``limit`` or more, with the brute-force cost of
    its own alphabet.  A value that repeats one short period as a whole costs
    no more than that period, its copies and what is left over."""
    brute = alphabet_log10(value)
    if len(value) > FIRST_TRIED:
        for size in range(1, 17):
            if value.startswith(value[size:]):
                copies, over = divmod(len(value), size)
                if size * brute + math.log10(copies) + over * brute + math.log10(2) < limit:
                    return False
                break
    return guess_cost(value, ranks, brute, limit)[0] >= limit


def _segment(value: str, ranks: dict[str, int], brute: float, limit: float):
    """The least cost, its segmentation, and whether a longer value that begins
    so could cost less than the limit.  A new part costs its place in the order
    of parts, so best[j] keeps, for the first j characters, every state (parts,
    whether the last is brute force) that no other is sure to beat."""
    n = len(value)
    # a lower-case letter for each character, so that spans keep their places
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain = low.translate(LEET)
    ends: dict[int, list[tuple[float, str, int]]] = {}

    def span(kind, i, j, cost):
        ends.setdefault(j, []).append((cost, kind, i))

    for i in range(n):
        for j in range(i + 3, min(n, i + MAX_WORD) + 1):
            word, rank = low[i:j], ranks.get(low[i:j])
            leet = rank is None and (rank := ranks.get(plain[i:j])) is not None
            if rank is not None:
                # the ways to write it: capitals first or anywhere, letters replaced
                upper = sum(c.isupper() for c in value[i:j])
                ways = 1 if not upper else 2 if value[i:j] in (word.capitalize(), word.upper()) else 2 ** min(upper, 8)
                span("word", i, j, math.log10(rank * ways * (4 if leet else 1) + 1))
    for i in range(n):
        # a longer date may hold a shorter one
        for j in range(i + 4, min(n, i + 10) + 1) if DATE.match(value, i) else ():
            if DATE.fullmatch(value, i, j):
                span("date", i, j, DATE_LOG10 if j - i > 4 else math.log10(200))
    for a, b in _walks(low):
        for i in range(a, b - 2):
            for j in range(i + 3, b + 1):
                span("walk", i, j, math.log10(2 * 47 * (j - i)))
    # maximal stretches that repeat with a period; every part of one of two
    # copies and more (three of one character) is a repeat
    runs: list[tuple[int, int, int]] = []
    for size in range(1, min(n // 2, 16) + 1):
        start = 0
        for i in range(size, n + 1):
            if i == n or value[i] != value[i - size]:
                # a stretch that repeats with a part of the period costs less so
                if i - start >= size * 2 and not any(size % s == 0 and a <= start and i <= e for s, a, e in runs):
                    runs.append((size, start, i))
                start = i - size + 1
    opened: dict[int, list[tuple[int, int, int]]] = {}
    for r in runs:
        opened.setdefault(r[1], []).append(r)
    # a state: cost, parts, kind of the last, its start, the state before it
    best: list[list[tuple]] = [[(0.0, 0, "", 0, None)]]
    least: dict[tuple[int, bool], tuple] = {}

    def put(cost, kind, i, before):
        more = kind != "brute" or before[2] != "brute"
        parts = before[1] + more
        total = before[0] + cost + (math.log10(parts) if more else 0)
        key = parts, kind != "brute"
        if total < limit and (key not in least or total < least[key][0]):
            least[key] = (total, parts, kind, i, before)
        return total

    # runs at this place, each with the states in which a repeat of it can start, by place in the period
    active: list[tuple[int, int, int, list[list[tuple]]]] = []
    for j in range(n + 1):
        if j:
            least.clear()
            for cost, kind, i in [(brute, "brute", j - 1), *ends.get(j, [])]:
                for before in best[i]:
                    put(cost, kind, i, before)
            for size, _, _, starts in active:
                fewest = 2 if size > 1 else 3
                # the cost grows with j, so a start that reaches the limit is done with
                starts[j % size] = [
                    (i, before) for i, before in starts[j % size] if (copies := (j - i) // size) < fewest
                    or put(size * brute + math.log10(copies), "repeat", i, before) < limit]
            kept, low, low_brute, low_next = [], math.inf, math.inf, math.inf
            for (parts, closed), state in sorted(least.items(), key=lambda x: x[0]):
                # a state beats any other of no fewer parts and no less cost, but one that ends
                # in brute force, and goes on without a new part, only with that part paid
                if state[0] < (low if closed else min(low_brute, low_next)):
                    kept.append(state)
                    low = min(low, state[0])
                    if closed:
                        low_next = min(low_next, state[0] + math.log10(parts + 1))
                    else:
                        low_brute = min(low_brute, state[0])
            best.append(kept)
        if j == n:
            reaches = any(any(r[3]) for r in active)
        active = [r for r in active if r[2] > j] + [(*r, [[] for _ in range(r[0])]) for r in opened.get(j, ())]
        for size, a, _, starts in active:
            # after a repeat that is one of this run too, the two are one
            starts[j % size] += [(j, s) for s in best[j]
                                 if s[2] != "repeat" or s[3] < a or (j - s[3]) % size or (j - s[3]) // size < 3]
    # a part that goes on past the end starts at a state near it, or is a repeat that has reached it
    open_end = reaches or any(best[-LONGEST_PART - 1:])
    if not best[n]:
        return math.inf, [], open_end
    state = last = min(best[n], key=lambda s: s[0])
    out, j = [], n
    while j:
        _, _, kind, i, before = state
        if kind == "brute" and out and out[-1][0] == "brute" and out[-1][1] == j:
            out[-1] = ("brute", i, out[-1][2])
        else:
            out.append((kind, i, j))
        state, j = before, i
    return last[0], out[::-1], open_end


def scan(text: str, ranks: dict[str, int], min_cost: float = MIN_GUESSES_LOG10) -> list[tuple[int, int, int, int]]:
    """All spans of a text as (start, kind number, end, start of the value),
    sorted."""
    spans = []
    low = text.lower()
    if any(w in low for w in CONTEXT_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_VALUE:
                spans.append((m.start(), 0, m.end(), m.start(2)))
        for m in CONTEXT.finditer(text):
            name = "plain" if m["quoted"] is None else "quoted"
            value, start = m[name].rstrip(".!?:") if name == "plain" else m[name], m.start(name)
            if len(value) >= 4 and costs(value, ranks, min_cost):
                spans.append((start, 3, start + len(value), start))
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(spans)


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_cost: float = MIN_GUESSES_LOG10,
         vocab: str = "word_bpe_49k.json", folder: str | None = None) -> DataFrame:
    """Per row: ``doc_id`` and ``found``, an array of (kind, start, end)."""
    ship(df.sparkSession)
    path = tokenizer_path(vocab, folder)

    @F.pandas_udf("array<struct<kind: string, start: long, end: long>>")
    def spans(texts: pd.Series) -> pd.Series:
        ranks = _ranks(path)
        return pd.Series([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b, _ in scan(t, ranks, min_cost)]
                          for t in texts], dtype=object)

    return df.select(F.col(id_col).alias("doc_id"), spans(text_or_empty(text_col)).alias("found"))


def mask(text: str, spans, sign: str = "[SECRET]") -> str:
    """The text with every value replaced; overlapping values are one."""
    out, end = [], 0
    for a, b in sorted((v, e) for _, _, e, v in spans):
        if a >= end:
            out += [text[end:a], sign]
        end = max(end, b)
    return "".join([*out, text[end:]])


def redact(df: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
           min_cost: float = MIN_GUESSES_LOG10, vocab: str = "word_bpe_49k.json",
           folder: str | None = None) -> DataFrame:
    """All rows and columns, the secrets in their texts masked; a column with
    the number of characters follows the text.  A null text stays null."""
    ship(df.sparkSession)
    path = tokenizer_path(vocab, folder)

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        ranks = _ranks(path)
        return pd.Series([t if t is None else mask(t, scan(t, ranks, min_cost)) for t in texts], dtype=object)

    # the length is changed where the text is, so a null or other count of a clean row stays
    clean = masked(F.col(text_col).cast("string"))
    if length_col is None or length_col not in df.columns:
        return df.withColumn(text_col, clean)
    names = [c for c in df.columns if c not in (text_col, length_col)]
    d = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(names)], F.col(text_col).alias("old"),
                  F.col(length_col).alias("n"), clean.alias("new"))
    kind = df.schema[length_col].dataType
    at = {c: F.col(f"k{i}").alias(c) for i, c in enumerate(names)}
    at[text_col] = F.col("new").alias(text_col)
    at[length_col] = F.when(F.col("old") == F.col("new"), F.col("n")).otherwise(
        F.coalesce(F.length("new").cast(kind), F.col("n"))).alias(length_col)
    return d.select(*[at[c] for c in df.columns])


def digests(docs: DataFrame, **options) -> DataFrame:
    """Counts of the base kinds, and the spans as text and as a digest."""
    found = find(docs, **options)
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    line = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", *[count(k) for k in KINDS],
                        F.sha2(line(F.filter("found", lambda s: s["kind"] != "guess")), 256).alias("base_sha256"),
                        line(F.col("found")).alias("spans"))
