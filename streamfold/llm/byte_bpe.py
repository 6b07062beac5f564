"""Byte-level BPE encoding and decoding by DuckDB queries inside each task.

Spark deals the documents out; each task splits its texts into pre-tokens and
runs a recursive query over the distinct ones: token-position rows join the
merge table, every word contracts its leftmost pair of minimum rank, and words
without a pair left leave the recursion.  Decoding joins token rows with the
vocabulary and puts the bytes together with an ordered aggregation.

A pre-token that is itself in the vocabulary is one token (as in the tiktoken
library).  Of the ways to cut a token in two, plain merging can only meet one,
so the merge table holds that one.  A recursion step costs the live rows: short
pre-tokens contract one pair a step; those over ``SHORT_BYTES`` contract every
occurrence of their least pair in a step, from the left, which is the same where
no merge makes a pair of lower rank (``orderly``, checked on the table; without
it they too contract one at a time).

Defined results: a null text counts as empty (no ids, empty bytes); null ids
decode to empty bytes; a null row id is kept; an unknown or null token id raises;
repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamfold.llm.common import ship, text_or_empty, tokenizer_path

RANKS = "byte_bpe_50k.tiktoken"
SHORT_BYTES = 255            # the position takes the low 8 bits of a row's key, the last one stays free
LONG_PER_QUERY = 500_000     # bytes of long pre-tokens in one recursion
WORK_PER_QUERY = 2_000_000   # sum of squared pre-token lengths: bounds the rows of one recursion
CHUNK_BYTES = 4_000_000
CHUNK_TOKENS = 200_000
CACHE_WORDS = 1_000_000      # distinct pre-tokens a worker remembers before it starts afresh
LATIN = 0x180                # below it, the pattern is written out for Python's own matcher

# A row: key (word * 256 + position), token t, the next token n, the rank r of
# that pair.  bp is the position of the word's best pair, m its merged token and
# n2 the token after it; ranks are looked up again for the two changed rows.
ENCODE_SQL = """
WITH RECURSIVE cur(k, t, n, r, fin) AS (
    SELECT k, t, n, m.rank, false FROM start_rows LEFT JOIN merges m ON m.pair = t::BIGINT * 65536 + n
  UNION ALL
    (WITH live AS (SELECT k, t, n, r FROM cur WHERE NOT fin),
          best AS (SELECT k // 256 AS w, min(r::BIGINT * 256 + k % 256) AS b FROM live WHERE r IS NOT NULL GROUP BY 1),
          pair AS (SELECT w, b % 256 AS bp, (b // 256)::INT AS m, l.n AS n2
                   FROM best JOIN live l ON l.k = w * 256 + b % 256 + 1),
          moved AS (SELECT CASE WHEN k % 256 > bp THEN k - 1 ELSE k END AS k,
                           CASE WHEN k % 256 = bp THEN m ELSE t END AS t,
                           CASE WHEN k % 256 = bp THEN n2 WHEN k % 256 = bp - 1 THEN m ELSE n END AS n,
                           r, coalesce(k % 256 IN (bp, bp - 1), false) AS changed, bp IS NULL AS fin
                    FROM live LEFT JOIN pair ON w = k // 256
                    WHERE bp IS NULL OR k % 256 <> bp + 1)
     SELECT k, t, n, CASE WHEN changed THEN m.rank ELSE r END, fin
     FROM moved LEFT JOIN merges m ON m.pair = CASE WHEN changed THEN t::BIGINT * 65536 + n END)
)
SELECT (k // 256)::INT AS w, t FROM cur WHERE fin ORDER BY k
"""

# A row: key (word * 2^32 + position), x the key of the next row.  ``hit`` holds
# the pairs to contract: every occurrence of the word's least rank, of a chain
# of overlapping ones the 1st, 3rd, ...; if merges are not orderly, the first.
LONG_SQL = """
WITH RECURSIVE cur(k, x, t, n, r, fin) AS (
    SELECT k, x, t, n, m.rank, false FROM start_rows LEFT JOIN merges m ON m.pair = t::BIGINT * 65536 + n
  UNION ALL
    (WITH live AS (SELECT k, x, t, n, r FROM cur WHERE NOT fin),
          least AS (SELECT k >> 32 AS w, min(r) AS m FROM live WHERE r IS NOT NULL GROUP BY 1),
          found AS (SELECT k, x, m, (lag(x) OVER (ORDER BY k) IS DISTINCT FROM k)::INT AS head
                    FROM live JOIN least ON w = k >> 32 AND r = m),
          chain AS (SELECT k, x, m, sum(head) OVER (ORDER BY k) AS c FROM found),
          hit AS (SELECT k, x, m FROM chain QUALIFY row_number() OVER (PARTITION BY {part} ORDER BY k) {pick}),
          pair AS (SELECT h.k, h.m, l.x, l.n FROM hit h JOIN live l ON l.k = h.x),
          moved AS (SELECT l.k, CASE WHEN p.k IS NULL THEN l.x ELSE p.x END AS x, coalesce(p.m, l.t) AS t,
                           CASE WHEN p.k IS NULL THEN l.n ELSE p.n END AS n, l.r, p.k IS NOT NULL AS changed, w IS NULL AS fin
                    FROM live l LEFT JOIN least ON w = l.k >> 32 LEFT JOIN pair p ON p.k = l.k
                    WHERE l.k NOT IN (SELECT x FROM hit)),
          linked AS (SELECT a.k, a.x, a.t, coalesce(g.m, a.n) AS n, r, changed OR g.k IS NOT NULL AS changed, fin
                     FROM moved a LEFT JOIN hit g ON g.k = a.x)
     SELECT k, x, t, n, CASE WHEN changed THEN m.rank ELSE r END, fin
     FROM linked LEFT JOIN merges m ON m.pair = CASE WHEN changed THEN t::BIGINT * 65536 + n END)
)
SELECT (k >> 32)::INT AS w, t FROM cur WHERE fin ORDER BY k
"""
EVERY = {"part": "c", "pick": "% 2 = 1"}
FIRST = {"part": "k >> 32", "pick": "= 1"}

DECODE_SQL = """
SELECT d, unhex(string_agg(h, '' ORDER BY p)) AS bytes, count(*) AS n
FROM token_rows JOIN vocab USING (t) GROUP BY d ORDER BY d
"""


def latin_pattern(pattern: str) -> str | None:
    """The pattern with its Unicode classes written out for code points below
    ``LATIN``; None if it uses others than letters, numbers and white space."""
    chars = list(map(chr, range(LATIN)))
    kind = {r"\p{L}": [c for c in chars if unicodedata.category(c)[0] == "L"],
            r"\p{N}": [c for c in chars if unicodedata.category(c)[0] == "N"],
            r"\s": list("\t\n\x0b\x0c\r \x85\xa0")}
    sets = {k: "".join(f"\\x{ord(c):02x}" if ord(c) < 256 else c for c in v) for k, v in kind.items()}
    out = re.sub(r"\[\^((?:\\s|\\p\{[LN]\})+)\]",
                 lambda m: "[^" + "".join(sets[x] for x in re.findall(r"\\s|\\p\{[LN]\}", m[1])) + "]", pattern)
    for k, v in sets.items():
        out = out.replace(k, f"[{v}]")
    out = out.replace(r"\S", f"[^{sets[chr(92) + 's']}]")
    return None if re.search(r"\\[pPswdWDb]", out) else out


class Numbers(dict):
    """Pre-tokens to numbers, in the order in which they were first asked."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class Bpe:
    """A rank file, its merge table and a DuckDB connection of this process."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        if max(self.ranks.values(), default=0) >= 65536:
            raise ValueError("token ids over 65535 do not fit the pair key")
        self.any_split = regex.compile(pattern).findall
        latin = latin_pattern(pattern)
        self.latin_split = re.compile(latin).findall if latin else self.any_split
        self.beyond = re.compile(f"[^\0-{chr(LATIN - 1)}]").search
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        pairs, merged = [], []
        self.orderly = True
        for token, rank in self.ranks.items():
            if (last := self._last_pair(token, rank)) is not None:
                pairs.append(last[0] * 65536 + last[1])
                merged.append(rank)
                self.orderly &= all(i < rank or i < 256 for i in last)
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "300MB"})
        self.con.execute("SET temp_directory = ''")
        self._table("merges", pair=pa.array(pairs, pa.int64()), rank=pa.array(merged, pa.int32()))
        self._table("vocab", t=pa.array(self.ranks.values(), pa.int32()),
                    h=pa.array([b.hex() for b in self.ranks], pa.string()))
        self._forget()

    def _forget(self) -> None:
        # the ids of pre-token number i are flat[first[i]:first[i + 1]]
        self.numbers = Numbers()
        self.flat, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def split(self, text: str) -> list[str]:
        if text.isascii() or not self.beyond(text):
            return self.latin_split(text)
        return self.any_split(text)

    def _table(self, name: str, **cols) -> None:
        self.con.register("given", pa.table(cols))
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def _query(self, name: str, cols: dict, sql: str) -> pa.Table:
        self.con.register(name, pa.table(cols))
        try:
            return self.con.sql(sql).to_arrow_table()
        finally:
            self.con.unregister(name)

    def _last_pair(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens that merging makes of a token before it is whole."""
        parts = [self.ranks[token[i:i + 1]] for i in range(len(token))]
        ends = list(range(1, len(token) + 1))
        while len(parts) > 2:
            starts = [0, *ends]
            least = min((r, i) for i in range(len(parts) - 1)
                        if (r := self.ranks.get(token[starts[i]:ends[i + 1]], 1 << 30)) is not None)
            if least[0] == 1 << 30:
                return None                 # never met: pre-tokens that are tokens are not merged
            parts[least[1]:least[1] + 2] = [least[0]]
            del ends[least[1]]
        return tuple(parts) if len(parts) == 2 else None

    def merge_words(self, words: list[bytes], long: bool = False) -> list[np.ndarray]:
        """Token ids of pre-tokens, of at most ``SHORT_BYTES`` bytes unless
        ``long``."""
        size = np.array([len(w) for w in words], dtype=np.int64)
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        word = np.repeat(np.arange(len(words)), size)
        pos = np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size)
        t = self.byte_ids[raw]
        after = np.append(t[1:], -1).astype(np.int32)
        last = np.cumsum(size) - 1
        after[last] = -1
        if long:
            key = (word << 32) + pos
            x = key + 1
            x[last] = -1
            out = self._query("start_rows", {"k": key, "x": x, "t": t, "n": after},
                              LONG_SQL.format(**(EVERY if self.orderly else FIRST)))
        else:
            out = self._query("start_rows", {"k": word * 256 + pos, "t": t, "n": after}, ENCODE_SQL)
        ids = out["t"].to_numpy().astype(np.int32)
        ends = np.searchsorted(out["w"].to_numpy(), np.arange(1, len(words)), side="left")
        return np.split(ids, ends)

    def _learn(self, words: list[str]) -> None:
        """Add the ids of the next pre-tokens by number."""
        ids: list = [None] * len(words)
        short, long = [], []
        for i, w in enumerate(words):
            b = w.encode()
            if b in self.ranks:
                ids[i] = np.array([self.ranks[b]], dtype=np.int32)
            else:
                (long if len(b) > SHORT_BYTES else short).append((i, b))
        for group, sizes, limit in ((short, [len(b) ** 2 for _, b in short], WORK_PER_QUERY),
                                    (long, [len(b) for _, b in long], LONG_PER_QUERY)):
            for i, j in _runs(sizes, limit):
                part = group[i:j]
                for (at, _), merged in zip(part, self.merge_words([b for _, b in part], group is long)):
                    ids[at] = merged
        if ids:
            size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(size)])
            self.flat = np.concatenate([self.flat, *ids])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.numbers) > CACHE_WORDS:
            self._forget()
        known = len(self.numbers)
        number = self.numbers.__getitem__
        coded = [np.fromiter(map(number, self.split(t)), dtype=np.int64) for t in texts]
        self._learn(list(islice(self.numbers, known, None)))
        out = []
        for c in coded:
            n = self.first[c + 1] - self.first[c]
            at = np.repeat(self.first[c] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            out.append(self.flat[at])
        return out

    def decode(self, flat: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The bytes of each id list; ``flat`` holds the lists end to end.
        The queries take slices of ``flat``, whatever list they belong to, so
        a long list is put together from several."""
        out: list[list[bytes]] = [[] for _ in sizes]
        ends = np.cumsum(sizes)
        for a in range(0, len(flat), CHUNK_TOKENS):
            part = flat[a:a + CHUNK_TOKENS]
            pos = np.arange(a, a + len(part))
            got = self._query("token_rows", {"d": np.searchsorted(ends, pos, side="right"), "p": pos, "t": part},
                              DECODE_SQL)
            if got["n"].to_numpy().sum() != len(part):
                raise ValueError("a token id is not in the vocabulary")
            for d, b in zip(got["d"].to_pylist(), got["bytes"].to_pylist()):
                out[d].append(b)
        return [b"".join(x) for x in out]


_LOADED: dict[tuple, Bpe] = {}


def load(path: str, pattern: str) -> Bpe:
    key = (path, pattern)
    if key not in _LOADED:
        _LOADED[key] = Bpe(path, pattern)
    return _LOADED[key]


def _runs(sizes, limit: int):
    """(start, end) of consecutive items whose sizes add up to about limit."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS,
           folder: str | None = None, pattern: str | None = None, and_decode: bool = False) -> DataFrame:
    """Per row: ``doc_id`` and ``ids`` (array<int>); with ``and_decode`` also
    ``bytes``, decoded from the ids in the same task."""
    ship(df.sparkSession)
    path, pat = tokenizer_path(ranks, folder), pattern or _pattern()
    d = df.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    schema = f"doc_id {d.schema['doc_id'].dataType.simpleString()}, ids array<int>" + ", bytes binary" * and_decode

    def run(batches):
        bpe = load(path, pat)
        for batch in batches:
            col = batch.column("text")
            for a, b in _runs(pc.binary_length(col).to_pylist(), CHUNK_BYTES):
                ids = bpe.encode(col.slice(a, b - a).to_pylist())
                out = {"doc_id": batch.column("doc_id").slice(a, b - a), "ids": _lists(ids)}
                if and_decode:
                    sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
                    out["bytes"] = pa.array(bpe.decode(np.concatenate(ids), sizes), pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    return d.mapInArrow(run, schema)


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", ranks: str = RANKS,
           folder: str | None = None, pattern: str | None = None) -> DataFrame:
    """Per row: ``doc_id``, ``ids`` and ``bytes`` (binary)."""
    ship(df.sparkSession)
    path, pat = tokenizer_path(ranks, folder), pattern or _pattern()
    d = df.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    schema = f"doc_id {d.schema['doc_id'].dataType.simpleString()}, ids array<int>, bytes binary"

    def run(batches):
        bpe = load(path, pat)
        for batch in batches:
            col = batch.column("ids")
            sizes = pc.fill_null(pc.list_value_length(col), 0).to_numpy(zero_copy_only=False)
            flat = pc.list_flatten(col)
            if flat.null_count:
                raise ValueError("a token id is null")
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "ids": col,
                "bytes": pa.array(bpe.decode(flat.to_numpy(), sizes.astype(np.int64)), pa.binary())})

    return d.mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, **files) -> DataFrame:
    """Encode, decode the ids, and digest both."""
    both = encode(docs, and_decode=True, **files)
    ids_text = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(ids_text, 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
