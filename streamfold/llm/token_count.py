"""Token counts for a word-end BPE vocabulary, by the whole-token shortcut.

Which vocabulary strings encode alone as one token is proved once, on the
driver, by running the library over the whole vocabulary.  A text's
pre-tokens that are such strings count one each; only the other pre-tokens
are merged, by the library, each distinct one once per worker.

Splitting is done by a pattern that equals the tokenizer's own normalizer and
pre-tokenizer on Latin text (code points below U+0180 but U+0130, shown by
test for every code point).  Texts are divided at white space first, which no
pre-token goes over; a part with any other character is encoded by the library,
each distinct one once a worker, so a count never rests on the pattern outside
the range it is proved for.  Only a text in which a special-token string occurs
goes to the library whole.

Defined results: a null text counts as empty (0 tokens, 0 bytes); a null id is
kept; repeated rows give repeated results; special-token strings inside a text
count one token each, as is the library's default; other columns are not read.
"""

from __future__ import annotations

import re
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamfold.llm.common import ship, text_or_empty, tokenizer_path

VOCAB = "word_bpe_49k.json"
# Distinct parts of texts a worker remembers; beyond, it goes back to the ones
# it met first, among which the frequent ones are.
CACHE_PARTS = 350_000
KEEP_PARTS = 150_000
WORDS_PER_CALL = 200
CHUNK_BYTES = 2_000_000

# Letters, digits and white space below U+0180, after lower-casing.
_LETTERS = "a-zªµºß-öø-ſ"
_DIGITS = "0-9²³¹¼-¾"
_SPACE = r"\t-\r \x85\xa0"
PRETOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_SPACE}{_LETTERS}{_DIGITS}]+")
UNPROVED = re.compile("[^\x00-ſ]|[\x1c-\x1fİ]")       # U+001C to U+001F divide words for str.split only
UNPROVED_RE2 = r"[^\x00-\x{17f}]|[\x1c-\x1f\x{130}]"


class WordTokenizer:
    """A tokenizer file with the pre-token path beside the library's own."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        vocab = self.lib.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.closes[[i for v, i in vocab.items() if v.endswith("</w>")]] = True
        added = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(re.escape(s) for s in sorted(added, key=len, reverse=True)) or "$.")

    def encode(self, text: str) -> list[int]:
        return self.lib.encode(text, add_special_tokens=False).ids

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens, end to end, and how many each has.  Pre-tokens
        are put together with line breaks, which the tokenizer drops, so one
        call encodes many; an id whose string has the word end closes one."""
        groups = ["\n".join(words[i:i + WORDS_PER_CALL]) for i in range(0, len(words), WORDS_PER_CALL)]
        ids = [np.zeros(0, dtype=np.uint32)]
        for a in range(0, len(groups), 50):
            ids += [np.array(e.ids, dtype=np.uint32)
                    for e in self.lib.encode_batch_fast(groups[a:a + 50], add_special_tokens=False)]
        flat = np.concatenate(ids)
        size = np.diff(np.flatnonzero(self.closes[flat]), prepend=-1)
        if len(size) != len(words) or size.sum() != len(flat):
            raise ValueError("a word is not one pre-token")
        return flat, size

    def parts(self, text: str) -> list[str] | None:
        """The lower-case text between white space (no pre-token goes over
        it), or None where the pattern is not proved or a special string
        occurs."""
        if UNPROVED.search(text) or self.special.search(text):
            return None
        return text.lower().split()

    def pretokens(self, text: str) -> list[str] | None:
        parts = self.parts(text)
        return parts if parts is None else [w for p in parts for w in PRETOKEN.findall(p)]

    def whole_tokens(self) -> dict[str, int]:
        """The vocabulary strings that, encoded alone, are one pre-token and
        one token: string to id."""
        from tokenizers import decoders

        vocab = self.lib.get_vocab(with_added_tokens=False)
        plain = decoders.ByteLevel()
        words = sorted({plain.decode([v[:-4]]) for v in vocab if v.endswith("</w>")})
        words = [w for w in words if w and "�" not in w and self.pretokens(w) == [w]]
        return {w: ids[0] for w, ids in zip(words, self.encode_many(words)) if len(ids) == 1}


_LOADED: dict[str, WordTokenizer] = {}


def load(path: str) -> WordTokenizer:
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


def chunks(col: pa.StringArray, limit: int = CHUNK_BYTES):
    """Consecutive slices of about ``limit`` bytes of text together."""
    start, held = 0, 0
    for i, n in enumerate(pc.binary_length(col).to_pylist()):
        if held and held + n > limit:
            yield col.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(col):
        yield col.slice(start)


class Numbers(dict):
    """Parts of texts to numbers, in the order in which they were first asked."""

    def __missing__(self, part):
        self[part] = n = len(self)
        return n


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of every span, one after another."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _sums(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The sum of each run of ``size`` values."""
    upto = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(size)
    return upto[ends] - upto[ends - size]


class Memory:
    """What a worker knows: the ids of part number i are
    ``flat[first[i]:first[i + 1]]``.  Pre-tokens in ``whole`` (string to id)
    are one token; the others are merged."""

    def __init__(self, tok: WordTokenizer, whole: dict[str, int]):
        self.tok, self.whole = tok, whole
        self.numbers = Numbers()
        self.flat, self.first = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _forget(self) -> None:
        kept = min(KEEP_PARTS, len(self.numbers))
        self.numbers = Numbers(zip(islice(self.numbers, kept), range(kept)))
        self.first = self.first[:kept + 1].copy()
        self.flat = self.flat[:self.first[-1]].copy()

    def _learn(self, parts: list[str]) -> None:
        """Add the ids of the next parts by number."""
        split = [[p] if UNPROVED.search(p) else PRETOKEN.findall(p) for p in parts]
        at = Numbers()
        word = np.fromiter((at[w] for ws in split for w in ws), dtype=np.int64)
        # where each pre-token's ids are: known as a part, a whole token, or merged now
        old, known = len(self.first) - 1, len(self.flat)
        first, size, single, rest, odd = np.zeros(len(at), np.int64), np.ones(len(at), np.int64), [], [], []
        for w, k in at.items():
            if w in self.whole:
                first[k] = known + len(single)
                single.append(self.whole[w])
            elif (i := self.numbers.get(w, old)) < old:
                first[k], size[k] = self.first[i], self.first[i + 1] - self.first[i]
            else:
                (odd if UNPROVED.search(w) else rest).append(w)
        merged, n = self.tok.encode_words(rest)
        by_library = self.tok.encode_many(odd)
        merged = np.concatenate([merged, *(np.array(x, dtype=np.uint32) for x in by_library)])
        n = np.concatenate([n, np.fromiter(map(len, by_library), dtype=np.int64, count=len(odd))])
        k = np.fromiter((at[w] for w in (*rest, *odd)), dtype=np.int64, count=len(rest) + len(odd))
        first[k], size[k] = known + len(single) + np.cumsum(n) - n, n
        pool = np.concatenate([self.flat, np.array(single, dtype=np.uint32), merged])
        new = pool[_spans(first[word], size[word])]
        per_part = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        ends = np.concatenate([[0], np.cumsum(size[word])])[np.cumsum(per_part)]
        self.first = np.concatenate([self.first, self.first[-1] + ends])
        self.flat = np.concatenate([self.flat, new])

    def numbered(self, texts: pa.StringArray, odd: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the white-space parts of texts, end to end, and how
        many each text has.  For texts that ``parts`` can take, Arrow makes the
        same parts here (an empty one at white space on an end, which has no
        token); ``odd`` texts are cut at ASCII white space, and a part with an
        unproved character stays as it is.  Each distinct part is looked up
        once a call."""
        if len(self.numbers) > CACHE_PARTS:
            self._forget()
            pa.default_memory_pool().release_unused()
        known = len(self.numbers)
        split = pc.ascii_split_whitespace(texts) if odd else pc.utf8_split_whitespace(pc.utf8_lower(texts))
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if odd:
            distinct = [p if UNPROVED.search(p) else p.lower() for p in distinct]
        number = np.fromiter(map(self.numbers.__getitem__, distinct), dtype=np.int64, count=len(distinct))
        self._learn(list(islice(self.numbers, known, None)))
        return number[coded.indices.to_numpy()], pc.list_value_length(split).to_numpy().astype(np.int64)

    def _unproved(self, texts: pa.StringArray) -> np.ndarray:
        return pc.match_substring_regex(texts, UNPROVED_RE2).to_numpy(zero_copy_only=False)

    def _special(self, texts: pa.StringArray) -> np.ndarray:
        return pc.match_substring_regex(texts, self.tok.special.pattern).to_numpy(zero_copy_only=False)

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, end to end, and how many each text has."""
        whole, odd = self._special(texts), self._unproved(texts)
        size = np.zeros(len(texts), dtype=np.int64)
        found = []
        for which in (~whole & ~odd, ~whole & odd):
            if not which.any():
                continue
            part, n_parts = self.numbered(texts.filter(pa.array(which)), odd=bool((which & odd).any()))
            per_part = self.first[part + 1] - self.first[part]
            size[which] = _sums(per_part, n_parts)
            found.append((which, self.flat[_spans(self.first[part], per_part)]))
        at = np.flatnonzero(whole).tolist()
        if at:
            lists = [np.array(x, dtype=np.uint32) for x in self.tok.encode_many(texts.take(pa.array(at)).to_pylist())]
            size[whole] = list(map(len, lists))
            found.append((whole, np.concatenate(lists)))
        if len(found) == 1:
            return found[0][1], size
        ids = np.zeros(size.sum(), dtype=np.uint32)
        first = np.cumsum(size) - size
        for which, part in found:
            ids[_spans(first[which], size[which])] = part
        return ids, size

    def counts(self, texts: pa.StringArray) -> np.ndarray:
        """Tokens of each text."""
        whole, odd = self._special(texts), self._unproved(texts)
        size = np.zeros(len(texts), dtype=np.int64)
        for which in (~whole & ~odd, ~whole & odd):
            if which.any():
                part, n_parts = self.numbered(texts.filter(pa.array(which)), odd=bool((which & odd).any()))
                size[which] = _sums(self.first[part + 1] - self.first[part], n_parts)
        for i in np.flatnonzero(whole):
            size[i] = len(self.tok.encode(texts[int(i)].as_py()))
        return size


_MEMORY: dict[str, Memory] = {}


def memory(path: str, whole: dict[str, int]) -> Memory:
    """This process's memory for a tokenizer file."""
    if path not in _MEMORY:
        _MEMORY[path] = Memory(load(path), whole)
    return _MEMORY[path]


def count_tokens(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 vocab: str = VOCAB, folder: str | None = None) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes`` (UTF-8) and ``n_tokens``."""
    ship(df.sparkSession)
    path = tokenizer_path(vocab, folder)
    # bounded by the vocabulary
    whole = df.sparkSession.sparkContext.broadcast(load(path).whole_tokens())

    @F.arrow_udf("long")
    def n_tokens(texts: pa.Array) -> pa.Array:
        known = memory(path, whole.value)
        return pa.array(np.concatenate([np.zeros(0, np.int64), *map(known.counts, chunks(texts))]))

    text = text_or_empty(text_col)
    return df.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"),
                     n_tokens(text).alias("n_tokens"))
