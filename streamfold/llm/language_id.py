"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent letter n-grams (n = 1, 2, 3, words
padded with a blank), most frequent first.  A document's profile is compared
to each language's by the out-of-place distance: for every n-gram of the
document, how far its rank is from the rank in the language's profile, or the
profile length if it is missing there.  The smallest distance wins.

Language profiles are learned from a bounded, hash-chosen sample of the
labelled documents (about ``TRAIN_PER_LANG`` of each language); counting is a
Spark aggregation.  The model has ``PROFILE`` n-grams a language.  Whole texts
are read, in training and in prediction.

Defined results: a null text, or one without letters, is ``und`` with score 0;
without any labelled document everything is ``und``; ties go to the language
first in the alphabet, ties of n-gram counts to the n-gram of smaller code
points; a null id is never held out and is not trained on; repeated rows give
repeated results; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from streamfold.llm.common import ship, text_or_empty

PROFILE = 300
TRAIN_PER_LANG = 3000
HELD_OUT = (3, 1)           # crc32(id as text) mod 3 = 1
UNDETERMINED = "und"
CODE_BITS = 21              # a code point; three fit one long
PIECE = 1_000_000           # characters of a text whose n-grams are packed at once
_WHITE = re.compile(r"\s")

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Table over code points: is it a letter?"""
    if not _LETTER:
        chars = np.arange(0x110000, dtype="<u4")
        chars[0xD800:0xE000] = 0x20
        text = chars.tobytes().decode("utf-32-le")
        _LETTER.append(np.fromiter(map(str.isalpha, text), dtype=bool, count=len(text)))
    return _LETTER[0]


def _pieces(text: str):
    """The text in pieces of ``PIECE`` characters and up to the next white
    space, so that no word, and so no n-gram, is cut."""
    a = 0
    while a < len(text):
        m = _WHITE.search(text, a + PIECE)
        b = m.start() if m else len(text)
        yield text[a:b]
        a = b


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The letter n-grams of a text as packed code points, ascending, and
    their counts; a run of other characters is one blank, and no n-gram goes
    over a blank."""
    keys = []
    blank = np.int64(0x20)
    for piece in _pieces(text):
        cp = np.frombuffer(piece.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        cp = np.concatenate([[blank], np.where(_letters()[cp], cp, 0x20).astype(np.int64), [blank]])
        cp = cp[np.concatenate([[True], (cp[1:] != blank) | (cp[:-1] != blank)])]
        one, two = cp[cp != blank], (cp[:-1] << CODE_BITS) | cp[1:]     # two: never blank and blank
        three = (cp[:-2] << 2 * CODE_BITS) | (cp[1:-1] << CODE_BITS) | cp[2:]
        keys.append(np.concatenate([one, two, three[cp[1:-1] != blank]]))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.unique(np.concatenate(keys), return_counts=True)


def top(keys: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """The k most frequent keys, most frequent first, ties by key."""
    if len(keys) > k:
        least = np.partition(counts, len(counts) - k)[len(counts) - k]
        keys, counts = keys[counts >= least], counts[counts >= least]
    return keys[np.argsort(-counts, kind="stable")][:k]


def has_letters(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Model:
    """Languages in alphabetical order; sorted n-gram keys; the rank of each
    key in each language's profile (``size`` where it is missing)."""

    languages: list[str]
    keys: np.ndarray
    ranks: np.ndarray
    size: int

    @classmethod
    def of(cls, profiles: dict[str, list[int]], size: int) -> "Model":
        languages = sorted(profiles)
        keys = np.unique(np.array([k for p in profiles.values() for k in p], dtype=np.int64))
        ranks = np.full((len(keys) + 1, max(1, len(languages))), size, dtype=np.int64)
        for j, lang in enumerate(languages):
            ranks[np.searchsorted(keys, profiles[lang]), j] = np.arange(len(profiles[lang]))
        return cls(languages, keys, ranks, size)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score (1: equal profiles, 0: nothing in common)."""
        if not self.languages or not text or not has_letters(text):
            return UNDETERMINED, 0.0
        mine = top(*ngrams(text), self.size)
        at = np.searchsorted(self.keys, mine)
        at[at == len(self.keys)] = 0
        at = np.where(self.keys[at] == mine, at, len(self.keys)) if len(self.keys) else at
        # out-of-place distance to every language at once
        far = np.minimum(np.abs(self.ranks[at] - np.arange(len(mine))[:, None]), self.size)
        far = np.where(self.ranks[at] == self.size, self.size, far).sum(axis=0)
        best = int(far.argmin())
        return self.languages[best], float(1 - far[best] / (self.size * len(mine)))


def held_out(id_col: str = "doc_id"):
    mod, left = HELD_OUT
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod == left, F.lit(False))


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        profile: int = PROFILE, per_lang: int = TRAIN_PER_LANG) -> Model:
    """Learn the profiles from rows that are not held out."""
    ship(df.sparkSession)
    labelled = (df.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull()
                          & ~held_out(id_col))
                .select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"),
                        F.col(text_col).cast("string").alias("text")))
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    # the sample: rows whose hash falls below the share that the bound allows
    share = F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.lit(1_000_000) * F.least(F.lit(1.0), per_lang / F.col("n"))
    # one row a language, far less than the model itself; so no text is shuffled
    sample = labelled.join(F.broadcast(sizes), "lang").filter(share).select("lang", "text")

    def counted(batches):
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for lang in sorted(set(langs)):
                texts = batch.column("text").filter(pa.array(langs == lang)).to_pylist()
                parts = [ngrams(t) for t in texts if has_letters(t)]
                if not parts:
                    continue
                keys, where = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                n = np.bincount(where, weights=np.concatenate([c for _, c in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys), pa.array(n)],
                                                 names=["lang", "gram", "n"])

    grams = (sample.mapInArrow(counted, "lang string, gram long, n long")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    best = grams.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= profile)
    profiles: dict[str, list[int]] = {}
    for r in best.orderBy("lang", "rank").collect():      # `profile` rows a language
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return Model.of(profiles, profile)


def predictor(model: Model):
    """Column function: text to struct(lang_pred, score)."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``lang_pred`` and ``score``."""
    ship(df.sparkSession)
    d = df.select(F.col(id_col).alias("doc_id"), predictor(model)(F.col(text_col).cast("string")).alias("p"))
    return d.select("doc_id", held_out("doc_id").alias("held_out"), "p.lang_pred", "p.score")


def with_language(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose language was found, all their columns kept."""
    ship(df.sparkSession)
    return df.filter(predictor(model)(F.col(text_col).cast("string"))["lang_pred"] != UNDETERMINED)
