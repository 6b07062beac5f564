"""A corpus pipeline over ``documents``: five stages, each one operator.

1. language_id: documents whose language cannot be found go
2. exact_dedup: one document of each group of equal texts stays
3. simhash_dedup: one document of each group of near copies stays
4. secret_scan: every document stays, its secrets masked
5. packing: the documents become pieces of token sequences

Every stage reads all rows and whole texts of the one before it; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from streamfold.llm import exact_dedup, language_id, packing, secret_scan, simhash
from streamfold.llm.common import read_table, scratch


def stage_language_id(spark, docs, sf_dir):
    return language_id.with_language(docs, language_id.fit(docs))


def stage_exact_dedup(spark, docs, sf_dir):
    return exact_dedup.survivors(docs)


def stage_simhash_dedup(spark, docs, sf_dir):
    """The document with the smallest id of each group stays."""
    return simhash.survivors(docs)


def stage_secret_scan(spark, docs, sf_dir):
    return secret_scan.redact(docs)


def stage_packing(spark, docs, sf_dir):
    return packing.pieces(docs)


STAGES = [("language_id", stage_language_id), ("exact_dedup", stage_exact_dedup),
          ("simhash_dedup", stage_simhash_dedup), ("secret_scan", stage_secret_scan), ("packing", stage_packing)]

# Tokenizers, n-gram ranks and XXH64 fingerprints have no DuckDB form.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
