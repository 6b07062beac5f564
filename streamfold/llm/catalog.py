"""Registered queries: one per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamfold.llm import (best_fit, byte_bpe, chat, embedding_dedup, exact_dedup, language_id, merkle, packing,
                            secret_scan, simhash, token_count, url_filter, vector_codes)
from streamfold.llm.common import read_table


def _docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents")


def op1_language_id(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    return language_id.identify(docs, language_id.fit(docs))


def op2_url_filter(spark, sf_dir):
    return url_filter.over_pages(read_table(spark, sf_dir, "pages"))


def op3_secret_scan(spark, sf_dir):
    return secret_scan.digests(_docs(spark, sf_dir))


def op4_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op5_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip_digests(_docs(spark, sf_dir))


def op6_token_count(spark, sf_dir):
    return token_count.count_tokens(_docs(spark, sf_dir)).withColumn("over_limit", F.col("n_tokens") > 2048)


def op7_simhash(spark, sf_dir):
    return (simhash.near_duplicates(_docs(spark, sf_dir))
            .select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id"))


def op8_exact_dedup(spark, sf_dir):
    return exact_dedup.mark(_docs(spark, sf_dir))


def op9_chat_format(spark, sf_dir):
    return chat.over_conversations(read_table(spark, sf_dir, "conversations"))


def op10_packing(spark, sf_dir):
    return packing.pieces(_docs(spark, sf_dir))


def op11_merkle_manifest(spark, sf_dir):
    return merkle.digests(_docs(spark, sf_dir))


def op12_vector_codes(spark, sf_dir):
    return vector_codes.digests(read_table(spark, sf_dir, "embeddings"))


def op13_best_fit_packing(spark, sf_dir):
    return best_fit.digests(_docs(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_url_filter, op3_secret_scan, op4_embedding_dedup,
                                   op5_byte_bpe, op6_token_count, op7_simhash, op8_exact_dedup, op9_chat_format,
                                   op10_packing, op11_merkle_manifest, op12_vector_codes, op13_best_fit_packing)}

SQL = {
    "op2_url_filter": url_filter.SQL,
    "op8_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
""",
    "op11_merkle_manifest": merkle.SQL,
    "op12_vector_codes": vector_codes.SQL,
}
