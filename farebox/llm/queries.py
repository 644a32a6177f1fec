"""One query per operator over the test tables, and the SQL some of them are checked against."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir
from . import exact_dedup, filter_audit, multiset_hash, near_dedup, packing, parity_join, piece_codec, quality
from . import surrogates, token_counts, token_files, url_templates, vector_codes
from .common import table

Query = Callable[[SparkSession, str], DataFrame]

WORDS = "word_bpe_49k.json"
BYTES = "byte_bpe_50k.json"
# Of the test tables; a real corpus takes its key from where its secrets are kept.
SURROGATE_KEY = "key of the test corpus"
PIECES = "piece_bpe_32k.model"


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_dir(spark)}/llm/token-files-{uuid.uuid4().hex}"
    token_files.write(table(spark, folder, "documents"), path, public_tokenizers.path(WORDS), end_id=1)
    return token_files.digests(token_files.read(spark, path))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, folder, "labels")))


def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return multiset_hash.edited_pairs(table(spark, folder, "documents"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(BYTES), end_id=2)


def op5_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    return piece_codec.round_trip(table(spark, folder, "documents"), public_tokenizers.path(PIECES))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path(PIECES))


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


def op8_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return surrogates.replaced(table(spark, folder, "documents").select("doc_id", "text"), SURROGATE_KEY)


def op9_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    return url_templates.filter_urls(table(spark, folder, "pages"), table(spark, folder, "labels"))


def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, folder, "documents"))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, folder, "embeddings"))


def op13_parity_join(spark: SparkSession, folder: str) -> DataFrame:
    return parity_join.near_sets(table(spark, folder, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_token_files": op1_token_files,
        "op2_quality": op2_quality,
        "op3_fingerprints": op3_fingerprints,
        "op4_packing": op4_packing,
        "op5_piece_codec": op5_piece_codec,
        "op6_token_counts": op6_token_counts,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_surrogates": op8_surrogates,
        "op9_url_templates": op9_url_templates,
        "op10_near_dedup": op10_near_dedup,
        "op11_filter_audit": op11_filter_audit,
        "op12_vector_codes": op12_vector_codes,
        "op13_parity_join": op13_parity_join,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                   doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
        """,
        "op11_filter_audit": filter_audit.AUDIT_SQL,
        "op12_vector_codes": vector_codes.codes_sql(),
        "op13_parity_join": parity_join.JOIN_SQL,
    }
