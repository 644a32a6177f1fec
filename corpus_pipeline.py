"""A training corpus from raw documents."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from farebox.llm import exact_dedup, near_dedup, packing, quality, surrogates
from farebox.llm.common import discard, scratch, table
from farebox.llm.queries import BYTES, SURROGATE_KEY
from farebox.session import shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return surrogates.replaced(docs, SURROGATE_KEY).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(BYTES), end_id=2)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("personal_data", replace_personal_data),
    ("packing", pack),
]

# SQL has neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again.

    What a stage stages for itself and what the stage before wrote are removed once it is written; the
    last result stays.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline/{name}-{uuid.uuid4().hex}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            discard(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
