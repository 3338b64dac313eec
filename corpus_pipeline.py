"""A cleaning pipeline over `documents`: five stages, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the
columns of documents; the last one returns token ids in their place. A stage sees exactly what the
stage before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docweave.llm import bpe, decontaminate, language_id, near_join, secrets
from docweave.llm.common import table
from docweave.sources.storage import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told: NULL texts, texts without a letter, and texts that
    are near no language's profile (see language_id.LEAST_NEAR). Without any profile, letters are enough."""
    profiles = language_id.stored_profiles(docs)
    names = [f"_c{i}" for i in range(len(docs.columns))]  # whatever the documents' columns are called
    inner = docs.toDF(*names)
    text, own_id = (names[docs.columns.index(c)] for c in ("text", "doc_id"))
    judged = language_id.predict(inner, profiles, id_column=own_id, text_column=text, keep=tuple(names),
                                 usable="_usable")
    return judged.where("_usable").select(*names).toDF(*docs.columns)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return near_join.one_of_each(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more are benchmark passages."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts by a mark and keeps all documents."""
    return secrets.redact(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids) of every document."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, tables=0.15)  # executors still hold earlier stages' heap


STAGES = [
    ("language_id", identify_language),
    ("near_join", join_near_copies),
    ("decontaminate", remove_contaminated),
    ("secret_scan", redact_secrets),
    ("byte_bpe", encode_tokens),
]

#: Byte-pair merges and profiles learned from the data have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline/{name}")
    return docs
