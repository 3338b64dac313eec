"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from docweave.llm import (
    alignment, ann, bpe, chat, conversation_trie, decontaminate, language_id, lm_score, near_join, quality, secrets,
    token_files, toxicity)
from docweave.llm.common import remainder, table
from docweave.llm.oracles import SQL  # noqa: F401
from docweave.sources.storage import new_location, stored

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    location = new_location(spark, "token_files")
    token_files.write_tokens(table(spark, folder, "documents"), location,
                             public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.with_checksums(token_files.with_starts(token_files.read_tokens(spark, location)))


@query
def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_and_decode(table(spark, folder, "documents"),
                                 public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", remainder("doc_id", 4) == 2)
    profiles = language_id.stored_profiles(docs.where(~F.col("held_out")))
    return language_id.predict(docs, profiles, keep=("held_out",))


@query
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "posterior")


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("held_out", remainder("doc_id", 4) == 2)
    lexicon = toxicity.fit(docs.where(~F.col("held_out")), table(spark, folder, "labels"))
    return toxicity.score(docs, lexicon, keep=("held_out",))


@query
def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


@query
def op1_near_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_join.near_join(table(spark, folder, "documents"))


@query
def op9_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("training", remainder("doc_id", 7) != 2)
    return lm_score.score(docs, "training", public_tokenizers.path("byte_bpe_50k.json"), end_id=50256)


@query
def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    control = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)],
                                  "conv_id long, turn long, role string, text string")
    return chat.chat(table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra))


@query
def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.trie(table(spark, folder, "conversations"))


@query
def op11_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = stored(ann.usable(table(spark, folder, "embeddings")), "ann_usable")
    return ann.search(ann.build_index(vectors), vectors.where("vec_id % 20 = 0"))


@query
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.alignment(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                               public_tokenizers.path("piece_bpe_32k.model"))
