"""Embedding functions: anything with a `dimension` and `embed(text column) -> Column`.

`HashEmbedding` needs no model. `BatchEmbedding` wraps any Python function over a
batch of texts. `OnnxEmbedding` runs a sentence model from a directory that every
executor can read. All of them work batch by batch inside Spark tasks.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from docweave.errors import EmbeddingError
from docweave.functions.text import Tokenizer, tokens

# Fixed values of the default sentence model (all-MiniLM-L6-v2).
MODEL_MAX_TOKENS = 512
MODEL_DIMENSION = 384


class EmbeddingFunction(Protocol):
    dimension: int

    def embed(self, text: Column) -> Column: ...


class HashEmbedding:
    """Counts of hashed tokens, scaled to unit length; a text without tokens gives zeros.

    Tokens and their md5 buckets are computed by Spark expressions, so only small
    integers reach Python, where each Arrow batch is counted in one call."""

    def __init__(self, dimension: int = 64, tokenizer: Tokenizer = tokens):
        self.dimension = dimension
        self.tokenizer = tokenizer

    def bucket(self, token: Column) -> Column:
        number = F.conv(F.substring(F.md5(token.cast("binary")), 1, 8), 16, 10).cast("bigint")
        return (number % self.dimension).cast("int")

    def embed(self, text: Column) -> Column:
        dimension = self.dimension

        @F.pandas_udf("array<float>")
        def count(batch: pd.Series) -> pd.Series:
            sizes = np.array([0 if b is None else len(b) for b in batch], dtype=np.int64)
            flat = [b for b in batch if b is not None and len(b)]
            buckets = np.concatenate(flat).astype(np.int64) if flat else np.empty(0, np.int64)
            rows = np.repeat(np.arange(len(batch)), sizes)
            counts = np.bincount(rows * dimension + buckets, minlength=len(batch) * dimension)
            vectors = counts.reshape(len(batch), dimension).astype(np.float64)
            norms = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
            vectors = (vectors / np.where(norms > 0, norms, 1.0)).astype(np.float32)
            return pd.Series([None if b is None else v for b, v in zip(batch, vectors)])

        return count(F.transform(self.tokenizer(text), self.bucket))


def _checked(vectors, texts: int, dimension: int) -> list:
    vectors = list(vectors)
    if len(vectors) != texts:
        raise EmbeddingError(f"embedding function gave {len(vectors)} vectors for {texts} texts")
    for v in vectors:
        if len(v) != dimension:
            raise EmbeddingError(
                f"the embedding function made a vector of {len(v)} elements and declares {dimension}")
    return vectors


class BatchEmbedding:
    """A user function `list[str] -> list of vectors`.

    `load` runs once per Python task and returns that function, so a model is not loaded
    per batch. Count and dimension of the output are checked."""

    def __init__(self, load: Callable[[], Callable[[list[str]], list]], dimension: int):
        self.load = load
        self.dimension = dimension

    @classmethod
    def of(cls, function: Callable[[list[str]], list], dimension: int) -> BatchEmbedding:
        return cls(lambda: function, dimension)

    def embed(self, text: Column) -> Column:
        load, dimension = self.load, self.dimension

        @F.pandas_udf("array<float>")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            function = load()
            for batch in batches:
                known = batch[batch.notna()]
                vectors = _checked(function(known.tolist()), len(known), dimension) if len(known) else []
                made = iter(vectors)
                yield pd.Series([np.asarray(next(made), dtype=np.float32) if here else None
                                 for here in batch.notna()], dtype=object)

        return run(text)


class OnnxEmbedding(BatchEmbedding):
    """Sentence model in ONNX form: `model.onnx` and `tokenizer.json` in `directory`.

    Token vectors are averaged under the attention mask and not scaled to unit length. Texts
    of more than `max_tokens` are read whole, in windows of that many tokens."""

    def __init__(self, directory: str, dimension: int = MODEL_DIMENSION,
                 max_tokens: int = MODEL_MAX_TOKENS, batch_size: int = 32):
        super().__init__(lambda: _onnx_function(directory, dimension, max_tokens, batch_size), dimension)


def _onnx_function(directory: str, dimension: int, max_tokens: int, batch_size: int):
    import onnxruntime
    from tokenizers import Tokenizer as ModelTokenizer

    tokenizer = ModelTokenizer.from_file(os.path.join(directory, "tokenizer.json"))
    tokenizer.enable_truncation(max_length=max_tokens)
    tokenizer.enable_padding(length=max_tokens)
    options = onnxruntime.SessionOptions()
    options.intra_op_num_threads = 1  # one Spark task, one core
    session = onnxruntime.InferenceSession(
        os.path.join(directory, "model.onnx"), options, providers=["CPUExecutionProvider"])
    wanted = {i.name for i in session.get_inputs()}

    def run(texts: list[str]) -> list:
        out = []
        for start in range(0, len(texts), batch_size):
            coded = tokenizer.encode_batch(texts[start:start + batch_size])
            # a long text is several windows; its vector is the mean over all their tokens
            windows = [(at, w) for at, c in enumerate(coded) for w in (c, *c.overflowing)]
            sums, counts = np.zeros((len(coded), dimension)), np.zeros((len(coded), 1))
            for first in range(0, len(windows), batch_size):
                part = windows[first:first + batch_size]
                mask = np.array([w.attention_mask for _, w in part], dtype=np.int64)
                inputs = {"input_ids": np.array([w.ids for _, w in part], dtype=np.int64),
                          "attention_mask": mask, "token_type_ids": np.zeros_like(mask)}
                states = session.run(None, {n: v for n, v in inputs.items() if n in wanted})[0]
                if states.shape != (*mask.shape, dimension):
                    raise EmbeddingError(f"model gave shape {states.shape}, "
                                         f"expected {(*mask.shape, dimension)}")
                of = [at for at, _ in part]
                np.add.at(sums, of, (states * mask[:, :, None]).sum(axis=1))
                np.add.at(counts, of, mask.sum(axis=1, keepdims=True))
            out.extend(sums / np.maximum(counts, 1))
        return out

    return run


def mean_pool(token_rows: DataFrame, key: str = "_id", vector: str = "vector",
              mask: str = "mask") -> DataFrame:
    """`(key, embedding)`: the mean of the unmasked token vectors of each key.

    One input row per token. Sums are combined before the shuffle, so a key with very
    many tokens costs one partial row per task and position. A key whose tokens are
    all masked gives zeros."""
    used = F.when(F.col(mask) != 0, 1).otherwise(0)
    cells = token_rows.select(key, used.alias("_used"), F.posexplode(vector).alias("_pos", "_value"))
    means = cells.groupBy(key, "_pos").agg(
        (F.sum(F.col("_value").cast("double") * F.col("_used"))
         / F.greatest(F.sum("_used"), F.lit(1))).alias("_mean"))
    # One entry per dimension, so the list is as long as a vector.
    packed = F.array_sort(F.collect_list(F.struct("_pos", "_mean")))
    return means.groupBy(key).agg(
        F.transform(packed, lambda c: c["_mean"].cast("float")).alias("embedding"))
