import hashlib
import re
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.functions.embedding import BatchEmbedding, HashEmbedding, OnnxEmbedding, mean_pool

TEXTS = [(1, "Rust and rust"), (2, "other document"), (3, ""), (4, None), (5, "rust " * 3000)]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(TEXTS, "id int, text string")


def vectors_of(texts, embedder):
    rows = texts.select("id", embedder.embed(F.col("text")).alias("v")).collect()
    return {r["id"]: r["v"] for r in rows}


def test_hash_embedding(texts):
    got = vectors_of(texts, HashEmbedding(16))
    assert got[4] is None and got[3] == [0.0] * 16
    for i, text in TEXTS[:2] + TEXTS[4:]:
        want = np.zeros(16)
        for word in re.findall(r"\w+", text.lower()):
            want[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 16] += 1
        assert got[i] == pytest.approx(want / np.linalg.norm(want))


def test_batch_embedding_loads_once_per_task_and_keeps_nulls(texts):
    def load():
        calls = {"batches": 0}

        def run(listed):
            calls["batches"] += 1
            return [[float(len(t)), float(calls["batches"])] for t in listed]

        return run

    texts.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        got = vectors_of(texts.coalesce(1), BatchEmbedding(load, 2))
    finally:
        texts.sparkSession.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got[4] is None and got[1][0] == 13.0
    assert got[5][1] > 1  # the state of one load lives on through the batches of a task


@pytest.mark.parametrize("function", [
    lambda listed: [[1.0, 2.0]] * (len(listed) + 1),
    lambda listed: [[1.0]] * len(listed),
    lambda listed: 1 / 0,
])
def test_bad_embedders_fail_the_job(texts, function):
    with pytest.raises(Exception):
        vectors_of(texts, BatchEmbedding.of(function, 2))


def test_mean_pool(spark):
    tokens = spark.createDataFrame(
        [("a", [1.0, 2.0, 3.0], 1), ("a", [4.0, 6.0, 8.0], 1), ("b", [1.0, 1.0, 1.0], 1),
         ("b", [5.0, 5.0, 5.0], 0), ("c", [7.0, 7.0, 7.0], 0)],
        "_id string, vector array<float>, mask int").repartition(4)
    got = {r["_id"]: r["embedding"] for r in mean_pool(tokens).collect()}
    assert got == {"a": [2.5, 4.0, 5.5], "b": [1.0, 1.0, 1.0], "c": [0.0, 0.0, 0.0]}


# A model small enough to write by hand: ONNX files are protocol buffers.

def field(number, payload):
    if isinstance(payload, int):
        return varint(number << 3) + varint(payload)
    payload = payload.encode() if isinstance(payload, str) else payload
    return varint(number << 3 | 2) + varint(len(payload)) + payload


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def value_info(name, kind, *dims):
    shape = b"".join(field(1, field(2, d) if isinstance(d, str) else field(1, d)) for d in dims)
    return field(1, name) + field(2, field(1, field(1, kind) + field(2, shape)))


def lookup_model(table):
    """`table[input_ids]` as an ONNX model with the inputs of a sentence model."""
    FLOAT, INT64 = 1, 7
    node = field(1, "table") + field(1, "input_ids") + field(2, "states") + field(4, "Gather")
    raw = struct.pack(f"<{table.size}f", *table.ravel())
    tensor = (field(1, table.shape[0]) + field(1, table.shape[1]) + field(2, FLOAT)
              + field(8, "table") + field(9, raw))
    inputs = b"".join(field(11, value_info(n, INT64, "batch", "sequence"))
                      for n in ("input_ids", "attention_mask", "token_type_ids"))
    output = field(12, value_info("states", FLOAT, "batch", "sequence", table.shape[1]))
    graph = field(1, node) + field(2, "lookup") + field(5, tensor) + inputs + output
    return field(1, 8) + field(7, graph) + field(8, field(1, "") + field(2, 13))


@pytest.fixture(scope="module")
def model(tmp_path_factory):
    pytest.importorskip("onnxruntime")
    tokenizers = pytest.importorskip("tokenizers")
    folder = tmp_path_factory.mktemp("model")
    table = np.random.default_rng(0).normal(size=(5, 384)).astype(np.float32)
    (folder / "model.onnx").write_bytes(lookup_model(table))
    words = {"[PAD]": 0, "[UNK]": 1, "rust": 2, "and": 3, "other": 4}
    tokenizer = tokenizers.Tokenizer(tokenizers.models.WordLevel(words, unk_token="[UNK]"))
    tokenizer.normalizer = tokenizers.normalizers.Lowercase()
    tokenizer.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    tokenizer.save(str(folder / "tokenizer.json"))
    return str(folder), table


def test_onnx_embedding(texts, model):
    folder, table = model
    got = vectors_of(texts, OnnxEmbedding(folder))
    assert got[1] == pytest.approx((table[2] + table[3] + table[2]) / 3, abs=1e-5)  # not unit length
    assert got[2] == pytest.approx((table[4] + table[1]) / 2, abs=1e-5)
    assert got[3] == [0.0] * 384 and got[4] is None  # nothing but padding
    assert got[5] == pytest.approx(table[2], abs=1e-5)  # cut at 512 tokens


def test_onnx_dimension_is_checked(texts, model):
    with pytest.raises(Exception, match="shape"):
        vectors_of(texts, OnnxEmbedding(model[0], dimension=100))
