"""Helpers shared by the training-data operators: bounded Arrow batches, splits, words.

Every operator reads only its own columns, by name, so further columns of its input, also
ones named like its results, change nothing. A NULL text counts as an empty one."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BATCH_BYTES = 8 * 1024 * 1024
BATCH_ROWS = 4096


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def in_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
               schema: str) -> DataFrame:
    """mapInArrow over batches bounded in bytes, so that a worker's memory depends on the
    longest text and not on the number of rows."""
    owner = function.__module__

    def owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _claim(owner)
        yield from function(batches)

    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(owned, schema)


_held: dict = {}
_owner = None


def _claim(owner: str) -> None:
    """Python workers serve one operator after another: what others remembered here goes."""
    global _owner
    if _owner != owner:
        _held.clear()
        _owner = owner
        gc.collect()
        _give_back()


def _give_back() -> None:
    """Memory that was freed goes back to the machine, where the allocators can do that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def joined(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until the column's values have `size` bytes or more."""
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += pc.sum(pc.binary_length(batch[column])).as_py() or 0
        if total >= size:
            yield pa.concat_batches(held)
            held, total = [], 0
    if held:
        yield pa.concat_batches(held)


def worker_cache(key, build: Callable):
    """What `build` made in this worker, until another operator's task runs here."""
    if key not in _held:
        _held[key] = build()
    return _held[key]


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a NULL id counts as empty text (crc32 0)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def slices(batch: pa.RecordBatch, text: str = "text", size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about `size` bytes of text each; a longer text is
    a slice of its own."""
    ends = np.asarray(pc.cumulative_sum(pc.fill_null(pc.binary_length(batch[text]), 0).cast(pa.int64())))
    start = 0
    while start < len(batch):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a column of texts, and where each text starts (one more at the end)."""
    texts = pc.fill_null(texts, "")
    if texts.type != pa.string():
        texts = texts.cast(pa.string())
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    starts = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[starts[0]:starts[-1]], (starts - starts[0]).astype(np.int64)


def strings(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts.astype(np.int32)),
                                       pa.py_buffer(np.ascontiguousarray(data)))


def byte_table(keep: Callable[[int], bool]) -> np.ndarray:
    """For each byte: itself in ASCII lower case, or a space where it belongs to no word."""
    return np.array([ord(chr(b).lower()) if b < 128 and keep(b) else b if keep(b) else 32
                     for b in range(256)], np.uint8)


#: Words of non-space characters (space and \x09-\x0D part them).
SPACED = byte_table(lambda b: b != 32 and not 9 <= b <= 13)
#: Words of ASCII letters and digits and of everything beyond ASCII.
ALNUM = byte_table(lambda b: b >= 128 or chr(b).isalnum())


def words(texts: pa.Array, of: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased (A-Z) words of all texts, and where each text's words start."""
    data, starts = raw(texts)
    parts = pc.ascii_split_whitespace(strings(of[data], starts))
    flat = parts.values
    full = np.asarray(pc.greater(pc.binary_length(flat), 0)) if len(flat) else np.zeros(0, bool)
    before = np.concatenate(([0], np.cumsum(full)))
    return flat.filter(pa.array(full)), before[np.asarray(parts.offsets)]


def encoded(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct values and the index of each value among them."""
    if not len(values):
        return values, np.zeros(0, np.int64)
    found = values.dictionary_encode()
    return found.dictionary, np.asarray(found.indices).astype(np.int64)


def hashes(distinct: pa.Array) -> np.ndarray:
    """64-bit hash of each text (SipHash with a fixed key: alike in every task)."""
    if not len(distinct):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(distinct.to_numpy(zero_copy_only=False), categorize=False)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a fixed bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` consecutive 64-bit values; runs of texts side by side
    are for the caller to leave out."""
    n = max(0, len(values) - width + 1)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + values[k:k + n]
    return mixed(out)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each span, one span after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def owners(starts: np.ndarray) -> np.ndarray:
    """Which text each element belongs to."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def per_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    before = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return before[starts[1:]] - before[starts[:-1]]
