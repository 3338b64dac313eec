"""Token ids as Parquet files that can be read selectively.

A set of files holds, in ascending id order, one row for each text: its id, the file's number
(`shard`), where its ids start within the file (`first`), `n_tokens`, and the ids themselves as
a list column. Ids repeat a small vocabulary, so the list is dictionary encoded; format version
2 falls back to delta packing where a dictionary would not pay. Row groups and pages have a
stated size, and page indexes (written by Spark's Parquet writer) with the sorted ids let a
reader fetch the lists of an id range, or only the counts, without touching the other pages.

Texts are range-partitioned by id before they are encoded, so what is shuffled is text and
encoding runs in the task that writes. NULL texts count as empty ones and still get the end id.
NULL ids come first; repeated ids stay separate rows, ordered by the hash of their text.
"""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from docweave.llm.bpe import id_lists
from docweave.llm.chunks import ChunkEncoder
from docweave.llm.common import BATCH_BYTES, in_batches, slices, worker_cache
from docweave.plans.sizing import broadcast_if_small

ROW_GROUP_BYTES = 32 * 1024 * 1024
PAGE_BYTES = 128 * 1024
JOINED_CHUNKS = 512
MEMO_ENTRIES = 400_000


class LibraryEncoder:
    """Encodes lists of texts with a tokenizers file. Runs of texts that may be joined (see ChunkEncoder)
    are encoded as one text, because calls cost more than the merges, and the ids are
    cut again by the tokens' lengths in bytes."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        size = self.tokenizer.get_vocab_size()
        # in byte-level vocabularies one character stands for one byte
        self.length = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)])

    def __call__(self, texts: list[str], joint: str) -> tuple[np.ndarray, np.ndarray]:
        run, between = JOINED_CHUNKS if joint else 1, joint.strip(" ")
        joined = [between.join(texts[i:i + run]) + between for i in range(0, len(texts), run)]
        found = [self.tokenizer.encode_batch_fast([t], add_special_tokens=False)[0].ids for t in joined]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        if joint:  # cut where the texts' bytes end
            ends = np.cumsum(np.asarray(pc.binary_length(pa.array(texts, pa.string()))) + len(between), dtype=np.int64)
            stops = np.searchsorted(np.cumsum(self.length[ids]), ends, side="left") + 1
            sizes = np.diff(stops, prepend=0)
            if between:  # the token of each line end goes
                ids, sizes = np.delete(ids, stops - 1), sizes - 1
        return ids, sizes


def _chunks(path: str) -> ChunkEncoder:
    return worker_cache(("tokens", path), lambda: ChunkEncoder(LibraryEncoder(path), MEMO_ENTRIES))


def write_tokens(docs: DataFrame, location: str, tokenizer: str, end_id: int,
                 id_column: str = "doc_id", text_column: str = "text") -> None:
    """Encode every text with a tokenizers file, end each with `end_id`, and write the files."""
    kind = docs.schema[id_column].dataType.simpleString()
    tie = F.xxhash64(text_column)
    dealt = (docs.select(id_column, text_column).repartitionByRange(id_column, tie)
             .sortWithinPartitions(id_column, tie))

    def run(batches):
        chunks, first = _chunks(tokenizer), 0
        shard = TaskContext.get().partitionId()
        for batch in batches:
            for part in slices(batch, text_column, BATCH_BYTES):
                ids, starts = chunks(part[text_column])
                ends = np.insert(ids, starts[1:], end_id)
                starts = starts + np.arange(len(starts))
                counts = np.diff(starts)
                yield pa.RecordBatch.from_arrays(
                    [part[id_column], pa.array(np.full(len(part), shard, np.int32)),
                     pa.array(first + starts[:-1]), pa.array(counts), id_lists(ends, starts)],
                    names=[id_column, "shard", "first", "n_tokens", "tokens"])
                first += int(starts[-1])

    rows = in_batches(dealt, run, f"`{id_column}` {kind}, shard int, first long, n_tokens long, tokens array<int>")
    (rows.write.option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
     .option("parquet.enable.dictionary", "true").parquet(location))


def read_tokens(spark: SparkSession, location: str) -> DataFrame:
    """The stored rows; filters on the id and column choices reach the files' pages."""
    return spark.read.parquet(location)


def with_starts(stored: DataFrame) -> DataFrame:
    """Adds `start`, the number of ids of all texts before. One row for each file, never one
    for each text, meets in the running sum over files."""
    totals = stored.groupBy("shard").agg(F.sum("n_tokens").alias("_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_base"))
    return (stored.join(broadcast_if_small(bases), "shard", "left")
            .withColumn("start", F.col("_base") + F.col("first")).drop("_base"))


def with_checksums(rows: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) from the stored lists: crc32 of the ids as
    little-endian unsigned 32-bit integers."""
    kind = rows.schema[id_column].dataType.simpleString()

    def run(batches):
        for batch in batches:
            lists = batch["tokens"]
            values = np.asarray(lists.values).astype("<u4")
            starts = np.asarray(lists.offsets)
            crc = [zlib.crc32(values[a:b]) for a, b in zip(starts, starts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch[id_column], batch["start"], pa.array(np.diff(starts).astype(np.int64)),
                 pa.array(crc, pa.int64())], names=[id_column, "start", "n_tokens", "ids_crc32"])

    return in_batches(rows.select(id_column, "start", "tokens"), run,
                      f"`{id_column}` {kind}, start long, n_tokens long, ids_crc32 long")
