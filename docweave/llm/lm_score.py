"""Scores whole texts by a smoothed unigram count model and by a small causal attention model.

Counts cover every training text. They are summed by word before the shuffle. To look a text's
words up again, words whose share of all tokens is at least 1 / HEAVY (so at most HEAVY of them)
are sent to all tasks; the others meet their counts in a join, in one row for each word and batch
with the list of texts it stands in, so no key holds a large part of the data.

The attention model reads the lower-cased words as subword ids of a public tokenizer, each word
with a space before, and an end. Its id counts come from the word counts. Every training text is
cut into consecutive windows over all its ids; they are dealt to shards of bounded size,
each shard trains from common weights, and weights are averaged by groups of shards, so work grows
with the corpus while what reaches the driver stays a few model sizes. Texts are encoded once: the stored
lines of classes serve training and scoring, and a long text is scored line by line, in any number of tasks.

NULL and empty texts consist of the end alone. Rows keep NULL and repeated ids. If no text is for
training, counts are 0 and the model is the untrained one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from docweave.llm import attention
from docweave.llm.chunks import ChunkEncoder
from docweave.llm.common import (
    SPACED, encoded, in_batches, joined, owners, per_text, slices, spans, words, worker_cache)
from docweave.llm.token_files import LibraryEncoder
from docweave.sources.storage import stored

HEAVY = 100_000
SHARD_WINDOWS = 40_000  # at least, so one pass is some 150 steps or more
LINE_WINDOWS = 66         # a line's positions are whole windows and whole strides
ROUNDS = 1
SLICE_BYTES = 4 << 20
JOINED_BYTES = 1 << 19
MEMO_WORDS = 300_000


class WordIds:
    """Subword ids of words (each with a space before), remembered within bounds."""

    def __init__(self, path: str):
        self.encoder = ChunkEncoder(LibraryEncoder(path), MEMO_WORDS)

    def __call__(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and where each word's start."""
        return self.encoder(pc.binary_join_element_wise("", distinct, " "))


def _word_ids(path: str) -> WordIds:
    return worker_cache(("words", path), lambda: WordIds(path))


def word_counts(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(word, n) over all whole texts."""
    def run(batches):
        for batch in batches:
            found, _ = words(batch[text_column], SPACED)
            distinct, codes = encoded(found)
            yield pa.RecordBatch.from_arrays(
                [distinct, pa.array(np.bincount(codes, minlength=len(distinct)))], names=["word", "n"])

    return in_batches(docs.select(text_column), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def id_counts(counts: DataFrame, tokenizer: str, size: int) -> np.ndarray:
    """How often each subword id occurs in the counted words."""
    def run(batches):
        for batch in joined(batches, "word", JOINED_BYTES):  # each call looks through all remembered words
            ids, starts = _word_ids(tokenizer)(batch["word"])
            weights = np.repeat(np.asarray(batch["n"]), np.diff(starts))
            sums = np.bincount(ids, weights, size)
            seen = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[seen].astype(np.int64))], names=["id", "n"])

    out = np.zeros(size)
    for row in in_batches(counts.select("word", "n"), run, "id long, n long").groupBy("id").agg(
            F.sum("n").alias("n")).collect():  # at most one row for each id of the vocabulary
        out[row["id"]] = row["n"]
    return out


def _cut(ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lines of texts whose classes lie one text after the other, the end before the first and after each:
    text and number within the text of each line, its first place, the place after it, and the place after the tail
    that only its scoring reads."""
    most = LINE_WINDOWS * attention.WINDOW
    assert most % attention.STRIDE == 0
    first = np.concatenate(([0], ends[:-1]))
    lines = -(-(ends - first) // most)
    text = np.repeat(np.arange(len(lines)), lines)
    number = spans(np.zeros(len(lines), np.int64), lines)
    start = first[text] + most * number
    stop = np.minimum(start + most, ends[text]) + 1
    return text, number, start, stop, np.minimum(start + most + attention.WINDOW - attention.STRIDE, ends[text]) + 1


def encode(docs: DataFrame, training: str, tokenizer: str, end_id: int, class_of: np.ndarray, in_class: np.ndarray,
           heavy: dict[str, int], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All that later steps need of the texts, as rows of three kinds. For each text `key, id, training`, counts
    and sums; for each other word of a slice of texts `word, keys`, with the texts it stands in; and
    `line_key, line_training, number, piece, size, line`: the classes of the text's ids with the end before and after, one
    byte each, in pieces. A piece starts with the last class of the one before, so that the first `size` bytes of all pieces
    predict every id once; no two have the same number. The bytes after these are the next places, for windows that reach over."""
    assert attention.CLASSES <= 256
    sent = docs.sparkSession.sparkContext.broadcast(
        (list(heavy), np.array([0, *heavy.values()], np.int64), class_of.astype(np.uint8), in_class))
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        names, heavy, classes, in_class = sent.value
        names = pa.array(names, pa.string())
        word_ids = _word_ids(tokenizer)
        row, number = TaskContext.get().partitionId() << 40, TaskContext.get().partitionId() << 40
        for batch in batches:
            shape = pa.schema({
                "key": pa.int64(), "id": batch.schema.field(id_column).type, "training": pa.bool_(),
                "n_tokens": pa.int64(), "n_heavy": pa.int64(), "heavy": pa.float64(), "inside": pa.float64(),
                "word": pa.string(), "keys": pa.list_(pa.int64()), "line_key": pa.int64(), "line_training": pa.bool_(),
                "number": pa.int64(), "piece": pa.int64(), "size": pa.int64(), "line": pa.binary()})
            for part in slices(batch, text_column, SLICE_BYTES):
                found, starts = words(part[text_column], SPACED)
                distinct, codes = encoded(found)
                sub, begins = word_ids(distinct)
                lengths = np.diff(begins)[codes]
                at = spans(begins[codes], lengths)
                before = np.concatenate(([0], np.cumsum(lengths)))[starts]
                # the end before the first text and after each: it is also the one before the next text
                line = np.insert(classes[sub][at], before, classes[end_id])
                ends = before[1:] + np.arange(1, len(before))
                share = np.concatenate(([0.0], np.cumsum(in_class[sub])))
                share = (share[begins[1:]] - share[begins[:-1]])[codes]
                # heavy words have their counts here, the others go out with their texts
                c = heavy[np.asarray(pc.fill_null(pc.index_in(distinct, value_set=names), -1)) + 1]
                text_of = owners(starts)
                keys = row + np.arange(len(part), dtype=np.int64)
                light = c[codes] == 0
                docs_out = {
                    "key": pa.array(keys), "id": part[id_column], "training": part[training],
                    "n_tokens": pa.array(np.diff(starts) + 1),
                    "n_heavy": pa.array(per_text(~light, starts)),
                    "heavy": pa.array(np.bincount(text_of, np.log10(c + 1.0)[codes], len(part))),
                    "inside": pa.array(np.bincount(text_of, share, len(part)) + in_class[end_id]),
                }
                order = np.argsort(codes[light], kind="stable")
                code, own = codes[light][order], keys[text_of[light]][order]
                first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(code)).astype(np.int32)), pa.array(own))
                words_out = {"word": distinct.take(pa.array(code[first])), "keys": lists}
                text, piece, start, stop, tail = _cut(ends)
                data = line.tobytes()
                lines_out = {
                    "line_key": pa.array(keys[text]), "line_training": part[training].take(pa.array(text)),
                    "number": pa.array(number + np.arange(len(text), dtype=np.int64)), "piece": pa.array(piece),
                    "size": pa.array(stop - start),
                    "line": pa.array([data[i:j] for i, j in zip(start.tolist(), tail.tolist())], pa.binary())}
                row, number = row + len(part), number + len(text)
                for rows in (docs_out, words_out, lines_out):
                    length = len(next(iter(rows.values())))
                    yield pa.RecordBatch.from_arrays(
                        [rows[f.name].cast(f.type) if f.name in rows else pa.nulls(length, f.type) for f in shape],
                        schema=shape)

    return in_batches(docs.select(id_column, text_column, training), run, (
        f"key long, id {kind}, training boolean, n_tokens long, n_heavy long, heavy double, inside double, word string, "
        "keys array<long>, line_key long, line_training boolean, number long, piece long, size long, line binary"))


def lines_to_learn(parts: DataFrame) -> DataFrame:
    """(number, line) of the training texts: windows over these lines predict every id once."""
    return parts.where("line_training").select("number", F.expr("substring(line, 1, CAST(size AS INT))").alias("line"))


def training_lines(docs: DataFrame, tokenizer: str, end_id: int, class_of: np.ndarray,
                   text_column: str = "text") -> DataFrame:
    """`lines_to_learn` of texts that are all for training."""
    return lines_to_learn(encode(
        docs.select(text_column, F.lit(0).alias("_id"), F.lit(True).alias("_training")), "_training", tokenizer, end_id,
        class_of, np.zeros(len(class_of)), {}, "_id", text_column))


def line_scores(parts: DataFrame, flat: np.ndarray) -> DataFrame:
    """(key, lm): natural log probability of each text's classes."""
    sent = parts.sparkSession.sparkContext.broadcast(flat)

    def run(batches):
        weights = attention.unpacked(sent.value)
        for batch in batches:
            data = b"".join(batch["line"].to_pylist())
            sizes = np.asarray(pc.binary_length(batch["line"])).astype(np.int64)
            found = attention.line_scores(weights, np.frombuffer(data, np.uint8), np.cumsum(sizes) - sizes, sizes - 1,
                                          np.asarray(batch["piece"]) > 0)
            yield pa.RecordBatch.from_arrays([batch["line_key"], pa.array(found)], names=["key", "lm"])

    lines = parts.where("line IS NOT NULL").select("line_key", "piece", "line")
    return in_batches(lines, run, "key long, lm double").groupBy("key").agg(F.sum("lm").alias("lm"))


def _window_arrays(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive windows over all classes of the lines: before, after, and which places count."""
    flat = np.frombuffer(b"".join(lines), np.uint8)
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    last = np.cumsum(sizes) - 1
    windows = -(-(sizes - 1) // attention.WINDOW)
    of = np.repeat(np.arange(len(lines)), windows)
    start = (last - sizes + 1)[of] + attention.WINDOW * spans(np.zeros(len(lines), np.int64), windows)
    at = start[:, None] + np.arange(attention.WINDOW)
    wanted = at < last[of, None]
    at = np.minimum(at, len(flat) - 2)
    return (np.where(wanted, flat[at], 0).astype(np.int16), np.where(wanted, flat[at + 1], 0).astype(np.int16), wanted)


def fit(lines: DataFrame, log_share: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Weights after `rounds` of training on shards and averaging; each round goes once over every line.
    `lines` is read several times, so it should come from a stored table."""
    flat = attention.packed(attention.start_weights(log_share))
    total = lines.agg(F.sum(F.ceil((F.length("line") - 1) / attention.WINDOW))).first()[0]
    if not total:
        return flat
    shards = max(1, total // SHARD_WINDOWS)
    # by number and not by content: equal texts spread over all shards
    dealt = lines.withColumn("shard", F.pmod(F.xxhash64("number"), F.lit(shards)))
    for _ in range(rounds):
        start = dealt.sparkSession.sparkContext.broadcast(flat)

        def train(key, table):
            arrays = _window_arrays(table.sort_by("number")["line"].to_pylist())
            after = attention.packed(attention.train(attention.unpacked(start.value), *arrays))
            return pa.table({"shard": [key[0].as_py()], "weight": [float(len(arrays[0]))],
                             "flat": pa.array([after.tobytes()], pa.binary())})

        def average(key, table):
            weight = np.asarray(table["weight"])
            sums = sum(w * np.frombuffer(f, np.float32).astype(float) for w, f in zip(weight, table["flat"].to_pylist()))
            return pa.table({"shard": [key[0].as_py()], "weight": [weight.sum()],
                             "flat": pa.array([(sums / weight.sum()).astype(np.float32).tobytes()], pa.binary())})

        schema, left = "shard long, weight double, flat binary", shards
        models = dealt.groupBy("shard").applyInArrow(train, schema)
        while left > 64:  # groups of 64 models until one group is left
            left = -(-left // 64)
            models = models.withColumn("shard", F.pmod("shard", F.lit(left))).groupBy("shard").applyInArrow(average, schema)
        found = models.collect()
        whole = sum(r["weight"] for r in found)
        flat = (sum(r["weight"] * np.frombuffer(r["flat"], np.float32).astype(float) for r in found) / whole).astype(np.float32)
    return flat


def score(docs: DataFrame, training: str, tokenizer: str, end_id: int, id_column: str = "doc_id",
          text_column: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text.
    `training` is a boolean column of `docs`: whether the text is learned from."""
    spark = docs.sparkSession
    learned = docs.where(F.col(training))
    counts = stored(word_counts(learned, text_column), "lm_counts")
    known = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    ends = learned.count()
    n, v = (known["n"] or 0) + ends, known["v"] + (1 if ends else 0)
    heavy = {r["word"]: r["n"] for r in counts.where(F.col("n") * HEAVY >= n).collect()}  # at most HEAVY words
    size = LibraryEncoder(tokenizer).tokenizer.get_vocab_size()
    ids = id_counts(counts, tokenizer, size)
    ids[end_id] += ends
    class_of, in_class, log_share = attention.vocabulary(ids, end_id)
    parts = stored(encode(docs, training, tokenizer, end_id, class_of, in_class, heavy, id_column, text_column), "lm_parts")
    scored = line_scores(parts, fit(lines_to_learn(parts), log_share))
    texts = parts.where("key IS NOT NULL").select("key", "id", "training", "n_tokens", "n_heavy", "heavy", "inside")
    met = parts.where("word IS NOT NULL").select("word", "keys").join(
        counts.select("word", F.col("n").alias("c")), "word")  # a word without a count adds log10(1) = 0
    rare = (met.select(F.explode("keys").alias("key"), F.log10(F.col("c") + 1.0).alias("part"))
            .groupBy("key").agg(F.sum("part").alias("rare"), F.count("*").alias("n_rare")))
    end_part = math.log10(ends + 1)
    base = (F.col("heavy") + F.coalesce("rare", F.lit(0.0)) + end_part
            - F.col("n_tokens") * F.lit(math.log10(n + v + 1)))
    return texts.join(rare, "key", "left").join(scored, "key").select(
        F.col("id").alias(id_column), (~F.col("training")).alias("held_out"), "n_tokens",
        (F.col("n_heavy") + F.coalesce("n_rare", F.lit(0)) + (1 if ends else 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"),
        ((F.col("inside") + F.col("lm")) / math.log(10)).alias("score"))
