"""Full-text search: a per-row term index, postings, and BM25 for tables of queries.

The term index is narrow: each row's term counts come from its own text by sorting
its tokens, so building it shuffles nothing. Rows stay whole on their way to the
score. Candidate rows are hash-partitioned by `_id` before queries are matched to
them, so the sum per (query, row) and the first top-k cut happen in that same
stage: a common word lengthens a task's stream, but its matches are not shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from docweave.errors import InvalidInputError
from docweave.functions.scores import BestScores, asked_of, groups
from docweave.functions.text import Tokenizer, tokens
from docweave.plans import sizing
from docweave.plans.ranking import top_k
from docweave.schema import DOCUMENT, ID
from docweave.sources.storage import stored

# The usual BM25 parameters, and the scale at which scores are summed.
# Sums of whole numbers do not depend on their order, so equal texts get equal scores.
K1, B = 1.2, 0.75
SCALE = 10**12

ROWS_AT_ONCE = 100_000  # (word, row) pairs that the kernel takes at a time


def term_index(collection: DataFrame, tokenizer: Tokenizer = tokens) -> DataFrame:
    """The collection with `doc_len` and `terms`, an array of (token, tf) per row, sorted by token.

    Can be written once and given to every search; columns a search filters by must
    be in it. Words are counted as arrays: only they go to the counting function."""
    words = F.arrow_udf(counted_words, "array<struct<token: string, tf: bigint>>")
    return (collection.withColumn("_words", tokenizer(F.col(DOCUMENT)))
            .withColumn("doc_len", F.array_size("_words").cast("bigint"))
            .withColumn("terms", words("_words"))
            .drop("_words"))


def counted_words(rows: pa.Array) -> pa.Array:
    """For each list of words its distinct words, sorted, with their counts; null for a null list. Missing words
    are not counted."""
    lists = rows.filter(rows.is_valid())
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    row = np.repeat(np.arange(len(lists)), size)[flat.is_valid().to_numpy(zero_copy_only=False)]
    codes = flat.drop_null().dictionary_encode()
    order = pc.sort_indices(codes.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    n = max(1, len(order))
    pairs, tf = np.unique(row * n + place[codes.indices.to_numpy()], return_counts=True)
    terms = pa.StructArray.from_arrays(
        [codes.dictionary.take(pa.array(order[pairs % n])).cast(pa.string()), pa.array(tf.astype(np.int64))],
        names=["token", "tf"])
    held = np.zeros(len(rows), np.int64)
    valid = rows.is_valid().to_numpy(zero_copy_only=False)
    held[valid] = np.bincount(pairs // n, minlength=len(lists))[:len(lists)]
    offsets = np.concatenate(([0], np.cumsum(held))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), terms, mask=pa.array(~valid))


def postings(index: DataFrame) -> DataFrame:
    """`(token, _id, tf, doc_len)`, one row per word and row of the collection."""
    # inline_outer, here and below: `inline` would first filter on the array, which
    # computes it twice when the index is not stored.
    rows = index.select(ID, "doc_len", F.inline_outer("terms")).where(F.col("token").isNotNull())
    return rows.select("token", ID, "tf", "doc_len")


def bm25(index: DataFrame, queries: DataFrame, k: int, where: Column | None = None,
         tokenizer: Tokenizer = tokens) -> DataFrame:
    """Best k rows by BM25 for each row of `queries(query_id, text)`.

    Any word of the query matches; a repeated query word counts once. `where` limits
    the hits, while word statistics stay those of the whole collection. Returns
    `(query_id, rank, _id, score)`; ties go to the smaller id.

    A query table too large for one broadcast is cut into blocks of queries, each of
    them broadcast to its own pass over the index."""
    _check_k(k)
    words = queries.select(
        "query_id", F.explode(F.array_distinct(tokenizer(F.col("text")))).alias("token"))
    parts = index if where is None else index.where(where)
    parts = parts.select(ID, "doc_len", F.inline_outer("terms"))
    if sizing.fits(words, sizing.MAX_BROADCAST_ROWS):
        weights = F.broadcast(word_weights(index, words, small=True))
        return _best(_parts(parts, weights), words, k)

    # Twice as many blocks as needed on average, for room around it.
    blocks = 2 * math.ceil(words.count() / sizing.MAX_BROADCAST_ROWS)
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")
    words = stored(words.withColumn("block", block), "query_words", "block")
    weights = word_weights(index, words, small=False)
    parts = stored(_parts(parts, weights), "word_parts")
    hits = [_best(parts, words.where(F.col("block") == b).drop("block"), k) for b in range(blocks)]
    return reduce(DataFrame.unionByName, hits)


def bm25_one(index: DataFrame, text: str, k: int, where: Column | None = None,
             tokenizer: Tokenizer = tokens) -> DataFrame:
    """`bm25` for one text, with query_id 0. `index` is a `term_index`, or just the collection.

    The texts or terms are read once, for what they hold of the asked words; word statistics and scores come from
    that, a stored table of few words a row. The words of one text fit into one array value, so each row is
    scored where it is read and nothing but the best k per task is shuffled."""
    _check_k(k)
    spark = index.sparkSession
    asked = spark.range(1).select(F.array_distinct(tokenizer(F.lit(text))).alias("words")).first()["words"]
    asked = [w for w in asked if w is not None]
    keep = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    if "terms" in index.columns:
        held = index.select(ID, keep.alias("_keep"), "doc_len", F.filter(
            "terms", lambda t: t["token"].isin(asked)).alias("terms"))
    else:
        held = index.select(ID, keep.alias("_keep"), tokenizer(F.col(DOCUMENT)).alias("_words"))
        held = held.select(ID, "_keep", F.array_size("_words").cast("bigint").alias("doc_len"),
                           F.filter("_words", lambda w: w.isin(asked)).alias("_words"))
    held = stored(held, "asked_words")
    if "_words" in held.columns:
        count = F.arrow_udf(counted_words, "array<struct<token: string, tf: bigint>>")
        held = stored(held.withColumn("terms", count("_words")).drop("_words"), "asked_terms")
    words = spark.createDataFrame([(w,) for w in asked], "token string")
    weights = word_weights(held, words, small=True)
    weights = weights.agg(F.array_agg(F.struct("token", "idf", "mean_len"))).scalar()

    rows = held.where("_keep").select(ID, "doc_len", "terms", weights.alias("_weights"))

    def add(total, word):
        place = F.array_position(F.col("terms.token"), word["token"]).cast("int")
        part = _part(word["idf"], F.get(F.col("terms.tf"), place - 1), word["mean_len"])
        return total + F.coalesce(part, F.lit(0).cast("bigint"))

    scored = rows.select(F.lit(0).alias("query_id"), ID,
                         F.aggregate("_weights", F.lit(0).cast("bigint"), add).alias("part"))
    # Rows without a match rank last; dropping them earlier would score every row twice.
    return _ranked(scored, k).where(F.col("score") > 0)


def word_weights(index: DataFrame, words: DataFrame, small: bool) -> DataFrame:
    """`(token, idf, mean_len)` for those of the words that occur in the collection.

    Rows are counted per word before the shuffle, so a common word costs one row per
    task. With few words the others are dropped even before that."""
    vocabulary = words.select("token").distinct()
    seen = index.select(F.inline_outer("terms")).select("token")
    if small:
        seen = seen.join(F.broadcast(vocabulary), "token", "left_semi")
    found = seen.where(F.col("token").isNotNull()).groupBy("token").agg(F.count("*").alias("df"))
    if not small:
        found = found.join(vocabulary, "token", "left_semi")
    corpus = index.agg(F.count("doc_len").alias("n"), F.avg("doc_len").alias("mean_len"))
    found = found.withColumn("_corpus", corpus.select(F.struct("n", "mean_len")).scalar())
    rarity = (F.col("_corpus.n") - F.col("df") + 0.5) / (F.col("df") + 0.5)
    return found.select("token", F.log1p(rarity).alias("idf"), F.col("_corpus.mean_len").alias("mean_len"))


def _parts(rows: DataFrame, weights: DataFrame) -> DataFrame:
    """`(token, _id, part)`: what each asked word adds to the score of each row.

    The same for all queries with that word, so it is worked out before rows and queries
    meet."""
    return rows.join(weights, "token").select(
        "token", ID, _part(F.col("idf"), F.col("tf"), F.col("mean_len")).alias("part"))


def _best(parts: DataFrame, words: DataFrame, k: int) -> DataFrame:
    """Top k per query of few query words. Partitioned by row, parts are summed per (query, row) and cut to k per
    query in the same stage: by the block kernel if the hits of all queries fit into a task, which then holds no
    sums but those of the rows it is at."""
    dealt = parts.repartition(ID)
    if not sizing.fits(words, sizing.MAX_BROADCAST_ROWS):
        return _ranked(_sums(dealt.join(words, "token")), k)
    found = words.select("query_id", "token").toArrow()
    asked = asked_of(found)
    if len(asked.ids) * k > sizing.MAX_TASK_HITS:
        return _ranked(_sums(dealt.join(F.broadcast(words), "token")), k)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = BestScores(asked, k)
        for some in groups(batches, ID, ROWS_AT_ONCE):
            at = pc.index_in(some["token"].combine_chunks(), asked.tokens)
            some = some.filter(at.is_valid())
            ids = some[ID].combine_chunks().dictionary_encode("encode")
            best.add(ids.dictionary, ids.indices.to_numpy(), at.drop_null().to_numpy(), some["part"].to_numpy())
        yield from best.result().to_batches()

    schema = T.StructType([T.StructField("query_id", words.schema["query_id"].dataType), T.StructField(ID, T.StringType()),
                           T.StructField("part", T.LongType())])
    return _ranked(dealt.select(ID, "token", "part").sortWithinPartitions(ID).mapInArrow(scan, schema), k)


def _sums(matches: DataFrame) -> DataFrame:
    return matches.groupBy("query_id", ID).agg(F.sum("part").alias("part"))


def _check_k(k: int) -> None:
    if k < 1:
        raise InvalidInputError(f"k must be at least 1, got {k}")


def _part(idf: Column, tf: Column, mean_len: Column) -> Column:
    return part_of_score(idf, tf, F.col("doc_len"), mean_len)


def part_of_score(idf: Column, tf: Column, doc_len: Column, mean_len: Column) -> Column:
    """Share of one word in a score, as a whole number of 1/SCALE. Grows with tf, falls with doc_len."""
    length = F.lit(1 - B) + F.lit(B) * doc_len / mean_len
    share = idf * (tf * F.lit(K1 + 1)) / (tf + F.lit(K1) * length)
    return F.floor(share * F.lit(float(SCALE)) + 0.5).cast("bigint")


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    ranked = top_k(scored, "query_id", [F.col("part").desc(), F.col(ID)], k)
    return ranked.select("query_id", "rank", ID, (F.col("part") / F.lit(float(SCALE))).alias("score"))
