"""Stored postings in blocks of rows: full-text search that opens only its words' folders and skips blocks.

A block holds the rows whose ids hash to it, about `BLOCK_ROWS` of them. One row of the index is a word in a block:
how many rows hold it, its greatest count and the least length among them, and the entries
`(_id, tf, len, sign)`. Rows lie in folders by a hash of the word, sorted by word.

Count and length give an upper bound of what a word can add to any score in a block, for whatever statistics
hold by then. A search reads only these bounds first, scores the blocks that promise most for each query, and
then those whose bound reaches the k-th score found there. All others hold no result.

Changes are further rows of the same form: the entries of a changed or removed text once more with sign -1,
the new ones with sign 1. Scores are sums of whole numbers, so old entries cancel exactly, and word
statistics are sums over signs. `folded` merges them into one."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, functions as F, types as T

from docweave.errors import InvalidInputError
from docweave.functions.scores import BestScores, asked_of, groups
from docweave.functions.text import Tokenizer, tokens
from docweave.operators.fulltext import B, K1, SCALE, part_of_score
from docweave.plans import sizing
from docweave.plans.ranking import top_k
from docweave.plans.sizing import broadcast_if_small
from docweave.schema import DOCUMENT, ID
from docweave.sources.storage import stored, tidy

BLOCK_ROWS = 256
FOLDERS = 64
FIRST_BLOCKS = (4, 64)  # blocks scored first for each query: as many as hits are asked for, within these
SHARE_BLOCKS = 1024  # blocks of a word that go into one file
PACK_BYTES = 32 * 1024 * 1024  # index rows that are packed at a time on their way to their folders
SLACK = 4           # units of 1/SCALE by which rounding may lift a score over its bound


@dataclass(frozen=True)
class Totals:
    """Rows with a text, and the words in all of them."""

    rows: int
    words: int


@dataclass(frozen=True)
class BlockIndex:
    """An index as read: its rows, the statistics of the collection, and how it was made. A search scores it in so many
    `rounds` of some blocks each, if it knows the number of `blocks`."""

    frame: DataFrame
    totals: Totals
    folders: int
    tokenizer: Tokenizer = tokens
    blocks: int | None = None
    rounds: int = 1


def counted(rows: DataFrame, tokenizer: Tokenizer = tokens) -> DataFrame:
    """`rows(_id, document[, sign])` with their words for their texts, stored: `totals` and `entries` read both."""
    return stored(_words_of(rows, tokenizer), "text_words")


def _texts_of(rows: DataFrame) -> DataFrame:
    """`(_id, document, sign)` of the rows with a text."""
    sign = F.col("sign") if "sign" in rows.columns else F.lit(1)
    return rows.select(ID, DOCUMENT, sign.cast("int").alias("sign")).where(F.col(DOCUMENT).isNotNull())


def _words_of(rows: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """`(_id, sign, words)`."""
    if "words" in rows.columns:
        return rows
    return _texts_of(rows).select(ID, "sign", tokenizer(F.col(DOCUMENT)).alias("words"))


def _block_of(blocks: int) -> Column:
    return F.pmod(F.xxhash64(ID), F.lit(blocks)).cast("int")


def changes(before: DataFrame, after: DataFrame, blocks: int, low: int = 0, high: int | None = None) -> DataFrame:
    """`(_id, document, sign, block)` of the texts of blocks from `low` up to `high` that went (-1) and that came (1)
    between two states with unique ids, dealt and sorted by block, in one shuffle; a text that stayed is not in it."""
    sides = [rows.select(ID, DOCUMENT, F.lit(sign).alias("sign"), _block_of(blocks).alias("block"))
             for rows, sign in ((before, -1), (after, 1))]
    both = sides[0].unionByName(sides[1])
    if low or high is not None and high < blocks:
        both = both.where((F.col("block") >= low) & (F.col("block") < high))
    met = both.repartition("block").groupBy("block", ID).agg(
        *[F.max(F.when(F.col("sign") == sign, F.col(DOCUMENT))).alias(name) for name, sign in (("_went", -1), ("_came", 1))])
    each = F.array(*[F.struct(F.col(name).alias(DOCUMENT), F.lit(sign).alias("sign"))
                     for name, sign in (("_went", -1), ("_came", 1))])
    changed = met.where(~F.col("_went").eqNullSafe(F.col("_came"))).select("block", ID, F.inline(each))
    return changed.where(F.col(DOCUMENT).isNotNull())


_ENTRY = pa.struct([("_id", pa.string()), ("tf", pa.int64()), ("len", pa.int64()), ("sign", pa.int32())])
_GROUPED = ("token string, block int, n bigint, max_tf bigint, min_len bigint, "
            "entries array<struct<_id: string, tf: bigint, len: bigint, sign: int>>")


def entries(rows: DataFrame, blocks: int, folders: int = FOLDERS, tokenizer: Tokenizer = tokens) -> DataFrame:
    """Index rows `(folder, token, block, n, max_tf, min_len, entries)` of `rows(_id, document[, sign])`, or of what
    `counted` or `changes` made of them. Rows are dealt by block as texts and cut into words there, in one array, so no
    word is a row of its own before those of a block are counted."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in groups(batches, "block"):
            for one in _by_value(some, "block"):
                yield from _block_entries(one).to_batches()

    if "block" not in rows.columns:
        rows = rows if "words" in rows.columns else _texts_of(rows)
        rows = rows.withColumn("block", _block_of(blocks)).repartition("block")
    words = F.col("words") if "words" in rows.columns else tokenizer(F.col(DOCUMENT)).alias("words")
    grouped = rows.sortWithinPartitions("block").select(ID, "sign", words, "block").mapInArrow(count, _GROUPED)
    return grouped.select(folder_of("token", folders).alias("folder"), *grouped.columns)


def _block_entries(rows: pa.Table) -> pa.Table:
    """Index rows of one block's rows `(_id, sign, words, block)`."""
    rows = rows.combine_chunks()
    lists = rows["words"].combine_chunks()
    length = pc.list_value_length(lists).to_numpy().astype(np.int64)
    words = lists.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(rows)), length)
    pairs, tf = np.unique(words.indices.to_numpy().astype(np.int64) * len(rows) + row, return_counts=True)
    word, row = pairs // len(rows), pairs % len(rows)
    starts = np.flatnonzero(np.diff(word, prepend=-1))
    sign, length = rows["sign"].to_numpy().astype(np.int32)[row], length[row]
    entry = pa.StructArray.from_arrays(
        [rows[ID].combine_chunks().take(pa.array(row)).cast(pa.string()), pa.array(tf.astype(np.int64)),
         pa.array(length), pa.array(sign)], fields=list(_ENTRY))
    offsets = pa.array(np.append(starts, len(word)).astype(np.int32))
    some = len(starts) > 0

    def each(ufunc: np.ufunc, values: np.ndarray) -> pa.Array:
        return pa.array(ufunc.reduceat(values.astype(np.int64), starts) if some else np.empty(0, np.int64))

    return pa.table({"token": words.dictionary.take(pa.array(word[starts])).cast(pa.string()),
                     "block": pa.array(np.full(len(starts), rows["block"][0].as_py() if len(rows) else 0, np.int32)),
                     "n": each(np.add, sign), "max_tf": each(np.maximum, tf), "min_len": each(np.minimum, length),
                     "entries": pa.ListArray.from_arrays(offsets, entry)})


def folder_of(token: str, folders: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(folders)).cast("int")


def totals(rows: DataFrame, tokenizer: Tokenizer = tokens) -> Totals:
    """Of `rows(_id, document[, sign])`, or of what `counted` made of them."""
    held = _words_of(rows, tokenizer).select(
        F.col("sign").cast("long").alias("s"), F.array_size("words").cast("long").alias("n"))
    found = held.agg(F.coalesce(F.sum("s"), F.lit(0)), F.coalesce(F.sum(F.col("s") * F.col("n")), F.lit(0))).first()
    return Totals(int(found[0]), int(found[1]))


def words_in(index: DataFrame) -> int:
    """Words in all texts of some index rows: those that came less those that went."""
    each = F.aggregate(F.zip_with("entries.tf", "entries.sign", lambda tf, sign: tf * sign), F.lit(0).cast("long"),
                       lambda total, n: total + n)
    return int(index.agg(F.coalesce(F.sum(each), F.lit(0))).first()[0])


_ROWS = pa.schema([("folder", pa.int32()), ("token", pa.string()), ("block", pa.int32()), ("n", pa.int64()),
                   ("max_tf", pa.int64()), ("min_len", pa.int64()), ("entries", pa.list_(_ENTRY))])


def write_entries(index: DataFrame, location: str) -> None:
    """Store index rows in folders, besides those that are there. A folder is cut by ranges of `SHARE_BLOCKS` blocks, so
    the blocks of a very common word go to many tasks, and words are sorted within files.

    On their way rows of one folder and range are packed together: as rows of their own they take several times the
    disk of what is stored."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) >= PACK_BYTES:
                yield _packed(held)
                held = []
        if held:
            yield _packed(held)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held in batch["held"]:
                yield from pq.read_table(pa.BufferReader(held.as_buffer())).cast(_ROWS).to_batches()

    packs = index.select(*_ROWS.names).mapInArrow(pack, "folder int, share int, held binary")
    dealt = packs.repartition("folder", "share").mapInArrow(unpack, f"folder int, {_GROUPED}")
    dealt = dealt.sortWithinPartitions("folder", "token", "block")
    dealt.write.mode("append").option("compression", "zstd").partitionBy("folder").parquet(location)


def _packed(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Index rows as one row for each folder and range of blocks, which holds them as a Parquet file."""
    rows = pa.Table.from_batches(batches).cast(_ROWS)
    folder, share = rows["folder"].to_numpy(), rows["block"].to_numpy() // SHARE_BLOCKS
    order = np.lexsort((share, folder))
    rows = rows.take(pa.array(order)).combine_chunks()
    folder, share = folder[order], share[order]
    cuts = np.flatnonzero((np.diff(folder, prepend=-1) != 0) | (np.diff(share, prepend=-1) != 0))
    files = []
    for low, high in zip(cuts, np.append(cuts[1:], len(rows))):
        file = pa.BufferOutputStream()
        pq.write_table(rows.slice(low, high - low), file, compression="zstd", write_statistics=False)
        files.append(file.getvalue().to_pybytes())
    return pa.record_batch({"folder": pa.array(folder[cuts], pa.int32()), "share": pa.array(share[cuts], pa.int32()),
                            "held": pa.array(files, pa.binary())})


def folded(index: DataFrame) -> DataFrame:
    """Index rows with all changes merged: entries whose signs sum to nothing go."""
    each = index.select("folder", "token", "block", F.inline("entries"))
    left = each.groupBy("folder", "token", "block", ID, "tf", "len").agg(F.sum("sign").cast("int").alias("sign")).where(
        F.col("sign") != 0)
    grouped = left.groupBy("folder", "token", "block").agg(
        F.sum("sign").alias("n"), F.max("tf").alias("max_tf"), F.min("len").alias("min_len"),
        F.collect_list(F.struct(ID, "tf", "len", "sign")).alias("entries"))
    return grouped.select("folder", "token", "block", "n", "max_tf", "min_len", "entries")


def only_words(index: BlockIndex, words: DataFrame) -> DataFrame:
    """Index rows of some words `(token)`; other folders are not opened."""
    vocabulary = words.select("token").distinct()
    asked = [r[0] for r in vocabulary.select(folder_of("token", index.folders)).distinct().collect()]
    held = index.frame.where(F.col("folder").isin(asked)) if len(asked) < index.folders else index.frame
    return held.join(broadcast_if_small(vocabulary), "token", "left_semi")


@dataclass(frozen=True)
class Plan:
    """What a search has worked out from the bounds: words of the queries, index rows and weights of those words,
    and the blocks of each query with their bounds, best first."""

    words: DataFrame
    rows: DataFrame
    weights: DataFrame
    blocks: DataFrame


def plan(index: BlockIndex, queries: DataFrame, tokenizer: Tokenizer | None = None) -> Plan:
    tokenizer = tokenizer or index.tokenizer
    words = stored(queries.select(
        "query_id", F.explode(F.array_distinct(tokenizer(F.col("text")))).alias("token")), "asked_words")
    rows = only_words(index, words)
    heads = stored(rows.groupBy("token", "block").agg(
        F.sum("n").alias("n"), F.max("max_tf").alias("max_tf"), F.min("min_len").alias("min_len")), "word_bounds")
    rows_held, mean = F.lit(float(index.totals.rows)), F.lit(index.totals.words / max(1, index.totals.rows))
    found = heads.groupBy("token").agg(F.sum("n").alias("df")).where("df > 0")
    rarity = (rows_held - F.col("df") + 0.5) / (F.col("df") + 0.5)
    weights = stored(found.select("token", F.log1p(rarity).alias("idf"), mean.alias("mean_len")), "word_weights")
    bound = part_of_score(F.col("idf"), F.col("max_tf"), F.col("min_len"), F.col("mean_len")) + SLACK
    bounds = heads.join(broadcast_if_small(weights), "token").select("token", "block", "n", bound.alias("bound"))
    blocks = bounds.join(broadcast_if_small(words), "token").groupBy("query_id", "block").agg(
        F.sum("bound").alias("bound"), F.sum("n").alias("n"))
    return Plan(words, rows, weights, stored(blocks, "block_bounds"))


def scored(plan: Plan, chosen: DataFrame, allowed: DataFrame | None) -> DataFrame:
    """`(query_id, _id, part)` of the rows in the chosen `(query_id, block)` that hold any of the query's words."""
    wanted = plan.words.join(broadcast_if_small(plan.weights), "token").join(chosen.select("query_id", "block"), "query_id")
    each = plan.rows.select("token", "block", "entries").join(wanted, ["token", "block"]).select(
        "query_id", "idf", "mean_len", F.inline("entries"))
    if allowed is not None:
        each = each.join(allowed, ID, "left_semi")
    part = part_of_score(F.col("idf"), F.col("tf"), F.col("len"), F.col("mean_len")) * F.col("sign")
    return each.groupBy("query_id", ID).agg(F.sum(part).alias("part")).where("part > 0")


def best_scored(plan: Plan, chosen: DataFrame, k: int, allowed: DataFrame | None, blocks: int | None = None) -> DataFrame:
    """`(query_id, _id, part)`: the hits of `scored` without such as cannot be among the best k of a query.

    Queries whose words fit into every task stay there: index rows and allowed ids meet by block, and the block
    kernel adds each word of a block once, however many queries hold it. `blocks` is the number of blocks that
    the index was made with; ids can be given to a block only with it."""
    if allowed is not None and blocks is None or not sizing.fits(plan.words, sizing.MAX_BROADCAST_ROWS):
        return scored(plan, chosen, allowed)
    words = plan.words.join(broadcast_if_small(plan.weights), "token").where(F.col("query_id").isNotNull())
    found = words.select("query_id", "token", "idf", "mean_len").toArrow()
    asked = asked_of(found)
    if not len(found):
        return scored(plan, chosen, allowed)
    if len(asked.ids) * k > sizing.MAX_TASK_HITS:
        return scored(plan, chosen, allowed)
    first = pc.index_in(asked.tokens, found["token"].combine_chunks())
    idf, mean = (found[c].combine_chunks().take(first).to_numpy() for c in ("idf", "mean_len"))

    # kind 0: queries that want the block, 1: ids that may be hits, 2: its words, with their entries column by column
    none, no_token = F.lit(None), F.lit(None).cast("string")
    kind = "struct<ids: array<string>, tf: array<int>, len: array<int>, sign: array<tinyint>>"
    entries = F.struct(*[F.col(f"entries.{name}") for name in (ID, "tf", "len", "sign")]).cast(kind)
    words_in = plan.rows.select("block", F.lit(2).alias("kind"), none.cast(chosen.schema["query_id"].dataType).alias("query_id"),
                                no_token.alias(ID), "token", entries.alias("entries"))
    wanting = chosen.select("block", F.lit(0), "query_id", no_token, no_token, none.cast(kind))
    each = words_in.union(wanting)
    if allowed is not None:
        ids = allowed.select(_block_of(blocks), F.lit(1),
                             none.cast(chosen.schema["query_id"].dataType), F.col(ID), no_token, none.cast(kind))
        each = each.union(ids)
    filters = allowed is not None

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = BestScores(asked, k)
        for block in groups(batches, "block"):
            for part in _by_value(block, "block"):
                _score_block(best, part, idf, mean, filters)
        yield from best.result().to_batches()

    schema = T.StructType([T.StructField("query_id", chosen.schema["query_id"].dataType), T.StructField(ID, T.StringType()),
                           T.StructField("part", T.LongType())])
    return each.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(scan, schema)


def _by_value(table: pa.Table, column: str) -> Iterator[pa.Table]:
    values = table[column].to_numpy()
    cuts = np.append(np.flatnonzero(np.diff(values, prepend=values[0] - 1)), len(values))
    for low, high in zip(cuts[:-1], cuts[1:]):
        yield table.slice(low, high - low)


def _score_block(best: BestScores, block: pa.Table, idf: np.ndarray, mean: np.ndarray, filters: bool) -> None:
    """Offer the rows of one block to the queries that want it."""
    asked = best.asked
    kind = block["kind"].to_numpy()
    wanting = pc.index_in(block.filter(pa.array(kind == 0))["query_id"].combine_chunks(), asked.ids).drop_null()
    rows = block.filter(pa.array(kind == 2)).combine_chunks()
    if not len(wanting) or not len(rows):
        return
    lists = rows["entries"].combine_chunks().flatten()
    ids, tf, length, sign = (each.flatten() for each in lists)
    words = pc.index_in(rows["token"].combine_chunks(), asked.tokens)
    words = np.repeat(words.fill_null(-1).to_numpy(), pc.list_value_length(lists[0]).to_numpy())
    codes = ids.dictionary_encode("encode")
    place, keep = codes.indices.to_numpy(), words >= 0
    if filters:
        allowed = pc.is_in(codes.dictionary, block.filter(pa.array(kind == 1))[ID].combine_chunks()).to_numpy(False)
        keep &= allowed[place]
    words, place = words[keep], place[keep]
    tf, length, sign = (c.to_numpy()[keep].astype(np.float64) for c in (tf, length, sign))
    # the arithmetic of `part_of_score`, step by step
    share = idf[words] * (tf * (K1 + 1)) / (tf + K1 * ((1 - B) + B * length / mean[words]))
    parts = np.floor(share * float(SCALE) + 0.5).astype(np.int64) * sign.astype(np.int64)
    best.add(codes.dictionary, place, words, parts, np.unique(wanting.to_numpy()).astype(np.int64))


def chosen_blocks(plan: Plan, k: int, allowed: DataFrame | None = None,
                  first: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(blocks scored first, blocks that may hold a result besides), each `(query_id, block, n)`; the hits of the
    first ones are what the second follow from."""
    best, rest, _ = _chosen(plan, k, allowed, first)
    return best, rest


def _best_in_rounds(plan: Plan, chosen: DataFrame, k: int, allowed: DataFrame | None, blocks: int | None,
                    rounds: int) -> DataFrame:
    """`best_scored`; of several rounds each keeps its best k hits of a query in a table, so the entries that meet by
    block are those of some blocks at a time."""
    if blocks is None or min(rounds, blocks) == 1:
        return best_scored(plan, chosen, k, allowed, blocks)
    found = None
    for now in range(rounds):
        some = (F.col("block") >= blocks * now // rounds) & (F.col("block") < blocks * (now + 1) // rounds)
        here = replace(plan, rows=plan.rows.where(some))
        hits = best_scored(here, chosen.where(some), k, allowed, blocks)
        hits = stored(top_k(hits, "query_id", [F.col("part").desc(), F.col(ID)], k), "round_hits").drop("rank")
        found = hits if found is None else found.unionByName(hits)
    return found


def _chosen(plan: Plan, k: int, allowed: DataFrame | None, first: int | None,
            blocks: int | None = None, rounds: int = 1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """`chosen_blocks`, and the best k hits of the first ones."""
    # the k-th score of a few promising blocks bounds the k-th of all; how few only tells how much is skipped
    first = first or min(max(k, FIRST_BLOCKS[0]), FIRST_BLOCKS[1])
    best = stored(top_k(plan.blocks, "query_id", [F.col("bound").desc(), F.col("block")], first), "first_blocks")
    hits = _best_in_rounds(plan, best.select("query_id", "block"), k, allowed, blocks, rounds)
    hits = stored(top_k(hits, "query_id", [F.col("part").desc(), F.col(ID)], k), "first_hits")
    least = hits.where(F.col("rank") == k).select("query_id", F.col("part").alias("least"))
    rest = plan.blocks.join(best.select("query_id", "block"), ["query_id", "block"], "left_anti")
    rest = rest.join(broadcast_if_small(least), "query_id", "left").where(
        F.col("least").isNull() | (F.col("bound") >= F.col("least")))
    return best.select("query_id", "block", "n"), rest.select("query_id", "block", "n"), hits.drop("rank")


def bm25(index: BlockIndex, queries: DataFrame, k: int, allowed: DataFrame | None = None,
         tokenizer: Tokenizer | None = None, first: int | None = None) -> DataFrame:
    """Best k rows by BM25 for each of `queries(query_id, text)`, as `fulltext.bm25` gives them. `allowed` are the
    ids `(_id)` that may be hits; word statistics stay those of the whole collection."""
    if k < 1:
        raise InvalidInputError(f"k must be at least 1, got {k}")
    with tidy(index.frame.sparkSession):
        made = plan(index, queries, tokenizer)
        allowed = None if allowed is None else stored(allowed.select(ID), "allowed")  # read for both scorings
        _, rest, best = _chosen(made, k, allowed, first, index.blocks, index.rounds)
        hits = _best_in_rounds(made, rest, k, allowed, index.blocks, index.rounds)
    hits = best.unionByName(hits)
    ranked = top_k(hits, "query_id", [F.col("part").desc(), F.col(ID)], k)
    return ranked.select("query_id", "rank", ID, (F.col("part") / F.lit(float(SCALE))).alias("score"))
