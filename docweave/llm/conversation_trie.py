"""Prefix trie of conversations by collapsing whole sequences.

A conversation is its rows in order of turn (NULL first; rows of one turn by the md5 of role and text).
NULL roles and texts count as empty; rows without a conv_id belong to no conversation and take no part.
`rebuilt` replaces the first turns of each conversation by those of the one that heads its block of ids.

The trie is never walked. Identical rebuilt conversations become one weighted sequence, known by its smallest
conv_id (groups of copies are summed before the shuffle); a sequence whose key is a proper prefix of
another one is dropped from the leaves by an anti-join; then the prefixes of the weighted sequences
are aggregated by key, which gives members and leaves of every node. A node belongs to the sequence
with its smallest conv_id, so the nodes that a sequence owns are the lower end of its path, and a
running sum up that path followed by one aggregation gives the sum over each node's subtree.

The key of a prefix is the md5 of four running sums of hashes of (place, role, text): sums need no order, so
a long conversation is cut into segments of turns that are summed apart and then offset.
Texts leave the scan as digests and word counts. Ids that end at a node are listed in pieces of bounded
size, and the digest streams over the sorted pieces, so no list is ever whole.

Empty input gives no node, not even a root. Repeated rows are turns of their own."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from docweave.llm.common import in_batches
from docweave.sources.storage import stored

SEGMENT_BITS = 10  # 1,024 turns are summed in one group
ENDS_BITS = 12     # a piece lists ids from a span of 4,096
BLOCK = 20         # conversations that share a head
HEADS = 4          # a conversation takes crc32(id) % HEADS turns from its block's head
# Fixed value: a word is a run of other characters than these.
NOT_SPACE = r"[^\x20\x09-\x0D]+"
SUMS = ("_s0", "_s1", "_s2", "_s3")


def turns(conversations: DataFrame) -> DataFrame:
    """`(conv_id, place, said, words)`: each turn's place in its conversation (from 0), the digest of its role
    and text, and its number of words. Only digests are shuffled."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("said"),
        F.regexp_count(text, F.lit(NOT_SPACE)).cast("long").alias("words"))
    # NULL turns come first, so they form the segment before all others
    segment = F.shiftright("turn", SEGMENT_BITS)
    rows = rows.withColumn("_segment", segment)
    inside = Window.partitionBy("conv_id", "_segment").orderBy(F.col("turn").asc_nulls_first(), "said")
    counts = rows.groupBy("conv_id", "_segment").agg(F.count("*").alias("n"))
    before = _before(counts, "n", Window.partitionBy("conv_id").orderBy(F.col("_segment").asc_nulls_first()))
    before = before.select(F.col("conv_id").alias("_c"), F.col("_segment").alias("_g"), F.col("n").alias("_n"))
    placed = rows.withColumn("_row", F.row_number().over(inside)).join(
        before, (F.col("conv_id") == F.col("_c")) & F.col("_segment").eqNullSafe(F.col("_g")), "left")
    return placed.select("conv_id", (F.col("_row") - 1 + F.coalesce("_n", F.lit(0))).cast("long").alias("place"),
                         "said", "words")


def _before(totals: DataFrame, *columns) -> DataFrame:
    """Totals of the segments before each segment, for conversations of more than one segment. One row for each
    segment, not for each turn; the first segment of a conversation needs none."""
    *names, order = columns
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    sums = totals.select(*[c for c in totals.columns if c not in names],
                         *[F.sum(c).over(earlier).alias(c) for c in names])
    return sums.where(F.col(names[0]).isNotNull())


def rebuilt(rows: DataFrame, block: int = BLOCK, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Conversations with the head of their block: the first h = crc32(id) % heads turns of conversation
    id - id % block, then the own turns after the first h.

    Returns (`conv_id` of every conversation, also those without any turn left; `turns` as above)."""
    known = rows.groupBy("conv_id").agg(F.count("*").alias("n")).select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % block).alias("_base"), _head("conv_id", heads).alias("_h"))
    first = F.struct("place", "said", "words")
    # at most heads - 1 turns for each base
    base = rows.where((F.col("conv_id") % block == 0) & (F.col("place") < heads - 1)).groupBy(
        F.col("conv_id").alias("_base")).agg(F.array_sort(F.collect_list(first)).alias("_head"))
    known = known.join(base, "_base", "left")
    taken = F.slice(F.coalesce("_head", F.array().cast("array<struct<place:bigint,said:binary,words:bigint>>")),
                    F.lit(1), F.col("_h"))
    known = known.select("conv_id", "_h", taken.alias("_head"))
    own = rows.where(F.col("place") >= _head("conv_id", heads)).join(
        known.select("conv_id", "_h", F.array_size("_head").alias("_m")), "conv_id").select(
        "conv_id", (F.col("place") - F.col("_h") + F.col("_m")).alias("place"), "said", "words")
    head = known.select("conv_id", F.inline("_head"))
    return known.select("conv_id"), head.unionByName(own)


def _head(column: str, heads: int) -> Column:
    return F.crc32(F.col(column).cast("string")) % heads


def _parts() -> list[Column]:
    """Four 32-bit hashes of place and digest; their sums stay whole numbers far below 2^63."""
    low = F.lit(0xFFFFFFFF)
    one, two = F.xxhash64("place", "said"), F.xxhash64("said", "place", F.lit(7))
    halves = (one.bitwiseAND(low), F.shiftrightunsigned(one, 32), two.bitwiseAND(low), F.shiftrightunsigned(two, 32))
    return [h.alias(s) for h, s in zip(halves, SUMS)]


def _key(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(" ", *[c.cast("string") for c in (depth, *sums)])))


def sequences(conversations: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Collapse identical conversations.

    Returns (`seq, depth, key, weight` for each distinct sequence, named by its smallest conv_id;
    `conv_id, key` of every conversation's end)."""
    none = [F.coalesce(F.sum(p), F.lit(0)).alias(s) for p, s in zip(_parts(), SUMS)]
    whole = conversations.join(
        turns.groupBy("conv_id").agg(F.count("*").alias("depth"), *none), "conv_id", "left")
    depth = F.coalesce("depth", F.lit(0))
    key = _key(depth, [F.coalesce(s, F.lit(0)) for s in SUMS])
    ends = stored(whole.select("conv_id", depth.alias("depth"), key.alias("key")), "trie_ends")
    found = ends.groupBy("key").agg(F.min("conv_id").alias("seq"), F.first("depth").alias("depth"),
                                    F.count("*").alias("weight"))
    return stored(found, "trie_sequences"), ends.select("conv_id", "key")


def prefixes(found: DataFrame, turns: DataFrame) -> DataFrame:
    """`(seq, depth, key, parent, words)`: every prefix of every distinct sequence, the empty one included."""
    mine = turns.join(found.select(F.col("seq").alias("conv_id")), "conv_id", "left_semi")
    rows = mine.select(F.col("conv_id").alias("seq"), (F.col("place") + 1).alias("depth"), "words", *_parts())
    rows = rows.withColumn("_segment", F.shiftright("depth", SEGMENT_BITS))
    upto = Window.partitionBy("seq", "_segment").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    totals = rows.groupBy("seq", "_segment").agg(*[F.sum(s).alias(s) for s in SUMS])
    before = _before(totals, *SUMS, Window.partitionBy("seq").orderBy("_segment"))
    before = before.select("seq", "_segment", *[F.col(s).alias(f"{s}_b") for s in SUMS])
    rows = rows.select("seq", "_segment", "depth", "words", *SUMS, *[F.sum(s).over(upto).alias(f"{s}_u") for s in SUMS])
    rows = rows.join(before, ["seq", "_segment"], "left")
    sums = [F.col(f"{s}_u") + F.coalesce(f"{s}_b", F.lit(0)) for s in SUMS]
    rows = rows.select("seq", "depth", _key(F.col("depth"), sums).alias("key"),
                       _key(F.col("depth") - 1, [t - F.col(s) for t, s in zip(sums, SUMS)]).alias("parent"), "words")
    top = found.select("seq", F.lit(0).cast("long").alias("depth"), _key(F.lit(0), [F.lit(0)] * 4).alias("key"),
                       F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("words"))
    return rows.unionByName(top)


def end_digests(ends: DataFrame) -> DataFrame:
    """`(key, ends_sha256)` of `(key, conv_id)`: sha256 of the ascending ids, comma-joined."""
    pieces = ends.groupBy("key", F.shiftright("conv_id", ENDS_BITS).alias("piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    dealt = pieces.repartition("key").sortWithinPartitions("key", "piece")

    def run(batches):
        key, digest = None, None
        for batch in batches:
            done = []
            for k, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist()):
                if k == key:
                    digest.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])],
                                             names=["key", "ends_sha256"])

    return in_batches(dealt, run, "key binary, ends_sha256 string")


def nodes(found: DataFrame, paths: DataFrame) -> DataFrame:
    """`(key, parent, depth, conv_id, n_convs, n_leaves, n_children, saved_tokens)` of every node."""
    proper = paths.select("seq", "depth", "key").join(
        found.select("seq", F.col("depth").alias("_whole")), "seq").where("depth < _whole").select("key").distinct()
    leaves = found.join(proper, "key", "left_anti").select("seq", F.lit(1).cast("long").alias("leaf"))
    weighted = found.select("seq", "weight").join(leaves, "seq", "left")
    held = stored(paths.join(weighted, "seq").groupBy("key").agg(
        F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.first("words").alias("words"),
        F.min("seq").alias("conv_id"), F.sum("weight").alias("n_convs"),
        F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves")), "trie_nodes")

    # what each node saves, on the path of the one sequence that owns it; summed upwards
    saved = held.select(F.col("conv_id").alias("seq"), "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    path = paths.select("seq", "depth", "key").join(saved, ["seq", "depth"], "left").select(
        "seq", F.shiftright("depth", SEGMENT_BITS).alias("_segment"), "depth", "key",
        F.coalesce("saved", F.lit(0)).alias("saved"))
    down = Window.partitionBy("seq", "_segment").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    totals = path.groupBy("seq", "_segment").agg(F.sum("saved").alias("saved"))
    below = _before(totals, "saved", Window.partitionBy("seq").orderBy(F.col("_segment").desc()))
    below = below.select("seq", "_segment", F.col("saved").alias("_below"))
    path = path.withColumn("_down", F.sum("saved").over(down)).join(below, ["seq", "_segment"], "left")
    subtree = path.groupBy("key").agg(F.sum(F.col("_down") + F.coalesce("_below", F.lit(0))).alias("saved_tokens"))
    children = held.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(
        F.count("*").alias("n_children"))
    return (held.join(subtree, "key").join(children, "key", "left")
            .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
            .select("key", "parent", "depth", "conv_id", "n_convs", "n_leaves", "n_children", "saved_tokens"))


def trie(conversations: DataFrame, block: int = BLOCK, heads: int = HEADS) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations: `conv_id` (its smallest member), `depth`,
    `parent_conv_id`, `n_convs`, `n_children`, `n_leaves`, `saved_tokens` (words that sharing saves in
    its subtree) and `ends_sha256` (the ids of conversations that end there)."""
    rows = stored(turns(conversations), "trie_turns")
    known, whole = rebuilt(rows, block, heads)
    whole = stored(whole, "trie_rebuilt")
    found, ends = sequences(known, whole)
    paths = stored(prefixes(found, whole), "trie_prefixes")
    made = stored(nodes(found, paths), "trie_counted")
    # every first turn has the root as parent: one value, not a join; deeper parents are a join that AQE can split
    root = made.where("depth = 0").agg(F.min("conv_id")).scalar()
    parents = made.select(F.col("key").alias("parent"), F.col("conv_id").alias("_parent"), "n_children", "depth")
    parents = parents.where("n_children > 0 AND depth > 0").select("parent", "_parent")
    deep = made.where("depth > 1").join(parents, "parent", "left")
    flat = made.where("depth <= 1").withColumn("_parent", F.when(F.col("depth") == 1, root))
    both = deep.unionByName(flat).join(end_digests(ends), "key", "left")
    return both.select("conv_id", "depth", F.col("_parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                       "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
