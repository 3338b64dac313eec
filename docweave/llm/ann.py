"""Approximate nearest neighbours by largest inner product: a navigable small-world graph for each shard.

Rows take part if they have an id and a vector of finite components that are not all zero. Rows of one id count
once, with the least of its vectors in array order. Equal vectors are one node: a third of all rows may be
copies. A node keeps the `k_most + 1` smallest ids of its copies, and no other copy can be among the k_most
nearest of any query, since copies tie and ties go to the smaller id. Vectors of different lengths have no inner
product, so lengths are indexed and searched apart. Empty input gives an empty index and no hits.

Distinct vectors are dealt to shards of about `SHARD_ROWS` by a hash; every one of them is indexed. `build_index`
makes the graph of a shard in one task and stores it as rows with flat neighbour arrays. `search` sends
blocks of queries to every shard, recomputes the inner products of what the graphs found in double precision
from the original vectors, and merges the k best of each shard."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from docweave.llm import hnsw
from docweave.plans.ranking import top_k
from docweave.plans.sizing import broadcast_if_small
from docweave.schema import EMBEDDING
from docweave.sources.storage import stored

SHARD_ROWS = 16_384
SHARD_BYTES = 32 * 1024 * 1024   # of vectors in double precision, should they be very long
BLOCK_QUERIES = 16_384
WIDTH = 192                      # nodes a search keeps in the lowest layer
K_MOST = 20


def usable(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """`(vec_id, embedding, dim)`, one row for each id that takes part."""
    vector = F.col(vector_column)
    if vector_type(rows, vector_column) not in ("float", "double"):
        vector = vector.cast("array<double>")
    kept = rows.select(F.col(id_column).alias("vec_id"), vector.alias(EMBEDDING)).where(
        F.col("vec_id").isNotNull() & F.col(EMBEDDING).isNotNull())
    bad, zero = (F.exists(EMBEDDING, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))),
                 F.forall(EMBEDDING, lambda x: x == 0))
    kept = kept.where(~bad).where(~zero)
    return kept.groupBy("vec_id").agg(F.min(EMBEDDING).alias(EMBEDDING)).withColumn("dim", F.array_size(EMBEDDING))


def vector_type(rows: DataFrame, column: str) -> str:
    return rows.schema[column].dataType.elementType.simpleString()


def distinct_vectors(rows: DataFrame, k_most: int = K_MOST) -> DataFrame:
    """`(key, dim, embedding, members)`: each vector once, with the k_most + 1 smallest ids of its copies."""
    key = F.concat_ws(":", F.xxhash64(EMBEDDING), F.xxhash64(F.lit(1), EMBEDDING))
    # the cut to the smallest ids is made before the shuffle too, so copies do not meet
    few = top_k(rows.withColumn("key", key), "key", [F.col("vec_id")], k_most + 1)
    return few.groupBy("key").agg(F.first("dim").alias("dim"), F.first(EMBEDDING).alias(EMBEDDING),
                                  F.array_sort(F.collect_list("vec_id")).alias("members"))


def build_index(rows: DataFrame, k_most: int = K_MOST, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The stored index of `usable` rows: `(dim, shards, shard, node, level, embedding, members, links)`, one row for each
    distinct vector. `links` holds the neighbours of all its layers one after the other, -1 where none."""
    nodes = stored(distinct_vectors(rows, k_most), "ann_vectors")
    each = F.greatest(F.lit(1), F.least(F.lit(shard_rows), F.floor(F.lit(SHARD_BYTES) / (F.col("dim") * 8))))
    # one row for each length of vector
    sizes = nodes.groupBy("dim").agg(F.ceil(F.count("*") / each).cast("int").alias("shards"))
    dealt = nodes.join(broadcast_if_small(sizes), "dim").select(
        "dim", "shards", F.pmod(F.xxhash64("key", F.lit(2)), F.col("shards")).cast("int").alias("shard"), "key",
        EMBEDDING, "members", ((F.pmod(F.xxhash64("key", F.lit(3)), F.lit(1 << 30)) + 1) / float(1 << 30)).alias("draw"))
    schema = T.StructType([
        T.StructField("dim", T.IntegerType()), T.StructField("shards", T.IntegerType()),
        T.StructField("shard", T.IntegerType()), T.StructField("node", T.IntegerType()),
        T.StructField("level", T.IntegerType()), T.StructField(EMBEDDING, nodes.schema[EMBEDDING].dataType),
        T.StructField("members", nodes.schema["members"].dataType),
        T.StructField("links", T.ArrayType(T.IntegerType()))])

    def make(group: pa.Table) -> pa.Table:
        group = group.sort_by([("draw", "ascending"), ("key", "ascending")])  # the highest levels first
        levels = hnsw.levels_of(group["draw"].to_numpy())
        layers = hnsw.build(hnsw.on_sphere(matrix(group[EMBEDDING])), levels)
        widths = np.cumsum([layer.shape[1] for layer in layers])
        ends = np.cumsum(widths[levels])
        flat = np.empty(int(ends[-1]), np.int32)
        for layer, width in zip(layers, widths):
            at = (ends - widths[levels])[:len(layer), None] + np.arange(width - layer.shape[1], width)[None, :]
            flat[at] = layer
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(flat))
        return pa.table({
            "dim": group["dim"], "shards": group["shards"], "shard": group["shard"],
            "node": pa.array(np.arange(len(group), dtype=np.int32)), "level": pa.array(levels.astype(np.int32)),
            EMBEDDING: group[EMBEDDING], "members": group["members"], "links": lists})

    return stored(dealt.groupBy("dim", "shard").applyInArrow(make, schema), "ann_index")


def matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    flat = vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def _layers(rows: pa.Table) -> list[np.ndarray]:
    """Link matrices from the flat arrays of rows in order of node."""
    levels = rows["level"].to_numpy()
    links = rows["links"].combine_chunks()
    flat, starts = links.flatten().to_numpy(), links.offsets.to_numpy()[:-1] - links.offsets[0].as_py()
    layers, before = [], 0
    for level in range(int(levels.max()) + 1):
        width = hnsw.LINKS * (2 if level == 0 else 1)
        size = int((levels >= level).sum())
        layers.append(flat[starts[:size, None] + np.arange(before, before + width)[None, :]].astype(np.int64))
        before += width
    return layers


def search(index: DataFrame, queries: DataFrame, k: int = K_MOST, width: int = WIDTH) -> DataFrame:
    """`(query_id, rank, vec_id, score)`: the k nearest rows found for each of `queries(vec_id, embedding, dim)` other than
    the query's own id, nearest first, ties to the smaller id. The index must be made with k_most >= k."""
    sizes = broadcast_if_small(index.select("dim", "shards").distinct())
    queries = queries.join(sizes, "dim")  # lengths without an indexed row have no hits
    blocks = -(-max(1, queries.count()) // BLOCK_QUERIES)
    asked = queries.select(
        "dim", F.col("vec_id").alias("query_id"), EMBEDDING, F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    held = index.select("dim", "shard", "node", "level", EMBEDDING, "members", "links",
                        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    ids = index.schema["members"].dataType.elementType
    schema = T.StructType([T.StructField("query_id", queries.schema["vec_id"].dataType), T.StructField("vec_id", ids),
                           T.StructField("score", T.DoubleType())])

    def find(rows: pa.Table, asked: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": asked["query_id"][:0], "vec_id": rows["members"].combine_chunks().flatten()[:0],
                          "score": pa.array([], pa.float64())})
        if not len(rows) or not len(asked):
            return empty
        rows = rows.sort_by("node")
        vectors, layers = matrix(rows[EMBEDDING]), _layers(rows)
        points, members = hnsw.on_sphere(vectors), rows["members"].combine_chunks()
        flat, starts = members.flatten(), members.offsets.to_numpy() - members.offsets[0].as_py()
        parts = [empty]
        for at in range(0, len(asked), hnsw.SEARCH_AT_ONCE):
            part = asked.slice(at, hnsw.SEARCH_AT_ONCE)
            x = matrix(part[EMBEDDING])
            found = hnsw.search(points, layers, hnsw.as_queries(x), min(width, len(points)))
            query, place = np.nonzero(found >= 0)
            node = found[query, place]
            score = (x[query] * vectors[node]).sum(axis=1)
            each = np.diff(starts)[node]
            begins = np.cumsum(each) - each
            copies = pa.array(np.arange(int(each.sum())) + np.repeat(starts[node] - begins, each))
            hits = pa.table({"query": np.repeat(query, each), "vec_id": flat.take(copies), "score": np.repeat(score, each)})
            own = part["query_id"].combine_chunks().take(hits["query"].combine_chunks())
            hits = hits.append_column("query_id", own)
            hits = hits.filter(pc.not_equal(hits["vec_id"], hits["query_id"]))
            hits = hits.sort_by([("query", "ascending"), ("score", "descending"), ("vec_id", "ascending")])
            of = hits["query"].to_numpy()
            best = np.arange(len(of)) - np.searchsorted(of, of) < k
            parts.append(hits.filter(pa.array(best)).select(["query_id", "vec_id", "score"]))
        return pa.concat_tables([p.cast(empty.schema) for p in parts])

    keys = ["dim", "shard", "block"]
    hits = held.groupBy(keys).cogroup(asked.groupBy(keys)).applyInArrow(find, schema)
    ranked = top_k(hits, "query_id", [F.col("score").desc(), F.col("vec_id")], k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
