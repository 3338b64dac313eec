"""Nearest-neighbour search for whole tables of query vectors.

Exact search compares every query with every row, but no frame ever holds the
pairs: each task keeps the best k per query while its rows stream through a block
kernel (Arrow, numpy), and only those k per query and task are shuffled to the final
ranking. Documents and metadata are joined to the finished hits, so they never
enter Python or that shuffle.

A small query table (measured) goes to every task. A large one is cut into blocks;
rows are cut into blocks by a hash of their id, and each pair of blocks is one
bounded cogroup, whatever the key distribution.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from docweave.errors import EmbeddingError, InvalidInputError
from docweave.functions.blocks import BestHits, to_matrix, with_dimension
from docweave.functions.filters import conjunction
from docweave.functions.text import DocFilter, document_predicate
from docweave.plans import sizing
from docweave.plans.ranking import top_k
from docweave.schema import EMBEDDING, ID, distance_name
from docweave.sources.storage import stored

METRICS = ("l2", "cosine", "inner_product", "negative_inner_product")
DEFAULT_INCLUDE = ("document", "metadata")
ID_BYTES = 64  # allowed for each query id
BOUNDED_FROM = 1000  # with more hits than this, blocks of a large query table start from a bound
SHARE_GROWTH = 4


def metric_name(distance: str) -> str:
    """A collection distance, or `negative_inner_product` to rank the most similar first
    (plain `inner_product` ranks ascending, like the true distances)."""
    return distance if distance == "negative_inner_product" else distance_name(distance)


@dataclass(frozen=True)
class Queries:
    """Checked query vectors: a local Arrow table when they fit into every task."""

    frame: DataFrame
    count: int
    dimension: int
    local: pa.Table | None


def check_queries(queries: DataFrame, dimension: int | None, k: int) -> Queries:
    """Check `queries(query_id, embedding[, cells])`: not empty, no NULL, one dimension.

    The count leaves the vectors out, so vectors made on the fly are not made for it."""
    if k < 1:
        raise InvalidInputError(f"k must be at least 1, got {k}")
    keep = [c for c in ("query_id", EMBEDDING, "cells") if c in queries.columns]
    queries = queries.select(keep)
    count = queries.count()
    if count == 0:
        raise InvalidInputError("queries must not be empty")
    if dimension is None:
        dimension = queries.select(F.array_size(EMBEDDING)).first()[0] or 1
    local = None
    row_bytes = dimension * 8 + ID_BYTES
    if "cells" in keep:
        row_bytes += 8 * (queries.select(F.array_size("cells")).first()[0] or 0)
    if count <= min(sizing.MAX_BROADCAST_BYTES // row_bytes, sizing.MAX_TASK_HITS // k):
        local = queries.toArrow()
        sizes = pc.list_value_length(local[EMBEDDING])
        nulls = sizes.null_count + local["query_id"].null_count
        wrong = sorted(set(sizes.drop_null().to_pylist()) - {dimension})
        ids = pc.value_counts(local["query_id"].combine_chunks())
        repeated = ids.filter(pc.greater(ids.field("counts"), 1)).field("values").to_pylist()[:5]
    else:
        queries = stored(queries, "queries")  # read several times from here on
        size = F.array_size(EMBEDDING)
        row = queries.agg(
            F.min(size).alias("low"), F.max(size).alias("high"),
            F.count_if(F.col(EMBEDDING).isNull() | F.col("query_id").isNull()).alias("nulls")).first()
        nulls, wrong = row["nulls"], sorted({row["low"], row["high"]} - {None, dimension})
        repeated = [r[0] for r in queries.groupBy("query_id").count().where("count > 1").limit(5).collect()]
    if nulls:
        raise InvalidInputError(f"{nulls} query rows lack an id or a vector")
    if repeated:
        raise InvalidInputError(f"each query needs an id of its own; repeated: {repeated}")
    if wrong:
        raise InvalidInputError(f"query vectors have {wrong[0]} elements, the collection has {dimension}")
    return Queries(queries, count, dimension, local)


def include_columns(include) -> list[str]:
    """Column list of an include list: None means documents and metadata."""
    names = {"documents": "document", "metadatas": "metadata", "embeddings": "embedding"}
    asked = DEFAULT_INCLUDE if include is None else [names.get(c, c) for c in include]
    unknown = set(asked) - set(names.values())
    if unknown:
        raise InvalidInputError(f"cannot include {sorted(unknown)}")
    return [c for c in ("document", "metadata", "embedding") if c in asked]


def nearest(collection: DataFrame, queries: DataFrame, k: int, distance: str = "cosine",
            where: Column | None = None, where_document: DocFilter | Column | None = None,
            include=None, dimension: int | None = None) -> DataFrame:
    """The k nearest rows for each row of `queries(query_id, embedding)`.

    Filters apply before the cut to k. Rows without a vector are never hits. Returns
    `(query_id, rank, _id, [included columns], distance)`, one row per hit; ties go to
    the smaller id."""
    checked = check_queries(queries, dimension, k)
    rows = filtered(collection, where, where_document).select(ID, EMBEDDING)
    hits = search(rows, checked, k, metric_name(distance))
    return with_columns(hits, collection, include, checked.count * k)


def nearest_texts(collection: DataFrame, queries: DataFrame, k: int, embedder,
                  **options) -> DataFrame:
    """`nearest` for `queries(query_id, text)`, embedded by the given function."""
    return nearest(collection, embed_queries(queries, embedder), k, **options)


def embed_queries(queries: DataFrame, embedder) -> DataFrame:
    if embedder is None:
        raise EmbeddingError("text queries need an embedding function; give one, or give vectors")
    return queries.select("query_id", embedder.embed(F.col("text")).alias(EMBEDDING))


def filtered(collection: DataFrame, where: Column | None,
             where_document: DocFilter | Column | None) -> DataFrame:
    predicate = conjunction(where, document_predicate(where_document))
    return collection if predicate is None else collection.where(predicate)


def with_columns(hits: DataFrame, collection: DataFrame, include, at_most: int) -> DataFrame:
    """Join the included columns to finished hits, of which there are `at_most` so many.

    Few hits are broadcast, so the collection is only scanned; the shuffled join
    beyond that keeps every hit too."""
    extra = include_columns(include)
    scores = [c for c in hits.columns if c not in ("query_id", "rank", ID)]
    if extra:
        if at_most <= sizing.MAX_BROADCAST_ROWS:
            hits = F.broadcast(hits)
        hits = collection.select(ID, *extra).join(hits, ID)
    return hits.select("query_id", "rank", ID, *extra, *scores)


def nested(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """One row per query with its hits as an array in rank order; queries without hits
    keep an empty array."""
    if "metadata" in hits.columns:  # a VARIANT has no order, so it cannot sit in a sorted struct
        hits = hits.withColumn("metadata", F.to_json("metadata"))
    hit = F.struct(*[c for c in hits.columns if c != "query_id"]).alias("hit")
    return (queries.select("query_id").join(hits.select("query_id", hit), "query_id", "left")
            .groupBy("query_id").agg(F.sort_array(F.collect_list("hit")).alias("hits")))


def search(rows: DataFrame, queries: Queries, k: int, metric: str) -> DataFrame:
    """Hits `(query_id, rank, _id, distance)` of rows `(_id, embedding[, cell])`.

    With a `cell` column in `rows`, the queries carry `cells`, the array of cells each
    query looks into; other rows are not compared with it."""
    # Rows without a fitting vector are dropped in the kernel: a filter on a vector that an
    # embedding function makes on the fly would make it twice.
    if queries.local is None and k > min(BOUNDED_FROM, sizing.BLOCK_BYTES // (queries.dimension * 8)):
        return _in_shares(rows, queries, k, metric)
    compare = _with_query_matrix if queries.local is not None else _with_blocks
    return _ranked_hits(compare(rows, queries, k, metric), k)


def _ranked_hits(best: DataFrame, k: int) -> DataFrame:
    ranked = top_k(best, "query_id", [F.col("distance"), F.col(ID)], k)
    return ranked.select("query_id", "rank", ID, "distance")


def _in_shares(rows: DataFrame, queries: Queries, k: int, metric: str) -> DataFrame:
    """Exact hits for a k so large that a block of rows could not leave out any.

    Rows are taken share by share, each SHARE_GROWTH times what came before. The k-th distance among the rows
    seen so far bounds the k-th of all, so it goes with the queries to the next share, whose blocks give back
    only rows within it: about SHARE_GROWTH x k for each query in a share, whatever its size. Every pair is
    compared once."""
    rows = stored(rows, "compared")
    steps, seen = 0, rows.count()
    while seen > SHARE_GROWTH * k:
        steps, seen = steps + 1, seen / SHARE_GROWTH
    shares = SHARE_GROWTH ** steps
    share = F.pmod(F.xxhash64(ID, F.lit("share")), F.lit(shares))
    found, low = None, 0
    for step in range(steps + 1):
        high = SHARE_GROWTH ** step
        part = rows.where((share >= low) & (share < high))
        asked = queries.frame
        if found is not None:
            bound = found.where(F.col("rank") == k).select("query_id", F.col("distance").alias("_bound"))
            asked = asked.join(bound, "query_id", "left")
        hits = _with_blocks(part, Queries(asked, queries.count, queries.dimension, None), k, metric)
        if found is not None:
            hits = hits.unionByName(found.drop("rank"))
        found = stored(_ranked_hits(hits, k), "hits_so_far")
        low = high
    return found


def _hit_schema(queries: DataFrame) -> T.StructType:
    return T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField(ID, T.StringType()),
        T.StructField("distance", T.DoubleType()),
    ])


def _as_hits(best: BestHits, query_ids: pa.Array) -> pa.Table:
    hits = best.result()
    return pa.table({"query_id": query_ids.take(hits["q"].combine_chunks()),
                     ID: hits["_id"], "distance": hits["distance"]})


def _positions_by_cell(probes: list[list[int]]) -> dict[int, np.ndarray]:
    """Query positions that look into each cell."""
    table: dict[int, list[int]] = {}
    for position, cells in enumerate(probes):
        for cell in cells:
            table.setdefault(cell, []).append(position)
    return {cell: np.array(positions) for cell, positions in table.items()}


def _with_query_matrix(rows: DataFrame, queries: Queries, k: int, metric: str) -> DataFrame:
    """Queries as one matrix in every task; rows are scanned in place, no shuffle."""
    by_cell = "cell" in rows.columns
    table, dimension = queries.local, queries.dimension
    query_ids = table["query_id"].combine_chunks()
    matrix = to_matrix(table[EMBEDDING])
    lookup = _positions_by_cell(table["cells"].to_pylist()) if by_cell else None
    if by_cell:
        rows = rows.where(F.col("cell").isin(sorted(lookup)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = BestHits(matrix, k, metric)
        for batch in batches:
            batch = with_dimension(batch, EMBEDDING, dimension)
            ids, vectors = batch.column(ID), to_matrix(batch.column(EMBEDDING))
            if lookup is None:
                best.add(ids, vectors)
                continue
            cells = batch.column("cell").to_numpy()
            for cell in np.unique(cells):
                at = np.flatnonzero(cells == cell)
                best.add(ids.take(pa.array(at)), vectors[at], lookup[cell])
        yield from _as_hits(best, query_ids).to_batches()

    return rows.mapInArrow(scan, _hit_schema(queries.frame))


def _with_blocks(rows: DataFrame, checked: Queries, k: int, metric: str) -> DataFrame:
    """Both sides cut into hash blocks of bounded size, one cogroup per pair of blocks.

    Rows are copied once per query block, the (smaller) query side once per row block. With cells, a
    cell that holds many rows or attracts many queries is cut into as many blocks as
    its own counts ask for."""
    queries = checked.frame
    # Rows are cut by bytes alone: a block of fewer rows than k would return every pair.
    rows_each = max(1, sizing.BLOCK_BYTES // (checked.dimension * 8))
    queries_each = max(1, min(rows_each, sizing.MAX_TASK_HITS // k))

    def blocks(n: Column, each: int) -> Column:
        return F.ceil(n / F.lit(each)).cast("int")

    if "cell" in rows.columns:
        queries = queries.withColumn("cell", F.explode("cells")).drop("cells")
        # One row per cell: bounded by the number of cells, not by the data.
        row_blocks = rows.groupBy("cell").agg(blocks(F.count("*"), rows_each).alias("_rows"))
        query_blocks = queries.groupBy("cell").agg(blocks(F.count("*"), queries_each).alias("_queries"))
        cuts = F.broadcast(row_blocks.join(query_blocks, "cell"))
        rows, queries = rows.join(cuts, "cell"), queries.join(cuts, "cell")
    else:
        row_cut = math.ceil(max(1, rows.count()) / rows_each)
        query_cut = math.ceil(checked.count / queries_each)
        cuts = {"cell": F.lit(0), "_rows": F.lit(row_cut), "_queries": F.lit(query_cut)}
        rows, queries = rows.withColumns(cuts), queries.withColumns(cuts)

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def own(key: str, n: str) -> Column:
        return F.pmod(F.xxhash64(key), F.col(n)).cast("int")

    left = rows.select(ID, EMBEDDING, "cell", own(ID, "_rows").alias("_r"),
                       every("_queries").alias("_q"))
    bound = F.col("_bound") if "_bound" in queries.columns else F.lit(None).cast("double")
    right = queries.select("query_id", EMBEDDING, "cell", bound.alias("_bound"), own("query_id", "_queries").alias("_q"),
                           every("_rows").alias("_r"))
    keys = ["cell", "_r", "_q"]
    schema = _hit_schema(queries)
    compare = _block_kernel(k, metric, checked.dimension, [f.name for f in schema])
    return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(compare, schema)


def _block_kernel(k: int, metric: str, dimension: int,
                  names: list[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def compare(rows: pa.Table, queries: pa.Table) -> pa.Table:
        query_ids = queries["query_id"].combine_chunks()
        rows = with_dimension(rows, EMBEDDING, dimension)
        best = BestHits(to_matrix(queries[EMBEDDING]), k, metric, queries["_bound"].to_numpy())
        if len(rows) and len(query_ids):
            best.add(rows[ID].combine_chunks(), to_matrix(rows[EMBEDDING]))
        return _as_hits(best, query_ids).select(names)

    return compare
