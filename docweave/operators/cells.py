"""Approximate nearest-neighbour search over cells of similar vectors.

Cell centres come from k-means over all rows; every row is then given its nearest
cell. A query looks into the `probes` cells nearest to it. With as many probes as
cells the result equals exact search. Written partitioned by `cell`, the indexed
table lets a search read only the probed directories.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from docweave.errors import InvalidInputError
from docweave.functions.text import DocFilter
from docweave.operators.nearest import (
    check_queries, filtered, metric_name, search, with_columns)
from docweave.plans.sizing import broadcast_if_small
from docweave.schema import EMBEDDING, ID
from docweave.sources.storage import stored

ROWS_PER_WRITER = 1_000_000
ENTRIES = 4_000_000  # of one rows x cells product


def train_cells(collection: DataFrame, cells: int, distance: str = "cosine",
                seed: int = 42) -> KMeansModel:
    """Centres of `cells` cells, from every row with a vector. The vectors are stored, since
    k-means goes over them many times."""
    vectors = collection.where(F.col(EMBEDDING).isNotNull())
    if metric_name(distance) == "cosine":
        vectors = vectors.where(_has_length(EMBEDDING))
    vectors = stored(vectors.select(EMBEDDING), "training")
    features = vectors.select(array_to_vector(F.col(EMBEDDING).cast("array<double>")).alias("features"))
    measure = "cosine" if metric_name(distance) == "cosine" else "euclidean"
    return KMeans(k=cells, seed=seed, distanceMeasure=measure).fit(features)


def _has_length(vector: str) -> Column:
    return F.exists(vector, lambda x: x != 0)


@dataclass(frozen=True)
class Centres:
    """Centres of cells, cells x dimension; with `unit`, vectors are scaled to unit length before they meet them."""

    points: np.ndarray
    unit: bool


def centres_of(model: KMeansModel | Centres) -> Centres:
    if isinstance(model, Centres):
        return model
    return Centres(np.array(model.clusterCenters(), dtype=np.float64), model.getDistanceMeasure() == "cosine")


def centres_from(table: DataFrame, distance: str) -> Centres:
    """Centres from a table `(cell, embedding)`, numbered in order of `cell`: one row for each cell, as many as
    the caller has chosen. Any vectors will do, the means of known classes for example."""
    rows = table.select("cell", F.col(EMBEDDING).cast("array<double>")).orderBy("cell").collect()
    if not rows or len({len(r[1]) if r[1] is not None else 0 for r in rows}) != 1 or not rows[0][1]:
        raise InvalidInputError("centres must be vectors of one length")
    unit = metric_name(distance) == "cosine"
    points = np.array([r[1] for r in rows], dtype=np.float64)
    if unit:
        norms = np.linalg.norm(points, axis=1, keepdims=True)
        points = points / np.where(norms > 0, norms, 1.0)
    return Centres(points, unit)


def assign_cells(collection: DataFrame, model: KMeansModel | Centres) -> DataFrame:
    """The collection with the `cell` of each row; rows without a vector get none."""
    return collection.withColumn("cell", _nearest_cells(model, 1, "l2")[0])


def probe_cells(queries: DataFrame, model: KMeansModel | Centres, probes: int, distance: str) -> DataFrame:
    """Queries with `cells`, the `probes` cells that suit each one best."""
    return queries.withColumn("cells", _nearest_cells(model, probes, metric_name(distance)))


def _nearest_cells(model: KMeansModel | Centres, n: int, metric: str) -> Column:
    held = centres_of(model)
    points, unit = held.points, held.unit  # cells x dimension, set by the caller, not by the data
    n = min(n, len(points))

    @F.pandas_udf("array<int>")
    def pick(vectors: pd.Series) -> pd.Series:
        known = vectors.notna().to_numpy()
        out = [None] * len(vectors)
        if known.any():
            x = np.stack(vectors[known].to_list()).astype(np.float64)
            if unit:
                norms = np.linalg.norm(x, axis=1, keepdims=True)
                x = x / np.where(norms > 0, norms, 1.0)
            step = max(1, ENTRIES // len(points))
            places = np.flatnonzero(known)
            for start in range(0, len(x), step):
                dot = x[start:start + step] @ points.T
                if metric == "inner_product":
                    keys = dot
                elif metric == "negative_inner_product":
                    keys = -dot
                else:
                    keys = (points * points).sum(axis=1)[None, :] - 2.0 * dot
                best = _smallest(keys, n)
                for at, cells in zip(places[start:start + step], best.astype(np.int32)):
                    out[at] = cells.tolist()
        return pd.Series(out, dtype=object)

    return pick(F.col(EMBEDDING))


def _smallest(keys: np.ndarray, n: int) -> np.ndarray:
    """Columns of the n smallest keys of each row, smallest first, ties to the lower column."""
    if n == 1:
        return np.argmin(keys, axis=1)[:, None]
    if n < keys.shape[1]:
        limit = np.partition(keys, n - 1, axis=1)[:, n - 1:n]
        keys = np.where(keys <= limit, keys, np.inf)
    return np.argsort(keys, axis=1, kind="stable")[:, :n]


def nearest_in_cells(indexed: DataFrame, model: KMeansModel | Centres, queries: DataFrame, k: int,
                     probes: int, distance: str = "cosine", where: Column | None = None,
                     where_document: DocFilter | Column | None = None, include=None) -> DataFrame:
    """`nearest`, looking only into the `probes` best cells of each query."""
    rows = filtered(indexed, where, where_document).select(ID, EMBEDDING, "cell")
    hits, count = search_cells(rows, model, queries, k, probes, distance)
    return with_columns(hits, indexed, include, count * k)


def search_cells(rows: DataFrame, model: KMeansModel | Centres, queries: DataFrame, k: int, probes: int,
                 distance: str) -> tuple[DataFrame, int]:
    """Hits `(query_id, rank, _id, distance)` among `rows(_id, embedding, cell)`, and the number of queries."""
    probing = probe_cells(queries.select("query_id", EMBEDDING), model, probes, distance)
    checked = check_queries(probing, centres_of(model).points.shape[1], k)
    return search(rows, checked, k, metric_name(distance)), checked.count


def nearest_in_index(collection: DataFrame, index: DataFrame, model: Centres, queries: DataFrame, k: int,
                     probes: int, distance: str = "cosine", where: Column | None = None,
                     where_document: DocFilter | Column | None = None, include=None) -> DataFrame:
    """`nearest_in_cells` where the index holds ids, vectors and cells alone: filters and included columns
    come from the collection."""
    hits, count = search_cells(allowed_rows(index, collection, where, where_document), model, queries, k, probes, distance)
    return with_columns(hits, collection, include, count * k)


def allowed_rows(index: DataFrame, collection: DataFrame, where: Column | None,
                 where_document: DocFilter | Column | None = None) -> DataFrame:
    """The index rows that pass the filters."""
    if where is None and where_document is None:
        return index
    passing = filtered(collection, where, where_document).select(ID)
    return index.join(broadcast_if_small(passing), ID, "left_semi")


def write_cells(indexed: DataFrame, location: str) -> None:
    """Store an indexed collection partitioned by `cell`, so that a search reads only the
    directories it probes. A cell is written by as many tasks as its own count asks for."""
    # One row per cell: bounded by the number of cells, not by the data.
    writers = indexed.groupBy("cell").agg(F.ceil(F.count("*") / ROWS_PER_WRITER).alias("_writers"))
    dealt = indexed.join(F.broadcast(writers), indexed["cell"].eqNullSafe(writers["cell"])).drop(writers["cell"])
    share = F.pmod(F.xxhash64(ID), F.col("_writers"))
    (dealt.withColumn("_share", share).repartition("cell", "_share").drop("_share", "_writers")
     .write.partitionBy("cell").parquet(location))
