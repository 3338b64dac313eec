"""Compressed vectors inside cells: a search reads codes, and whole vectors only of a shortlist.

The difference between a row's vector and its cell's centre is cut into parts, and each part is kept as the
number of the nearest of a few learned codewords: one byte a part instead of four a component. A search decodes
the codes of the probed cells, ranks a shortlist with the decoded vectors by the same kernel as exact search, and
ranks that shortlist again by the true vectors. With a shortlist as long as the probed cells the result is that
of `cells.nearest_in_cells`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from docweave.errors import InvalidInputError
from docweave.functions.distance import distance as vector_distance
from docweave.functions.text import DocFilter
from docweave.operators.cells import Centres, allowed_rows, centres_of, search_cells
from docweave.operators.nearest import metric_name, with_columns
from docweave.plans.ranking import top_k
from docweave.schema import EMBEDDING, ID
from docweave.sources.storage import stored

MOST_CODEWORDS = 256  # a code is one byte
SLICE_ENTRIES = 4_000_000  # of one rows x codewords product


@dataclass(frozen=True)
class Codebooks:
    """Codewords of each part (codewords x length of the part), and the centres they are relative to."""

    words: tuple[np.ndarray, ...]
    centres: Centres

    @property
    def borders(self) -> np.ndarray:
        return np.cumsum([0, *(w.shape[1] for w in self.words)])


def train_codebooks(indexed: DataFrame, model: KMeansModel | Centres, parts: int = 8,
                    codewords: int = MOST_CODEWORDS, seed: int = 42) -> Codebooks:
    """Codewords of each part by k-means over the residuals of all rows `(embedding, cell)`."""
    centres = centres_of(model)
    dimension = centres.points.shape[1]
    if not 1 <= parts <= dimension:
        raise InvalidInputError(f"parts must be from 1 to the dimension {dimension}, got {parts}")
    if not 1 <= codewords <= MOST_CODEWORDS:
        raise InvalidInputError(f"codewords must be from 1 to {MOST_CODEWORDS}, got {codewords}")
    known = indexed.where(F.col(EMBEDDING).isNotNull() & F.col("cell").isNotNull())
    residuals = stored(known.select(_residual(centres)(EMBEDDING, "cell").alias("residual")), "residuals")
    borders = [round(i * dimension / parts) for i in range(parts + 1)]
    words = []
    for first, stop in zip(borders, borders[1:]):  # as many jobs as parts
        part = residuals.select(array_to_vector(F.slice("residual", first + 1, stop - first)).alias("features"))
        found = KMeans(k=max(2, codewords), seed=seed).fit(part).clusterCenters() if codewords > 1 else [np.zeros(stop - first)]
        words.append(np.array(found, dtype=np.float64))
    return Codebooks(tuple(words), centres)


def _matrix(vectors: pd.Series, centres: Centres) -> np.ndarray:
    x = np.stack(vectors.to_list()).astype(np.float64)
    if centres.unit:
        norms = np.linalg.norm(x, axis=1, keepdims=True)
        x = x / np.where(norms > 0, norms, 1.0)
    return x


def _residual(centres: Centres):
    @F.pandas_udf("array<double>")
    def residual(vectors: pd.Series, cell: pd.Series) -> pd.Series:
        return pd.Series(list(_matrix(vectors, centres) - centres.points[cell.to_numpy()]), dtype=object)

    return residual


def encode(indexed: DataFrame, books: Codebooks) -> DataFrame:
    """`(_id, cell, code)` of rows `(_id, embedding, cell)`; rows without a vector have no code and are left out."""
    borders = books.borders

    @F.pandas_udf("binary")
    def code(vectors: pd.Series, cell: pd.Series) -> pd.Series:
        left = _matrix(vectors, books.centres) - books.centres.points[cell.to_numpy()]
        out = np.empty((len(left), len(books.words)), np.uint8)
        for n, words in enumerate(books.words):
            part = left[:, borders[n]:borders[n + 1]]
            length = (words * words).sum(axis=1)
            step = max(1, SLICE_ENTRIES // len(words))
            for at in range(0, len(part), step):
                out[at:at + step, n] = np.argmin(length - 2.0 * (part[at:at + step] @ words.T), axis=1)
        return pd.Series([row.tobytes() for row in out], dtype=object)

    known = indexed.where(F.col(EMBEDDING).isNotNull() & F.col("cell").isNotNull())
    return known.select(ID, "cell", code(EMBEDDING, "cell").alias("code"))


def decoded(coded: DataFrame, books: Codebooks) -> DataFrame:
    """`(_id, embedding, cell)` with the vectors that the codes stand for."""
    @F.pandas_udf("array<float>")
    def vector(codes: pd.Series, cell: pd.Series) -> pd.Series:
        held = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), len(books.words))
        parts = [words[held[:, n]] for n, words in enumerate(books.words)]
        x = np.concatenate(parts, axis=1) + books.centres.points[cell.to_numpy()]
        return pd.Series(list(x.astype(np.float32)), dtype=object)

    return coded.select(ID, vector("code", "cell").alias(EMBEDDING), "cell")


def nearest_by_codes(collection: DataFrame, coded: DataFrame, books: Codebooks, queries: DataFrame, k: int, probes: int,
                     shortlist: int, distance: str = "cosine", where: Column | None = None,
                     where_document: DocFilter | Column | None = None, include=None) -> DataFrame:
    """The k nearest rows of `probes` cells for each of `queries(query_id, embedding)`: the `shortlist` nearest by
    their codes, ranked by the collection's vectors. Ties go to the smaller id."""
    if shortlist < k:
        raise InvalidInputError(f"the shortlist must hold at least k = {k} rows, got {shortlist}")
    metric = metric_name(distance)
    allowed = allowed_rows(coded, collection, where, where_document)
    short, count = search_cells(decoded(allowed, books), books.centres, queries, shortlist, probes, distance)
    # `queries` are as many as in any search; the shortlist is queries x shortlist rows
    whole = with_columns(short.select("query_id", "rank", ID), collection, ["embeddings"], count * shortlist)
    asked = queries.select("query_id", F.col(EMBEDDING).alias("_asked"))
    sign, name = (-1, "inner_product") if metric == "negative_inner_product" else (1, metric)
    met = whole.join(asked, "query_id").withColumn("distance", sign * vector_distance(name, EMBEDDING, "_asked"))
    best = top_k(met.where(F.col("distance").isNotNull()).select("query_id", ID, "distance"), "query_id",
                 [F.col("distance"), F.col(ID)], k)
    return with_columns(best.select("query_id", "rank", ID, "distance"), collection, include, count * k)
