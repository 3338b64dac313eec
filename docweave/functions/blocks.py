"""Block kernel of vector search: the best k rows per query, kept while rows stream by.

Runs inside Spark tasks on Arrow batches. State is at most queries x k hits. Candidates
come from one matrix product per block, with a cut-off widened by the rounding
error of that product; their distances are then recomputed pair by pair, so that
equal vectors get equal distances and ties fall to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CELLS = 1_000_000   # entries of one queries x rows product
_ROWS = 4096         # rows of one product
_PAIRS = 100_000     # pairs recomputed at a time
HITS = pa.schema([("q", pa.int32()), ("distance", pa.float64()), ("_id", pa.string())])


def to_matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Equal-length, non-null lists as a float64 matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 0)


def with_dimension(rows: pa.RecordBatch | pa.Table, column: str, dimension: int):
    """The rows whose vector has that many elements; NULL vectors are dropped."""
    return rows.filter(pc.equal(pc.list_value_length(rows[column]), dimension))


def pair_distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distance of each row of `a` to the same row of `b`."""
    if metric == "l2":
        return np.sqrt(((a - b) ** 2).sum(axis=1))
    dot = (a * b).sum(axis=1)
    if metric == "inner_product":
        return dot
    if metric == "negative_inner_product":
        return -dot
    norms = np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(norms > 0, 1.0 - dot / norms, np.nan)


def _approximate(x: np.ndarray, q: np.ndarray, metric: str):
    """Sort keys of all queries against all rows, and their error bound per query.

    The key of l2 is the squared distance, which sorts alike."""
    unit = 8 * x.shape[1] * np.finfo(np.float64).eps
    xx, qq = (x * x).sum(axis=1), (q * q).sum(axis=1)
    top = np.nanmax(xx, initial=0.0)
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        if metric == "l2":
            keys = (-2.0 * q) @ x.T
            keys += xx
            keys += qq[:, None]
            return keys, unit * (top + qq)
        if metric == "cosine":
            x = np.where(xx[:, None] > 0, x / np.sqrt(xx)[:, None], np.nan)
            q = np.where(qq[:, None] > 0, q / np.sqrt(qq)[:, None], np.nan)
            keys = -q @ x.T
            keys += 1.0
            return keys, np.full(len(q), unit)
    return (q if metric == "inner_product" else -q) @ x.T, unit * np.sqrt(top * qq)


def keep_best(hits: pa.Table, k: int) -> pa.Table:
    """Smallest k of each query by (distance, id); comes out sorted."""
    hits = hits.sort_by([("q", "ascending"), ("distance", "ascending"), ("_id", "ascending")])
    q = hits["q"].to_numpy()
    place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
    return hits.filter(pa.array(place < k))


class BestHits:
    """Best k rows for each query vector, over any number of blocks."""

    def __init__(self, queries: np.ndarray, k: int, metric: str, bounds: np.ndarray | None = None):
        """`bounds` are distances (NaN: none) beyond which a query wants no row."""
        self.queries, self.k, self.metric = queries, k, metric
        self.hits = HITS.empty_table()
        self.bounds = np.full(len(queries), np.inf)
        if bounds is not None:
            self.bounds = np.where(np.isnan(bounds.astype(np.float64)), np.inf, bounds)
        self.worst = self._key(self.bounds)  # sort key of the k-th hit so far
        self._pending: list[pa.Table] = []
        self._waiting = 0

    def _key(self, distance: np.ndarray) -> np.ndarray:
        return distance ** 2 if self.metric == "l2" else distance

    def add(self, ids: pa.Array, vectors: np.ndarray, among: np.ndarray | None = None):
        """Offer rows to all queries, or to the query positions `among`."""
        among = np.arange(len(self.queries)) if among is None else among
        if not len(among) or not len(vectors):
            return
        for start in range(0, len(vectors), _ROWS):
            x = vectors[start:start + _ROWS]
            step = max(1, _CELLS // len(x))
            for low in range(0, len(among), step):
                self._add(ids.slice(start, len(x)), x, among[low:low + step])

    def _add(self, ids, x, among):
        keys, error = _approximate(x, self.queries[among], self.metric)
        cut = self.worst[among]
        fresh = np.flatnonzero(np.isinf(cut))  # queries without k hits so far
        if len(x) > self.k and len(fresh):
            cut[fresh] = np.fmin(cut[fresh], np.partition(keys[fresh], self.k - 1, axis=1)[:, self.k - 1])
        limit = np.minimum(cut + 2 * error, np.finfo(np.float64).max)
        columns, rows = np.nonzero(keys <= limit[:, None])  # neither NaN nor infinite
        finite = np.isfinite(keys[columns, rows])
        columns, rows = columns[finite], rows[finite]
        for start in range(0, len(rows), _PAIRS):
            r, q = rows[start:start + _PAIRS], among[columns[start:start + _PAIRS]]
            exact = pair_distances(x[r], self.queries[q], self.metric)
            real = exact <= self.bounds[q]  # neither NaN nor out of bounds
            self._pending.append(pa.table(
                [pa.array(q[real].astype(np.int32)), pa.array(exact[real]),
                 ids.take(pa.array(r[real])).cast(pa.string())], schema=HITS))
            self._waiting += int(real.sum())
            if self._waiting > max(_PAIRS, len(self.hits)):
                self._merge()

    def _merge(self):
        self.hits = keep_best(pa.concat_tables([self.hits, *self._pending]), self.k)
        self._pending, self._waiting = [], 0
        q, d = self.hits["q"].to_numpy(), self.hits["distance"].to_numpy()
        full = np.flatnonzero(np.arange(len(q)) - np.searchsorted(q, q) == self.k - 1)
        self.worst[q[full]] = self._key(d[full])

    def result(self) -> pa.Table:
        """Hits `(q, distance, _id)`, best first within each query position `q`."""
        self._merge()
        return self.hits
