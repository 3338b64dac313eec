"""Kernel of full-text search: the best k rows per query, kept while rows stream by.

Runs inside Spark tasks on Arrow batches. A query is a set of words; what a word adds to a row's score is
the same for every query that holds it, so a block of rows is scored as one table of queries x rows to which
each word is added once. No table of (query, row, word) is ever formed. State is at most queries x k hits.
Scores are sums of whole numbers, so their order is of no account."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CELLS = 2_000_000  # entries of one queries x rows table
_PENDING = 100_000  # hits held besides the best ones


@dataclass(frozen=True)
class Asked:
    """Queries by their words: word `w` is asked by the queries `queries[starts[w]:starts[w + 1]]`, each as often
    as `times` says."""

    ids: pa.Array        # query ids by position
    tokens: pa.Array     # words by position
    starts: np.ndarray
    queries: np.ndarray
    times: np.ndarray


def asked_of(words: pa.Table) -> Asked:
    """From `(query_id, token)` rows; a word that a query lists twice counts twice."""
    ids = words["query_id"].combine_chunks().dictionary_encode("encode")
    tokens = words["token"].combine_chunks().dictionary_encode()
    n = max(1, len(ids.dictionary))
    key = tokens.indices.to_numpy().astype(np.int64) * n + ids.indices.to_numpy()
    pairs, times = np.unique(key, return_counts=True)
    starts = np.searchsorted(pairs // n, np.arange(len(tokens.dictionary) + 1))
    return Asked(ids.dictionary, tokens.dictionary, starts, (pairs % n).astype(np.int64), times)


class BestScores:
    """Best k rows for each query, over any number of blocks of rows."""

    def __init__(self, asked: Asked, k: int):
        self.asked, self.k = asked, k
        self.hits = pa.table({"q": pa.array([], pa.int64()), "part": pa.array([], pa.int64()),
                              "_id": pa.array([], pa.string())})
        self.least = np.ones(len(asked.ids), dtype=np.int64)  # k-th best so far; hits score more than 0
        self._pending: list[pa.Table] = []

    def add(self, ids: pa.Array, rows: np.ndarray, words: np.ndarray, parts: np.ndarray,
            among: np.ndarray | None = None):
        """Offer rows to all queries, or to the sorted positions `among`: word `words[i]` adds `parts[i]` to the
        row at `ids[rows[i]]`."""
        among = np.arange(len(self.asked.ids)) if among is None else among
        if not len(among) or not len(words):
            return
        key = words.astype(np.int64) * len(ids) + rows
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        parts = np.add.reduceat(parts[order], first)  # old and new entries of a row cancel here
        words, rows = key[first] // len(ids), key[first] % len(ids)
        cuts = np.append(np.flatnonzero(np.diff(words, prepend=-1)), len(words))
        step = max(1, _CELLS // len(ids))
        for start in range(0, len(among), step):
            self._add(ids, words, rows, parts, cuts, among[start:start + step])

    def _add(self, ids, words, rows, parts, cuts, among):
        place = np.full(len(self.asked.ids), -1)
        place[among] = np.arange(len(among))
        scores = np.zeros((len(among), len(ids)), dtype=np.int64)
        starts, queries, times = self.asked.starts, self.asked.queries, self.asked.times
        for low, high in zip(cuts[:-1], cuts[1:]):
            word = words[low]
            span = slice(starts[word], starts[word + 1])
            at = place[queries[span]]
            held = at >= 0
            at = at[held]
            if len(at):
                scores[at[:, None], rows[low:high]] += times[span][held][:, None] * parts[low:high]
        cut = self.least[among]
        if len(ids) > self.k:
            cut = np.maximum(cut, np.partition(scores, len(ids) - self.k, axis=1)[:, len(ids) - self.k])
        q, r = np.nonzero(scores >= cut[:, None])
        if len(q):
            self._pending.append(pa.table({"q": pa.array(among[q]), "part": pa.array(scores[q, r]),
                                           "_id": ids.take(pa.array(r)).cast(pa.string())}))
        if sum(map(len, self._pending)) > max(_PENDING, len(self.hits)):
            self._merge()

    def _merge(self):
        hits = pa.concat_tables([self.hits, *self._pending])
        order = pc.sort_indices(hits, sort_keys=[("q", "ascending"), ("part", "descending"), ("_id", "ascending")],
                                null_placement="at_start")
        hits = hits.take(order)
        q = hits["q"].to_numpy()
        rank = np.arange(len(q)) - np.searchsorted(q, q, side="left")
        last = rank == self.k - 1
        self.least[q[last]] = hits["part"].to_numpy()[last]
        self.hits, self._pending = hits.filter(pa.array(rank < self.k)), []

    def result(self) -> pa.Table:
        """Hits `(query_id, _id, part)`, best first within each query."""
        self._merge()
        q = self.hits["q"].combine_chunks()
        return pa.table({"query_id": self.asked.ids.take(q), "_id": self.hits["_id"], "part": self.hits["part"]})


def groups(batches: Iterable[pa.RecordBatch], column: str, least: int = 1) -> Iterator[pa.Table]:
    """Sorted batches cut anew between values of `column`, into tables of `least` rows or more."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if sum(map(len, held)) >= least:
            # the rows of the value that the held ones end with belong to them
            ends, last = table[column].combine_chunks(), held[-1][column][-1]
            other = pc.not_equal(ends, last) if last.is_valid else pc.is_valid(ends)
            cut = pc.index(pc.fill_null(other, True), True).as_py()
            cut = len(table) if cut < 0 else cut
            held.append(table.slice(0, cut))
            if cut < len(table):
                yield pa.concat_tables(held)
                held = [table.slice(cut)]
        else:
            held.append(table)
    if held:
        yield pa.concat_tables(held)
