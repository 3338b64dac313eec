"""Hybrid search: a text branch, a vector branch, and reciprocal rank fusion.

Branches are ranked lists cut to a window before they meet, so fusion joins at most
queries x window rows, whatever the collection holds.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from docweave.errors import ConfigError, InvalidInputError
from docweave.functions.filters import conjunction
from docweave.functions.text import (
    AnyOf, Contains, DocFilter, Tokenizer, document_predicate, scored_text, tokens, unscored_predicate)
from docweave.operators import blockwords
from docweave.operators.blockwords import BlockIndex
from docweave.operators.cells import Centres, allowed_rows, search_cells
from docweave.operators.fulltext import bm25, bm25_one, term_index
from docweave.operators.nearest import (
    check_queries, embed_queries, filtered, metric_name, search, with_columns)
from docweave.operators.reads import page
from docweave.plans.ranking import top_k
from docweave.schema import EMBEDDING, ID

# Defaults of the branches and of the fusion.
DEFAULT_KNN_RESULTS = 10
DEFAULT_RANK_CONSTANT = 60


@dataclass(frozen=True)
class TextBranch:
    """Metadata predicate and/or document filter. `index` is an optional prepared index of the
    collection: stored postings, which count only if they were made with `tokenizer`, or a `term_index` that
    still carries the collection's columns. Without a `tokenizer` that of the postings holds, else words.
    With `queries(query_id, text)` each query ranks by its own text, and the document filter
    only filters."""

    where: Column | None = None
    where_document: DocFilter | None = None
    index: DataFrame | BlockIndex | None = None
    tokenizer: Tokenizer | None = None
    queries: DataFrame | None = None


@dataclass(frozen=True)
class KnnBranch:
    """`queries` is `(query_id, embedding)` or `(query_id, text)`; vectors win over texts. With `probes` and an
    `index`, rows `(_id, embedding, cell)` and their centres, so many cells are looked into; a predicate that passes
    fewer rows than such a search would read is answered by a scan of those instead."""

    queries: DataFrame
    where: Column | None = None
    n_results: int | None = None
    probes: int | None = None
    index: tuple[DataFrame, Centres] | None = None


@dataclass(frozen=True)
class Rrf:
    """Reciprocal rank fusion over the first `window` ranks of each branch."""

    window: int | None = None
    constant: int | None = None


def text_branch(collection: DataFrame, branch: TextBranch, k: int) -> DataFrame:
    """Best k rows `(query_id, rank, _id, score)` of a text branch, with query_id 0 unless the
    branch has queries.

    With words to match, rows rank by BM25; the metadata predicate and the Regex and nested
    parts only filter. Without words, rows rank by `_id` and have no score."""
    if branch.queries is not None:
        keep = conjunction(branch.where, document_predicate(branch.where_document))
        return _ranked_texts(collection, branch, branch.queries.select("query_id", "text"), k, keep)
    nowhere = F.lit(None).cast("double")
    if branch.where_document is None or not scored_text(branch.where_document):
        if branch.where is None and branch.where_document is None:
            raise InvalidInputError("a text branch needs where or where_document")
        rows = filtered(collection, branch.where, branch.where_document)
        rows = rows.select(F.lit(0).alias("query_id"), ID, nowhere.alias("score"))
        return top_k(rows, "query_id", [F.col(ID)], k).select("query_id", "rank", ID, "score")

    doc = branch.where_document
    words = scored_text(doc)
    others = unscored_predicate(doc)
    if others is None or not isinstance(doc, AnyOf):
        return _ranked_texts(collection, branch, words, k, conjunction(branch.where, others))
    # AnyOf with Regex or nested parts: rows that hold the filter without any of the words
    # follow with score 0.
    keep = conjunction(branch.where, doc.column())
    hits = _ranked_texts(collection, branch, words, k, keep).select("query_id", ID, "score")
    own = None if _tokenizer(branch) is tokens else _tokenizer(branch)
    silent = ~F.coalesce(Contains(words, own).column(), F.lit(False))
    rest = filtered(collection, conjunction(keep, silent), None).select(
        F.lit(0).alias("query_id"), ID, F.lit(0.0).alias("score"))
    both = hits.unionByName(top_k(rest, "query_id", [F.col(ID)], k).drop("rank"))
    return top_k(both, "query_id", [F.col("score").desc(), F.col(ID)], k).select(
        "query_id", "rank", ID, "score")


def _tokenizer(branch: TextBranch) -> Tokenizer:
    made = branch.index.tokenizer if isinstance(branch.index, BlockIndex) else tokens
    return branch.tokenizer or made


def _ranked_texts(collection: DataFrame, branch: TextBranch, texts: DataFrame | str, k: int, keep: Column | None) -> DataFrame:
    """BM25 hits for a table of texts or for one text, from the branch's index if it fits."""
    tokenizer, index = _tokenizer(branch), branch.index
    if isinstance(index, BlockIndex):
        if index.tokenizer is tokenizer:
            if isinstance(texts, str):
                texts = collection.sparkSession.range(1).select(F.lit(0).alias("query_id"), F.lit(texts).alias("text"))
            allowed = None if keep is None else collection.where(keep).select(ID)
            return blockwords.bm25(index, texts, k, allowed)
        index = None  # postings of other words would find nothing
    if isinstance(texts, str):
        return bm25_one(collection if index is None else index, texts, k, where=keep, tokenizer=tokenizer)
    index = term_index(collection, tokenizer) if index is None else index
    return bm25(index, texts, k, where=keep, tokenizer=tokenizer)


def knn_branch(collection: DataFrame, branch: KnnBranch, distance: str, k: int | None = None,
               embedder=None, dimension: int | None = None) -> tuple[DataFrame, int]:
    """Hits `(query_id, rank, _id, distance)` of a vector branch, and its query count."""
    k = k or branch.n_results or DEFAULT_KNN_RESULTS
    if branch.probes is not None:
        if branch.index is None:
            raise ConfigError("probes need an index of cells")
        rows, centres = branch.index
        if branch.where is None or not _few_pass(collection, branch, centres):
            rows = allowed_rows(rows, collection, branch.where)
            return search_cells(rows, centres, _vectors(branch, embedder), k, branch.probes, distance)
    checked = check_queries(_vectors(branch, embedder), dimension, k)
    rows = filtered(collection, branch.where, None).select(ID, EMBEDDING)
    return search(rows, checked, k, metric_name(distance)), checked.count


def _few_pass(collection: DataFrame, branch: KnnBranch, centres: Centres) -> bool:
    """Whether the predicate passes fewer rows than the probed cells hold on average: then comparing
    all of them is both cheaper and exact."""
    count = collection.agg(F.count("*").alias("all"), F.count_if(branch.where).alias("pass")).first()
    return count["pass"] * len(centres.points) <= count["all"] * min(branch.probes, len(centres.points))


def _vectors(branch: KnnBranch, embedder) -> DataFrame:
    if EMBEDDING in branch.queries.columns:
        return branch.queries.select("query_id", EMBEDDING)
    if "text" in branch.queries.columns:
        return embed_queries(branch.queries, embedder)
    raise InvalidInputError("knn queries need an embedding or a text column")


def fuse(first: DataFrame, second: DataFrame, size: int, window: int,
         constant: int = DEFAULT_RANK_CONSTANT) -> DataFrame:
    """Reciprocal rank fusion of two ranked lists `(query_id, rank, _id, ...)`.

    Each row scores the sum of 1 / (constant + rank) over the lists that hold it. Scores
    of the branches (`score`, `distance`) are kept beside `fused_score`."""
    def cut(df, name, kept):
        kept = [c for c in df.columns if c in kept]
        return df.where(F.col("rank") <= window).select(
            "query_id", ID, F.col("rank").alias(name), *kept)

    left, right = cut(first, "_first", ("score",)), cut(second, "_second", ("distance",))
    joined = left.join(right, ["query_id", ID], "full_outer")

    def share(rank):
        return F.coalesce(F.lit(1.0) / (F.lit(constant) + F.col(rank)), F.lit(0.0))

    fused = joined.withColumn("fused_score", share("_first") + share("_second"))
    fused = fused.drop("_first", "_second")
    ranked = top_k(fused, "query_id", [F.col("fused_score").desc(), F.col(ID)], size)
    rest = [c for c in ("score", "distance") if c in ranked.columns]
    return ranked.select("query_id", "rank", ID, *rest, "fused_score")


def hybrid_search_advanced(collection: DataFrame, text: TextBranch | None = None,
                           knn: KnnBranch | None = None, rank: Rrf | None = None,
                           n_results: int = 10, include=None, distance: str = "cosine",
                           embedder=None, dimension: int | None = None) -> DataFrame:
    """Hybrid search with a separate setting for each branch.

    Vectors alone: plain nearest-neighbour search for `n_results`. Text alone: the text
    ranking. Both: fusion, by default with constant 60 over a window of
    max(knn results, n_results). A text list without queries counts for every vector query; texts
    with queries meet the vectors of the same query id."""
    if text is None and knn is None:
        raise InvalidInputError("hybrid search needs a text branch or a knn branch")
    if text is None and rank is None:
        hits, count = knn_branch(collection, knn, distance, n_results, embedder, dimension)
        return with_columns(hits, collection, include, count * n_results)
    knn_results = (knn.n_results if knn else None) or DEFAULT_KNN_RESULTS
    rank = rank or Rrf()
    window = rank.window or max(knn_results, n_results)
    constant = DEFAULT_RANK_CONSTANT if rank.constant is None else rank.constant
    if knn is None:
        hits = text_branch(collection, text, n_results)
        count = 1 if text.queries is None else text.queries.count()
    else:
        hits, count = knn_branch(collection, knn, distance, None, embedder, dimension)
        if text is None:
            hits = hits.where(F.col("rank") <= min(window, n_results))
        else:
            words = text_branch(collection, text, window)
            if text.queries is None:
                words = _for_each_query(words, knn)
            else:
                count += text.queries.count()
            hits = fuse(words, hits, n_results, window, constant)
    return with_columns(hits, collection, include, count * n_results)


def _for_each_query(words: DataFrame, knn: KnnBranch) -> DataFrame:
    # The text list is at most `window` entries; as one array value it reaches every
    # query by a projection, without a join.
    listed = words.agg(F.array_agg(F.struct("rank", ID, "score"))).scalar()
    return knn.queries.select("query_id", F.inline(listed))


def hybrid_search(collection: DataFrame, queries: DataFrame | None = None,
                  where: Column | None = None, where_document: DocFilter | None = None,
                  n_results: int = 10, include=None, distance: str = "cosine", embedder=None,
                  dimension: int | None = None, index: DataFrame | BlockIndex | None = None,
                  tokenizer: Tokenizer | None = None) -> DataFrame:
    """Simple hybrid search for `queries(query_id, text)`.

    Without filters: nearest neighbours of the texts. With filters: their text branch,
    fused with the nearest neighbours if there are queries. The metadata predicate
    applies to both branches, the document filter to the text branch only."""
    if queries is None and where is None and where_document is None:
        raise InvalidInputError("hybrid search needs queries or filters")
    knn = None if queries is None else KnnBranch(queries, where, n_results)
    if where is None and where_document is None:
        return hybrid_search_advanced(collection, None, knn, None, n_results, include, distance,
                                      embedder, dimension)
    text = TextBranch(where, where_document, index, tokenizer)
    return hybrid_search_advanced(collection, text, knn, None, n_results, include, distance,
                                  embedder, dimension)


def hybrid_filtered(collection: DataFrame, text: TextBranch | None = None,
                    knn: KnnBranch | None = None, n_results: int = 10, include=None,
                    distance: str = "cosine", embedder=None,
                    dimension: int | None = None) -> DataFrame:
    """Hybrid search as one vector search under every filter of both branches.

    Without a vector branch: the first `n_results` rows that pass, at distance 0."""
    if text is None and knn is None:
        raise InvalidInputError("hybrid search needs a text branch or a knn branch")
    where = text.where if text else None
    doc = document_predicate(text.where_document) if text else None
    if knn is not None:
        both = replace(knn, where=conjunction(where, knn.where, doc))
        hits, count = knn_branch(collection, both, distance, n_results, embedder, dimension)
        return with_columns(hits, collection, include, count * n_results)
    rows = page(filtered(collection, where, doc), n_results, 0).select(
        F.lit(0).alias("query_id"), ID, F.lit(0.0).alias("distance"))
    hits = top_k(rows, "query_id", [F.col(ID)], n_results)
    return with_columns(hits.select("query_id", "rank", ID, "distance"), collection, include,
                        n_results)


def with_distances(hits: DataFrame) -> DataFrame:
    """Add `distances`: the first of distance, _distance, _score, score that the hit has,
    else 0."""
    found = [F.col(c) for c in ("distance", "_distance", "_score", "score") if c in hits.columns]
    return hits.withColumn("distances", F.coalesce(*found, F.lit(0.0)).cast("double"))
