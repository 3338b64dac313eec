"""The registered queries: each runs one operator over whole tables of a data folder.

The test collection is every document with its vector and its labels as metadata; a
document without one has a NULL vector or lacks the metadata key."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docweave.functions import filters as where
from docweave.functions.codecs import (
    bytes_to_id, metadata_to_text, text_to_metadata, text_to_vector, vector_to_text,
)
from docweave.functions.distance import cosine_distance, inner_product, l2_distance
from docweave.functions.embedding import HashEmbedding, mean_pool
from docweave.functions.text import AllOf, AnyOf, Contains, Regex, pair_tokens
from docweave.operators import cells, fulltext, hybrid, nearest, reads, writes
from docweave.schema import conform
from docweave.sources.collection import create_collection, open_collection
from docweave.sources.storage import stored

DIMENSION = 64
EMBEDDER = HashEmbedding(DIMENSION)
WORDS = "the und les que"

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(rows: DataFrame, key: str | None = None) -> DataFrame:
    """Give every core a share of a small table: the test tables are one row group each,
    which Spark reads in one task. Tables of enough files stay as they are. Rows that are joined by a `key`
    next are dealt by it, so the join needs no shuffle of its own."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if len(rows.inputFiles()) >= cores:
        return rows
    return rows.repartition(cores) if key is None else rows.repartition(key)


def json_of(*columns) -> Column:
    """VARIANT object of some columns; a NULL becomes a missing key."""
    return F.parse_json(F.to_json(F.struct(*columns)))


def text_id(column, factor: int = 1) -> Column:
    return (F.col(column) * factor).cast("string").alias("_id")


def collection(spark: SparkSession, folder: str) -> DataFrame:
    # joined by the ids as text: writes that meet the collection by `_id` find it dealt by it already
    documents = spread(table(spark, folder, "documents").select("*", text_id("doc_id")), "_id")
    vectors = table(spark, folder, "embeddings").select(text_id("vec_id"), "embedding")
    labels = table(spark, folder, "labels").select(text_id("doc_id"), "quality", "toxic")
    joined = documents.join(vectors, "_id", "left").join(labels, "_id", "left")
    return joined.select(
        "_id", F.col("text").alias("document"), "embedding",
        json_of("lang", "source", "n_chars", "quality", "toxic").alias("metadata"))


def hashed_collection(spark: SparkSession, folder: str) -> DataFrame:
    """The same documents with hash vectors, so that every row has one."""
    return collection(spark, folder).withColumn("embedding", EMBEDDER.embed(F.col("document")))


def stored_index(spark: SparkSession, folder: str) -> DataFrame:
    """Term index of the collection as a table in the shared folder; scoring reads it twice."""
    rows = collection(spark, folder).drop("embedding")
    return stored(fulltext.term_index(rows), "term_index")


def vector_queries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")


def text_queries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        text_id("event_id"), text_to_metadata("props").alias("metadata"))


def field(name: str, kind: str) -> Column:
    return F.try_variant_get("metadata", f"$.{name}", kind).alias(name)


def flat(rows: DataFrame) -> DataFrame:
    """Rows of a collection as plain columns."""
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return rows.select(
        "_id", "document", F.array_size("embedding").cast("bigint").alias("n_dims"),
        (F.round(total, 6) + F.lit(0.0)).alias("vector_sum"), field("lang", "string"),
        field("n_chars", "bigint"), field("quality", "bigint"), field("label", "bigint"))


def ranked(hits: DataFrame, *more: str) -> DataFrame:
    """Hits with their scores rounded."""
    scores = [c for c in ("distance", "score", "fused_score") if c in hits.columns]
    return hits.select(F.col("query_id").cast("bigint"), "rank", "_id", *more,
                       *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in scores])


# Codecs and projection

@query
def include_default(spark, folder):
    return reads.get(collection(spark, folder)).select(
        "_id", "document", field("lang", "string"), field("n_chars", "bigint"))


@query
def include_none(spark, folder):
    return reads.get(collection(spark, folder), include=[])


@query
def metadata_text(spark, folder):
    return collection(spark, folder).select("_id", metadata_to_text("metadata").alias("metadata"))


@query
def parse_vector(spark, folder):
    """Vectors to text and back."""
    texts = table(spark, folder, "embeddings").select("vec_id", vector_to_text("embedding").alias("v"))
    return texts.select("vec_id", F.posexplode(text_to_vector("v")).alias("pos", "value")).select(
        "vec_id", F.col("pos").cast("bigint"), F.round(F.col("value").cast("double"), 6).alias("value"))


@query
def parse_metadata(spark, folder):
    return events(spark, folder).select("_id", field("k", "bigint"))


@query
def id_bytes(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", bytes_to_id(F.encode("text", "UTF-8")).alias("decoded"))


# Metadata filters

def kept(rows: DataFrame, predicate: Column) -> DataFrame:
    return reads.get(rows, where=predicate, include=[])


@query
def filter_eq(spark, folder):
    return kept(collection(spark, folder), where.eq("lang", "en"))


@query
def filter_ne_missing(spark, folder):
    return kept(collection(spark, folder), where.ne("quality", 1))


@query
def filter_gt(spark, folder):
    return kept(events(spark, folder), where.gt("k", 50))


@query
def filter_gte(spark, folder):
    return kept(collection(spark, folder), where.gte("n_chars", 2000))


@query
def filter_lt(spark, folder):
    return kept(events(spark, folder), where.lt("k", 9.5))


@query
def filter_lte(spark, folder):
    return kept(collection(spark, folder), where.lte("n_chars", 500))


@query
def filter_in(spark, folder):
    return kept(collection(spark, folder), where.is_in("lang", ["de", "fr"]))


@query
def filter_nin_missing(spark, folder):
    return kept(collection(spark, folder), where.not_in("quality", [0]))


@query
def filter_in_table(spark, folder):
    """Sources that hold a toxic document, as a table of values."""
    toxic = table(spark, folder, "documents").join(
        table(spark, folder, "labels").where("toxic = 1"), "doc_id").select("source")
    return reads.field_in(collection(spark, folder), "source", toxic).select("_id")


@query
def filter_in_table_numbers(spark, folder):
    """Numbers as a table of values: the quantities of all returned items at a high discount, asked in the events."""
    asked = table(spark, folder, "lineitem").where("l_returnflag = 'R' AND l_discount > 0.05").select(
        F.col("l_quantity").cast("double"))
    return reads.field_in(events(spark, folder), "k", asked).select("_id")


@query
def filter_nin_table(spark, folder):
    """Sources without a toxic document, as a table of values."""
    toxic = table(spark, folder, "documents").join(
        table(spark, folder, "labels").where("toxic = 1"), "doc_id").select("source")
    return reads.field_not_in(collection(spark, folder), "source", toxic).select("_id")


@query
def filter_and(spark, folder):
    return kept(collection(spark, folder),
                where.all_of(where.eq("lang", "en"), where.eq("quality", 1), where.gt("n_chars", 1000)))


@query
def filter_or(spark, folder):
    return kept(collection(spark, folder), where.any_of(where.eq("lang", "de"), where.eq("toxic", 1)))


@query
def filter_not_missing(spark, folder):
    return kept(collection(spark, folder),
                where.negate(where.any_of(where.eq("quality", 0), where.lt("n_chars", 300))))


@query
def filter_nested_path(spark, folder):
    nested = table(spark, folder, "documents").select(
        text_id("doc_id"),
        json_of(F.struct("lang", F.struct("n_chars").alias("size")).alias("doc")).alias("metadata"))
    return nested.where(where.eq("doc.lang", "fr") & where.gte("doc.size.n_chars", 1000)).select("_id")


@query
def filter_ids(spark, folder):
    good = table(spark, folder, "labels").where("quality = 1").select(text_id("doc_id"))
    return reads.get(collection(spark, folder), ids=good, include=[])


@query
def filter_combined(spark, folder):
    labelled = table(spark, folder, "labels").select(text_id("doc_id"))
    both = where.conjunction(where.eq("lang", "en"), where.gt("n_chars", 800))
    return reads.get(collection(spark, folder), ids=labelled, where=both,
                     where_document=Contains("license copyright"), include=[])


# Document filters and full text

@query
def doc_contains(spark, folder):
    return reads.get(collection(spark, folder), where_document=Contains(WORDS), include=[])


@query
def doc_regex(spark, folder):
    return reads.get(collection(spark, folder), where_document=Regex("[0-9]{3}-[0-9]{3,4}"), include=[])


@query
def doc_and(spark, folder):
    both = AllOf(Contains("the und"), Regex("licen[cs]e|apache", ignore_case=True))
    return reads.get(collection(spark, folder), where_document=both, include=[])


@query
def doc_or(spark, folder):
    either = AnyOf(Contains("und"), AllOf(Contains("les"), Regex("^[A-Z]")))
    return reads.get(collection(spark, folder), where_document=either, include=[])


@query
def postings(spark, folder):
    return fulltext.postings(fulltext.term_index(collection(spark, folder)))


@query
def bm25_topk(spark, folder):
    index = stored_index(spark, folder)
    return ranked(fulltext.bm25(index, text_queries(spark, folder), 10))


@query
def bm25_filtered(spark, folder):
    index = stored_index(spark, folder)
    return ranked(fulltext.bm25(index, text_queries(spark, folder), 10, where=where.eq("lang", "en")))


# Writes

@query
def add_rows(spark, folder):
    new = table(spark, folder, "embeddings").select(
        F.concat(F.lit("v"), F.col("vec_id")).alias("_id"), "embedding",
        json_of("label").alias("metadata"))
    return flat(writes.add(collection(spark, folder), new, DIMENSION))


@query
def add_embedded(spark, folder):
    """Vectors made from the documents on the way in."""
    new = spread(table(spark, folder, "conversations")).select(
        F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("_id"), F.col("text").alias("document"))
    return flat(writes.add(collection(spark, folder), new, DIMENSION, EMBEDDER))


@query
def update_fields(spark, folder):
    """Some ids exist and some do not; vector and metadata change, the document stays."""
    changes = table(spark, folder, "embeddings").select(
        text_id("vec_id", 3), "embedding", json_of("label").alias("metadata"))
    return flat(writes.update(collection(spark, folder), changes, DIMENSION))


@query
def upsert_full(spark, folder):
    vectors = table(spark, folder, "embeddings").withColumnRenamed("vec_id", "doc_id")
    changes = table(spark, folder, "documents").join(vectors, "doc_id").select(
        text_id("doc_id", 2), F.col("text").alias("document"), "embedding",
        json_of("lang", "n_chars", "label").alias("metadata"))
    # the batch is checked, folded and applied: joined once, not each time
    return flat(writes.upsert(collection(spark, folder), stored(changes, "changes"), DIMENSION))


@query
def upsert_metadata_only(spark, folder):
    changes = table(spark, folder, "labels").select(
        text_id("doc_id", 3), json_of("quality").alias("metadata"))
    return flat(writes.upsert(collection(spark, folder), changes, DIMENSION))


@query
def upsert_document_only(spark, folder):
    changes = table(spark, folder, "documents").select(
        text_id("doc_id", 2), F.col("text").alias("document"))
    return flat(writes.upsert(collection(spark, folder), changes, DIMENSION))


@query
def upsert_duplicates_last_wins(spark, folder):
    """A conversation is one id; its turns are changes in order."""
    changes = table(spark, folder, "conversations").select(
        text_id("conv_id", 7), F.col("text").alias("document"), F.col("turn").alias("seq"))
    return flat(writes.upsert(collection(spark, folder), changes, DIMENSION))


@query
def delete_ids(spark, folder):
    toxic = table(spark, folder, "labels").where("toxic = 1").select(text_id("doc_id"))
    return writes.delete(collection(spark, folder), ids=toxic).select("_id")


@query
def delete_metadata(spark, folder):
    return writes.delete(collection(spark, folder), where=where.eq("quality", 0)).select("_id")


@query
def delete_document(spark, folder):
    return writes.delete(collection(spark, folder), where=where.eq("lang", "en"),
                         where_document=Contains("license")).select("_id")


@query
def validate_dimensions(spark, folder):
    return conform(collection(spark, folder)).agg(*writes.batch_report(DIMENSION))


@query
def collection_lifecycle(spark, folder):
    """Create, open, add, upsert and delete, each as a stored snapshot."""
    name = f"lifecycle_{uuid.uuid4().hex[:12]}"
    create_collection(spark, name, DIMENSION, "cosine", collection(spark, folder))
    stored = open_collection(spark, name, EMBEDDER)
    stored.add(spread(table(spark, folder, "conversations")).select(
        F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("_id"), F.col("text").alias("document")))
    stored.upsert(table(spark, folder, "labels").select(
        text_id("doc_id", 3), json_of("quality").alias("metadata")))
    stored.delete(where=where.eq("lang", "de"))
    return flat(stored.rows())


# Vector search

@query
def vector_distances(spark, folder):
    """The distances of each vector to its successor."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    after = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    pair = vectors.join(after, "vec_id")
    return pair.select("vec_id", *[
        (F.round(f("embedding", "other"), 6) + F.lit(0.0)).alias(n) for n, f in
        (("l2", l2_distance), ("cosine", cosine_distance), ("inner_product", inner_product))])


def _knn(spark, folder, distance, **options):
    return ranked(nearest.nearest(collection(spark, folder), vector_queries(spark, folder), 10,
                                  distance, include=[], dimension=DIMENSION, **options))


@query
def knn_l2(spark, folder):
    return _knn(spark, folder, "l2")


@query
def knn_large_k(spark, folder):
    """Far more hits for each query than usual, of rows that are more still."""
    queries = vector_queries(spark, folder).where("query_id % 20 = 0")
    return ranked(nearest.nearest(hashed_collection(spark, folder), queries, 600, "l2", include=[]))


@query
def knn_cosine(spark, folder):
    return _knn(spark, folder, "cosine")


@query
def knn_inner_product(spark, folder):
    return _knn(spark, folder, "inner_product")


@query
def knn_most_similar_product(spark, folder):
    return _knn(spark, folder, "negative_inner_product")


@query
def knn_filtered(spark, folder):
    hits = nearest.nearest(
        collection(spark, folder), vector_queries(spark, folder), 10, "cosine",
        where=where.eq("lang", "en"), where_document=Contains(WORDS), dimension=DIMENSION)
    return ranked(hits.withColumn("lang", field("lang", "string")), "document", "lang")


@query
def knn_nested(spark, folder):
    """Every query keeps its row; hits come back in rank order."""
    queries = vector_queries(spark, folder)
    hits = nearest.nearest(collection(spark, folder), queries, 5, "l2", where=where.eq("toxic", 1),
                           include=[], dimension=DIMENSION)
    packed = nearest.nested(hits, queries)
    return packed.select("query_id", F.array_size("hits").cast("bigint").alias("n_hits"),
                         F.array_join(F.transform("hits", lambda h: h["_id"]), ",").alias("ids"))


@query
def knn_text(spark, folder):
    return ranked(nearest.nearest_texts(hashed_collection(spark, folder), text_queries(spark, folder),
                                        10, EMBEDDER, distance="cosine", include=[]))


@query
def approx_full_probe(spark, folder):
    rows = collection(spark, folder)
    model = cells.train_cells(rows, 8, "cosine")
    indexed = cells.assign_cells(rows, model)
    return ranked(cells.nearest_in_cells(indexed, model, vector_queries(spark, folder), 10, 8, "cosine", include=[]))


def label_centres(spark, folder) -> DataFrame:
    """`(cell, embedding)`: the mean vector of each class."""
    each = table(spark, folder, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = each.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.groupBy(F.col("label").alias("cell")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda c: c["x"]).alias("embedding"))


@query
def approx_probe(spark, folder):
    """Four cells of each query, around the mean vectors of the classes."""
    rows, model = collection(spark, folder), cells.centres_from(label_centres(spark, folder), "cosine")
    return ranked(cells.nearest_in_cells(cells.assign_cells(rows, model), model, vector_queries(spark, folder), 10, 4,
                                         "cosine", include=[]))


# Hybrid search

@query
def hybrid_simple(spark, folder):
    return ranked(hybrid.hybrid_search(
        hashed_collection(spark, folder), text_queries(spark, folder), where.eq("lang", "en"),
        Contains(WORDS), 10, [], embedder=EMBEDDER, index=stored_index(spark, folder)))


@query
def hybrid_simple_texts(spark, folder):
    return ranked(hybrid.hybrid_search(hashed_collection(spark, folder), text_queries(spark, folder),
                                       n_results=5, include=[], embedder=EMBEDDER))


@query
def hybrid_text_branch(spark, folder):
    text = hybrid.TextBranch(where.gte("n_chars", 500), AllOf(Contains("license"), Contains(WORDS)),
                             stored_index(spark, folder))
    return ranked(hybrid.hybrid_search_advanced(collection(spark, folder), text, n_results=50, include=[]))


@query
def hybrid_text_regex(spark, folder):
    """Words score, the pattern filters."""
    text = hybrid.TextBranch(where.eq("lang", "en"), AllOf(Contains(WORDS), Regex("[0-9]")))
    return ranked(hybrid.hybrid_search_advanced(collection(spark, folder), text, n_results=50, include=[]))


@query
def hybrid_metadata_branch(spark, folder):
    text = hybrid.TextBranch(where.eq("quality", 0))
    return ranked(hybrid.hybrid_search_advanced(collection(spark, folder), text, n_results=20, include=[]))


@query
def hybrid_knn_only(spark, folder):
    """`n_results` of the call holds, not that of the branch."""
    knn = hybrid.KnnBranch(vector_queries(spark, folder), where.eq("lang", "en"), n_results=3)
    return ranked(hybrid.hybrid_search_advanced(collection(spark, folder), None, knn, None, 7, [], "l2"))


@query
def hybrid_rrf(spark, folder):
    """Text and vector branch with filters of their own, fused over a window."""
    text = hybrid.TextBranch(where.eq("lang", "en"), Contains(WORDS), stored_index(spark, folder))
    knn = hybrid.KnnBranch(vector_queries(spark, folder), where.gte("n_chars", 500), n_results=20)
    return ranked(hybrid.hybrid_search_advanced(
        collection(spark, folder), text, knn, hybrid.Rrf(30, 20), 10, [], "cosine"))


@query
def hybrid_rrf_texts(spark, folder):
    """A table of texts and a table of vectors, fused for each query id."""
    text = hybrid.TextBranch(where.eq("lang", "en"), index=stored_index(spark, folder),
                             queries=text_queries(spark, folder))
    knn = hybrid.KnnBranch(vector_queries(spark, folder), where.gte("n_chars", 500), n_results=20)
    return ranked(hybrid.hybrid_search_advanced(
        collection(spark, folder), text, knn, hybrid.Rrf(30, 20), 10, [], "cosine"))


@query
def hybrid_filtered(spark, folder):
    text = hybrid.TextBranch(where.eq("lang", "en"), Contains(WORDS))
    knn = hybrid.KnnBranch(vector_queries(spark, folder), where.gte("n_chars", 500))
    return ranked(hybrid.hybrid_filtered(collection(spark, folder), text, knn, 10, [], "cosine"))


@query
def hybrid_filter_only(spark, folder):
    text = hybrid.TextBranch(where.eq("lang", "fr"), Contains(WORDS))
    return ranked(hybrid.hybrid_filtered(collection(spark, folder), text, None, 15, []))


@query
def hybrid_distances(spark, folder):
    text = hybrid.TextBranch(where.eq("lang", "en"), Contains("license"))
    hits = hybrid.hybrid_search_advanced(collection(spark, folder), text, n_results=25, include=[])
    return hybrid.with_distances(hits).select("rank", "_id", F.round("distances", 6).alias("distances"))


# Reads

@query
def get_page(spark, folder):
    return reads.get(collection(spark, folder), where=where.eq("lang", "en"), limit=20, offset=10,
                     include=["documents"])


@query
def get_deep_page(spark, folder):
    """A page whose both ends are found by a sketch of the ids."""
    return reads.get(events(spark, folder), limit=50, offset=5000, include=[])


@query
def get_offset_only(spark, folder):
    return reads.get(collection(spark, folder), offset=25, include=[])


@query
def peek(spark, folder):
    return flat(reads.peek(collection(spark, folder), 10))


@query
def count(spark, folder):
    return reads.count(collection(spark, folder))


# Embedding

@query
def embed_hash(spark, folder):
    vectors = spread(table(spark, folder, "documents")).select(
        "doc_id", F.posexplode(EMBEDDER.embed(F.col("text"))).alias("pos", "value"))
    return vectors.where("value <> 0").select(
        "doc_id", F.col("pos").cast("bigint"), F.round(F.col("value").cast("double"), 6).alias("value"))


@query
def mean_pool_labels(spark, folder):
    """Mean vector per class, with the vectors of unlabelled or toxic documents masked."""
    labels = table(spark, folder, "labels").withColumnRenamed("doc_id", "vec_id")
    rows = table(spark, folder, "embeddings").join(labels, "vec_id", "left").select(
        F.col("label").cast("bigint").alias("label"), F.col("embedding").alias("vector"),
        F.coalesce(1 - F.col("toxic"), F.lit(0)).alias("mask"))
    means = mean_pool(rows, "label")
    return means.select("label", F.posexplode("embedding").alias("pos", "value")).select(
        "label", F.col("pos").cast("bigint"),
        (F.round(F.col("value").cast("double"), 6) + F.lit(0.0)).alias("value"))


# Stored collections

def stored_collection(spark: SparkSession, folder: str, tokenizer: str = "words", keys=None):
    return create_collection(spark, f"query_{uuid.uuid4().hex[:12]}", DIMENSION, "cosine", collection(spark, folder),
                             EMBEDDER, tokenizer=tokenizer, keys=keys)


def vector_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors and metadata for every third id."""
    return table(spark, folder, "embeddings").select(text_id("vec_id", 3), "embedding", json_of("label").alias("metadata"))


@query
def update_stored(spark, folder):
    """`update_fields` on a stored collection: only folders of changed ids are written."""
    held = stored_collection(spark, folder)
    held.update(vector_changes(spark, folder))
    return flat(held.rows())


@query
def delete_stored(spark, folder):
    held = stored_collection(spark, folder)
    held.delete(ids=table(spark, folder, "labels").where("toxic = 1").select(text_id("doc_id")))
    held.delete(where=where.eq("quality", 0))
    return held.rows().select("_id")


@query
def get_ids_stored(spark, folder):
    """Rows by a table of ids, from the folders of those ids."""
    good = table(spark, folder, "labels").where("quality = 1").select(text_id("doc_id"))
    return stored_collection(spark, folder).get(ids=good, include=["documents"])


@query
def filter_stored(spark, folder):
    """`filter_and` on keys that are stored as plain columns."""
    held = stored_collection(spark, folder, keys={"lang": "string", "n_chars": "number"})
    by = held.filters
    return held.get(where=where.all_of(by.eq("lang", "en"), by.eq("quality", 1), by.gt("n_chars", 1000)), include=[])


@query
def bm25_stored(spark, folder):
    """Ranked texts from postings that lie in folders by word."""
    held = stored_collection(spark, folder)
    held.build_text_index()
    return ranked(held.search_text(text_queries(spark, folder), 10, include=[]))


@query
def bm25_after_writes(spark, folder):
    """The same postings after an upsert, a delete and an add."""
    held = stored_collection(spark, folder)
    held.build_text_index()
    held.upsert(spread(table(spark, folder, "documents")).select(text_id("doc_id", 2), F.col("text").alias("document")))
    held.delete(where=where.eq("lang", "de"))
    held.add(spread(table(spark, folder, "conversations")).select(
        F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("_id"), F.col("text").alias("document")))
    return ranked(held.search_text(text_queries(spark, folder), 10, include=[]))


@query
def knn_after_writes(spark, folder):
    """All cells of an index that an update and a delete came after."""
    held = stored_collection(spark, folder)
    held.build_vector_index(8)
    held.update(vector_changes(spark, folder))
    held.delete(where=where.eq("lang", "de"))
    return ranked(held.query(vector_queries(spark, folder), 10, include=[], probes=8))


@query
def hybrid_pairs(spark, folder):
    """A collection that keeps pairs of characters as its words, searched through its postings."""
    held = stored_collection(spark, folder, "pairs")
    held.build_text_index()
    text = hybrid.TextBranch(where.gte("n_chars", 500), AllOf(Contains("license", pair_tokens), Contains(WORDS, pair_tokens)))
    return ranked(held.hybrid_search_advanced(text, n_results=50, include=[]))


@query
def hybrid_probe(spark, folder):
    """`hybrid_rrf` with the stored postings and all stored cells."""
    held = stored_collection(spark, folder)
    held.build_text_index()
    held.build_vector_index(8)
    text = hybrid.TextBranch(where.eq("lang", "en"), Contains(WORDS))
    knn = hybrid.KnnBranch(vector_queries(spark, folder), where.gte("n_chars", 500), n_results=20, probes=8)
    return ranked(held.hybrid_search_advanced(text, knn, hybrid.Rrf(30, 20), 10, []))
