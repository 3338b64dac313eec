import uuid

import pytest
from conftest import ids, ranked_ids
from pyspark.sql import functions as F

from docweave import (
    BatchEmbedding, ConfigError, Contains, DuplicateIdError, EmbeddingError, InvalidInputError, KnnBranch,
    NotFoundError, Rrf, TextBranch, create_collection, open_collection,
)
from docweave.functions import filters as f
from docweave.schema import table_name

HALVES = BatchEmbedding.of(lambda texts: [[0.5, 0.5, 0.5]] * len(texts), 3)


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex[:10]}"


@pytest.fixture
def items(rows):
    return rows(("item1", "vector databases", [0.1, 0.2, 0.3], '{"category": "AI", "score": 95}'),
                ("item2", "machine learning", [0.4, 0.5, 0.7], '{"category": "ML", "score": 88}'))


def test_names():
    assert table_name("a_B9") == "c_v1_a_B9"
    assert table_name("x" * 59)
    for bad in ("", "a-b", "a b", "ä", "x" * 60, "a$b"):
        with pytest.raises(InvalidInputError):
            table_name(bad)


def test_create_needs_settings(spark, name):
    for dimension, distance in ((None, "cosine"), (3, None), (0, "l2"), (3, "manhattan")):
        with pytest.raises(ConfigError):
            create_collection(spark, name, dimension, distance)
    with pytest.raises(NotFoundError):
        open_collection(spark, name)


def test_open_recovers_settings(spark, name, items):
    create_collection(spark, name, 3, "ip")
    with pytest.raises(InvalidInputError):
        create_collection(spark, name, 3, "ip")
    again = open_collection(spark, name)
    assert (again.dimension, again.distance, again.count()) == (3, "inner_product", 0)
    spark.sql(f"ALTER TABLE {again.table} UNSET TBLPROPERTIES ('vector.dimension', 'vector.distance')")
    with pytest.raises(ConfigError):
        open_collection(spark, name)
    again.add(items)
    guessed = open_collection(spark, name)
    assert (guessed.dimension, guessed.distance) == (3, "l2")
    spark.sql(f"ALTER TABLE {again.table} SET TBLPROPERTIES ('vector.distance' = 'ip')")
    assert open_collection(spark, name).distance == "inner_product"


def test_create_checks_rows(spark, name, items):
    with pytest.raises(InvalidInputError):
        create_collection(spark, name, 4, "l2", items)
    with pytest.raises(DuplicateIdError):
        create_collection(spark, name, 3, "l2", items.unionAll(items))
    assert not spark.catalog.tableExists(table_name(name))


def test_life_of_a_collection(spark, name, items):
    c = create_collection(spark, name, 3, "cosine", items)
    first = c.rows().inputFiles()
    hits = c.query(spark.createDataFrame([(0, [0.1, 0.2, 0.3])], "query_id int, embedding array<float>"), 2)
    assert ranked_ids(hits) == ["item1", "item2"]
    c.update(spark.createDataFrame([("item1", '{"category": "DB", "score": 99}')], "_id string, metadata string"))
    assert ids(c.get(where=f.gte("score", 95))) == ["item1"]
    c.upsert(spark.createDataFrame([("item3", "new", [1.0, 0.0, 0.0])],
                                   "_id string, document string, embedding array<float>"))
    assert c.count() == 3 and c.peek(2).columns == ["_id", "document", "metadata", "embedding"]
    with pytest.raises(DuplicateIdError):
        c.add(items)
    c.delete(where_document=Contains("machine"))
    assert ids(c.get()) == ["item1", "item3"]
    c.delete(ids=["item1", "item3"])
    assert c.count() == 0
    assert spark.read.parquet(*first).count() == 2  # old snapshots stay readable
    with pytest.raises(InvalidInputError):
        c.delete()


def test_text_needs_an_embedder(spark, name):
    c = create_collection(spark, name, 3, "cosine")
    queries = spark.createDataFrame([(0, "hello rust")], "query_id int, text string")
    documents = spark.createDataFrame([("a1", "hello rust"), ("a2", "vector")], "_id string, document string")
    with pytest.raises(EmbeddingError):
        c.query(queries)
    with pytest.raises(EmbeddingError):
        c.hybrid_search(queries)
    for write in (c.add, c.update):
        with pytest.raises(InvalidInputError):
            write(documents)
    with_model = open_collection(spark, name, HALVES)
    with_model.add(documents)
    assert ranked_ids(with_model.query(queries, 2)) == ["a1", "a2"]
    wrong = open_collection(spark, name, BatchEmbedding.of(lambda t: [[1.0, 2.0]] * len(t), 2))
    with pytest.raises(InvalidInputError):
        wrong.query(queries)
    with pytest.raises(InvalidInputError):
        wrong.upsert(documents)


def test_a_batch_is_embedded_once(spark, name):
    calls = spark.sparkContext.accumulator(0)

    def load():
        def run(listed):
            calls.add(len(listed))
            return [[1.0, 2.0, 3.0]] * len(listed)

        return run

    c = create_collection(spark, name, 3, "cosine", embedder=BatchEmbedding(load, 3))
    c.add(spark.createDataFrame([("a", "x"), ("b", "y")], "_id string, document string"))
    assert calls.value == 2


def test_indexes_follow_writes(spark, name, items):
    c = create_collection(spark, name, 3, "cosine", items, HALVES)
    queries = spark.createDataFrame([(0, [0.1, 0.2, 0.3])], "query_id int, embedding array<float>")
    with pytest.raises(ConfigError):
        c.query(queries, 2, probes=1)
    c.build_vector_index(2)
    c.build_text_index()
    assert ids(c.query(queries, 2, probes=2)) == ids(c.query(queries, 2)) == ["item1", "item2"]
    text = TextBranch(f.eq("category", "ML"), Contains("machine"))
    both = c.hybrid_search_advanced(text, KnnBranch(queries), Rrf(), 5)
    assert c.text_index() is not None and set(ids(both)) == {"item1", "item2"}
    assert ids(c.hybrid_search(where_document=Contains("databases"))) == ["item1"]
    c.add(spark.createDataFrame([("item9", "more databases", [1.0, 1.0, 1.0])],
                                "_id string, document string, embedding array<float>"))
    assert ids(c.hybrid_search(where_document=Contains("databases"))) == ["item1", "item9"]
    assert ids(c.query(queries, 5, probes=2)) == ["item1", "item2", "item9"]
    c.delete(ids=["item1"])
    assert ids(c.hybrid_search(where_document=Contains("databases"))) == ["item9"]
    assert ids(c.query(queries, 5, probes=2)) == ["item2", "item9"]
    assert ids(c.hybrid_filtered(text)) == ["item2"]


def test_metadata_survives_storage(spark, name, rows):
    c = create_collection(spark, name, 2, "l2", rows(
        ("a", "d", [1, 2], '{"x": {"y": [1, "2", null, true]}, "z": 1.5}'), ("b", "d", None, "null"),
        ("c", "d", None, None)))
    got = {r["_id"]: r["m"] for r in c.rows().select("_id", F.to_json("metadata").alias("m")).collect()}
    assert got == {"a": '{"x":{"y":[1,"2",null,true]},"z":1.5}', "b": "null", "c": None}
