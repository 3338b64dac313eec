import pytest
from conftest import ids
from pyspark.sql import functions as F

from docweave.errors import DuplicateIdError, InvalidInputError
from docweave.functions import filters as f
from docweave.functions.embedding import BatchEmbedding
from docweave.functions.text import Contains
from docweave.operators import writes
from docweave.plans import sizing

HALVES = BatchEmbedding.of(lambda texts: [[0.5] * 3 for _ in texts], 3)


@pytest.fixture
def base(rows):
    return rows(("id1", "doc1", [1, 2, 3], '{"category": "a", "n": 1}'),
                ("id2", "doc2", [2, 3, 4], '{"category": "b"}'),
                ("id3", None, None, None))


def state(frame):
    out = frame.withColumn("metadata", F.to_json("metadata")).collect()
    return {r["_id"]: (r["document"], r["embedding"], r["metadata"]) for r in out}


def changes(spark, schema, *given):
    return spark.createDataFrame([tuple(g) for g in given], schema)


def test_add(base, rows, spark):
    new = changes(spark, "_id string, embedding array<float>", ("x", [1.0, 1.0, 1.0]))
    after = state(writes.add(base, new, 3))
    assert len(after) == 4 and after["x"] == ("", [1, 1, 1], None)


def test_add_embeds_documents(base, spark):
    new = changes(spark, "_id string, document string", ("auto", "hello"))
    assert state(writes.add(base, new, 3, HALVES))["auto"] == ("hello", [0.5] * 3, None)


@pytest.mark.parametrize("schema,row,error", [
    ("_id string, embedding array<float>", ("id1", [1.0, 1.0, 1.0]), DuplicateIdError),
    ("_id string, embedding array<float>", ("x", [1.0, 1.0]), InvalidInputError),
    ("_id string, embedding array<float>", ("x", None), InvalidInputError),
    ("_id string, embedding array<float>", (None, [1.0, 1.0, 1.0]), InvalidInputError),
    ("_id string, document string", ("x", "no embedder"), InvalidInputError),
    ("_id string, metadata string", ("x", "{}"), InvalidInputError),
])
def test_add_refuses(base, spark, schema, row, error):
    with pytest.raises(error):
        writes.add(base, changes(spark, schema, row), 3)


def test_add_refuses_repeats_and_nothing(base, spark):
    one = changes(spark, "_id string, embedding array<float>", ("x", [1.0, 1.0, 1.0]))
    with pytest.raises(DuplicateIdError):
        writes.add(base, one.unionAll(one), 3)
    with pytest.raises(InvalidInputError):
        writes.add(base, one.limit(0), 3)


def test_update(base, spark):
    new = changes(spark, "_id string, metadata string", ("id1", '{"k": 1}'), ("nobody", "{}"), ("id2", None))
    after = state(writes.update(base, new, 3))
    assert sorted(after) == ["id1", "id2", "id3"]
    assert after["id1"] == ("doc1", [1, 2, 3], '{"k":1}')       # replaced whole
    assert after["id2"] == ("doc2", [2, 3, 4], '{"category":"b"}')  # NULL cell keeps
    assert state(writes.update(base, new.limit(0), 3)) == state(base)


def test_update_documents_need_vectors(base, spark):
    new = changes(spark, "_id string, document string", ("id1", "new"))
    with pytest.raises(InvalidInputError):
        writes.update(base, new, 3)
    assert state(writes.update(base, new, 3, HALVES))["id1"][:2] == ("new", [0.5] * 3)
    with pytest.raises(InvalidInputError):
        writes.update(base, new.select("_id"), 3)


@pytest.mark.parametrize("small", [True, False])
def test_upsert_field_by_field(base, spark, small, monkeypatch):
    """The broadcast plan and the shuffled plan give the same rows."""
    if not small:
        monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 0)
    metadata = changes(spark, "_id string, metadata string", ("id1", '{"cnt": 2}'), ("new", '{"x": 1}'),
                       ("id2", "null"))
    after = state(writes.upsert(base, metadata, 3))
    assert after["id1"] == ("doc1", [1, 2, 3], '{"cnt":2}')
    assert after["id2"][2] == "null"                    # JSON null is a value
    assert after["new"] == ("", None, '{"x":1}')
    assert after["id3"] == (None, None, None)           # untouched rows stay as they are

    document = changes(spark, "_id string, document string", ("id1", "new_doc"), ("new", "d"))
    after = state(writes.upsert(base, document, 3))
    assert after["id1"] == ("new_doc", [1, 2, 3], '{"category":"a","n":1}')
    assert after["new"] == ("d", None, "null")

    vector = changes(spark, "_id string, embedding array<float>", ("id1", [3.0, 2.0, 1.0]))
    assert state(writes.upsert(base, vector, 3))["id1"][:2] == ("doc1", [3, 2, 1])

    embedded = state(writes.upsert(base, document, 3, HALVES))
    assert embedded["id1"][1] == [0.5] * 3


@pytest.mark.parametrize("small", [True, False])
def test_last_change_wins(base, spark, small, monkeypatch):
    if not small:
        monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 0)
    new = changes(spark, "_id string, document string, metadata string, seq int",
                  ("id1", "first", '{"a": 1}', 1), ("id1", "third", None, 3), ("id1", None, '{"a": 2}', 2),
                  ("n", "x", None, 1), ("n", "y", None, 2))
    after = state(writes.upsert(base, new, 3))
    assert after["id1"] == ("third", [1, 2, 3], '{"a":2}')
    assert after["n"] == ("y", None, "null")
    for unclear in (new.drop("seq"), new.withColumn("seq", F.lit(1)),
                    new.withColumn("seq", F.lit(None).cast("int"))):
        with pytest.raises(InvalidInputError):
            writes.upsert(base, unclear, 3)


def test_upsert_refuses(base, spark):
    with pytest.raises(InvalidInputError):
        writes.upsert(base, changes(spark, "_id string, document string", ("x", "y")).limit(0), 3)
    with pytest.raises(InvalidInputError):
        writes.upsert(base, changes(spark, "_id string", ("x",)), 3)
    with pytest.raises(InvalidInputError):
        writes.upsert(base, changes(spark, "_id string, embedding array<float>", ("x", [1.0])), 3)


def test_delete(base, spark):
    assert ids(writes.delete(base, ids=["id2", "nobody"])) == ["id1", "id3"]
    assert ids(writes.delete(base, where=f.eq("category", "a"))) == ["id2", "id3"]
    assert ids(writes.delete(base, where_document=Contains("doc2"))) == ["id1", "id3"]
    assert ids(writes.delete(base, ids=["id1", "id2"], where=f.eq("category", "a"))) == ["id2", "id3"]
    table = changes(spark, "_id string", ("id1",), ("id3",), ("id1",))
    assert ids(writes.delete(base, ids=table)) == ["id2"]
    assert ids(writes.delete(base, ids=table, where=f.eq("category", "a"))) == ["id2", "id3"]
    assert ids(writes.delete(base, ids=table.limit(0))) == ["id1", "id2", "id3"]
    many = [f"id{i}" for i in range(1, 5000)]
    assert ids(writes.delete(base, ids=many)) == []
    with pytest.raises(InvalidInputError):
        writes.delete(base)
    with pytest.raises(InvalidInputError):
        writes.delete(base, ids=[])


def test_small_batches_do_not_shuffle_the_collection(base, spark):
    new = changes(spark, "_id string, metadata string", ("id1", "{}"))
    plan = writes.update(base, new, 3)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
