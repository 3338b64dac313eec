"""Texts are shuffled and stored no more often than the work needs."""

import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docweave import Contains, create_collection
from docweave.functions import filters as f
from docweave.operators import fulltext, hybrid
from docweave.plans import sizing, testbed
from docweave.sources import collection, versions
from docweave.sources.versions import FOLDER


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark, monkeypatch):
    """Nothing counts as small enough to be sent to every task."""
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def folder(spark, tmp_path):
    """Documents, some with vectors and labels."""
    tables = {
        "documents": spark.range(60).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'en' AS lang",
                                                "'web' AS source", "id AS n_chars"),
        "embeddings": spark.range(30).selectExpr("id AS vec_id", "transform(sequence(1, 64), x -> float(x)) AS embedding",
                                                 "int(id % 3) AS label"),
        "labels": spark.range(0, 60, 2).selectExpr("id AS doc_id", "int(id % 4 / 2) AS quality", "0 AS toxic")}
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_upsert_shuffles_each_side_once(spark, large, folder):
    """The collection is joined and merged by one key: three shuffles for its tables, one for the batch."""
    out = testbed.upsert_full(spark, folder)
    assert plan_of(out).count("Exchange ") <= 4
    rows = {r["_id"]: r for r in out.collect()}
    assert len(rows) == 60
    assert (rows["4"]["document"], rows["4"]["label"], rows["4"]["quality"]) == ("text 2", 2, None)
    assert (rows["3"]["document"], rows["3"]["n_dims"], rows["59"]["n_dims"]) == ("text 3", 64, None)
    assert (rows["6"]["n_chars"], rows["58"]["document"], rows["8"]["lang"]) == (3, "text 29", "en")


@pytest.fixture
def shuffles(monkeypatch):
    """Shuffles of each later write of rows into folders."""
    seen, write = [], versions.write_rows

    def counted(rows, *rest):
        seen.append(plan_of(rows).count("Exchange ") + (FOLDER not in rows.columns))
        write(rows, *rest)

    monkeypatch.setattr(versions, "write_rows", counted)
    return seen


def held(spark, n=40):
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("_id"), F.concat(F.lit("text "), "id").alias("document"),
        F.array(F.lit(1.0), F.col("id")).cast("array<float>").alias("embedding"),
        F.parse_json(F.to_json(F.struct((F.col("id") % 4).alias("n")))).alias("metadata"))
    return create_collection(spark, f"s_{uuid.uuid4().hex[:10]}", 2, "l2", rows)


def test_a_collection_is_made_without_a_copy(spark, monkeypatch):
    monkeypatch.setattr(collection, "stored", lambda *given: pytest.fail("rows were stored twice"))
    assert held(spark).count() == 40


def test_large_batches_meet_stored_rows_in_one_shuffle(spark, large, shuffles):
    c = held(spark)
    del shuffles[:]
    changes = spark.createDataFrame([("3", None, "{}"), ("5", "new", None), ("x", None, None), ("y", "y", "null")],
                                    "_id string, document string, metadata string")
    c.update(changes.withColumn("embedding", F.lit(None).cast("array<double>")))
    assert c.count() == 40
    c.upsert(changes)
    assert shuffles == [1, 1]
    assert max(len(list(paths)) for paths in c.version().rows.values()) <= 2
    rows = {r["_id"]: r for r in c.rows().withColumn("metadata", F.to_json("metadata")).collect()}
    assert len(rows) == 42
    assert (rows["3"]["document"], rows["3"]["metadata"], rows["3"]["embedding"]) == ("text 3", "{}", [1.0, 3.0])
    assert (rows["5"]["document"], rows["5"]["metadata"]) == ("new", '{"n":1}')
    assert (rows["x"]["document"], rows["x"]["metadata"], rows["x"]["embedding"]) == ("", "null", None)
    assert (rows["y"]["document"], rows["6"]["document"]) == ("y", "text 6")


def test_deletes_write_rows_where_they_lie(spark, shuffles):
    c = held(spark)
    del shuffles[:]
    c.delete(where=f.eq("n", 1))
    c.delete(ids=["0", "4"])
    assert shuffles == [0, 0]
    c.delete(ids=spark.createDataFrame([("8",), ("12",)], "_id string"))
    assert sorted(int(r[0]) for r in c.rows().select("_id").collect()) == [
        i for i in range(40) if i % 4 != 1 and i not in (0, 4, 8, 12)]


def test_deletes_by_many_ids_keep_files_few(spark, large):
    c = held(spark)
    c.delete(ids=spark.createDataFrame([("8",), ("12",)], "_id string"))
    assert c.count() == 38
    files = c.rows().select("_metadata.file_path").distinct().count()
    assert files <= len(c.version().rows)


def test_words_are_counted_as_arrays():
    lists = [["b", "a", "b"], None, [], ["a", None, "é", "a"], None]
    got = fulltext.counted_words(pa.array([["cut"], *lists], pa.list_(pa.string())).slice(1)).to_pylist()
    assert got == [[{"token": "a", "tf": 1}, {"token": "b", "tf": 2}], None, [],
                   [{"token": "a", "tf": 2}, {"token": "é", "tf": 1}], None]
    assert fulltext.counted_words(pa.array([], pa.list_(pa.string()))).to_pylist() == []


def test_one_text_needs_no_term_index(spark, rows, monkeypatch):
    """Texts are read once, for the asked words; the ranking is that from a term index."""
    base = rows(*[(f"r{i:02d}", None if i == 7 else " ".join(["cat", "dog", "dog", "eel"][:i % 5]) + " x" * (i % 3),
                   None, f'{{"n": {i % 4}}}') for i in range(40)])
    branch = hybrid.TextBranch(f.gte("n", 1), Contains("dog cat none"))
    for text in ("dog cat none", "none", ""):
        for where in (None, f.gte("n", 1)):
            made = fulltext.bm25_one(fulltext.term_index(base), text, 6, where).orderBy("rank").collect()
            assert fulltext.bm25_one(base, text, 6, where).orderBy("rank").collect() == made
    monkeypatch.setattr(hybrid, "term_index", lambda *given: pytest.fail("all words were counted"))
    hits = hybrid.text_branch(base, branch, 6).orderBy("rank").collect()
    found = fulltext.bm25(fulltext.term_index(base), spark.sql("SELECT 0 AS query_id, 'dog cat none' AS text"), 6,
                          f.gte("n", 1)).orderBy("rank").collect()
    assert len(hits) == 6 and hits == found
