"""Value tables of every type, repeated queries, unspaced scripts, pages, conflicts."""

import pytest
from pyspark.sql import functions as F

from docweave.errors import ConfigError, InvalidInputError
from docweave.functions.text import Contains, pair_tokens
from docweave.operators import fulltext, hybrid, nearest, reads
from docweave.sources import storage
from conftest import ids


@pytest.mark.parametrize("kind, asked, expected", [
    ("bigint", [9007199254740992], ["even"]), ("bigint", [9007199254740993], ["odd"]), ("bigint", [1], ["one", "whole"]),
    ("double", [1.0, 0.5], ["half", "one", "whole"]), ("boolean", [True], ["true"]), ("string", ["1"], ["text"]),
    ("decimal(3,1)", [1], ["one", "whole"]), ("bigint", [None], [])])
def test_value_tables_compare_by_kind(spark, rows, kind, asked, expected):
    held = rows(*[(i, "", None, f'{{"v": {v}}}') for i, v in [
        ("even", 9007199254740992), ("odd", 9007199254740993), ("one", 1), ("whole", "1.0"), ("half", 0.5),
        ("true", "true"), ("text", '"1"'), ("none", "null")]] + [("without", "", None, "{}")])
    values = spark.createDataFrame([(a,) for a in asked], f"x {'long' if kind.startswith('dec') else kind}").select(F.col("x").cast(kind))
    assert ids(reads.field_in(held, "v", values)) == expected


def test_value_tables_refuse_other_types(spark, rows):
    with pytest.raises(InvalidInputError):
        reads.field_in(rows(("a", "", None, "{}")), "v", spark.sql("SELECT date'2020-01-01' AS d"))


@pytest.mark.parametrize("local", [True, False])
def test_repeated_query_ids_are_refused(spark, rows, local, monkeypatch):
    if not local:
        monkeypatch.setattr(nearest.sizing, "MAX_BROADCAST_BYTES", 1)
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0])], "query_id int, embedding array<float>")
    with pytest.raises(InvalidInputError, match="repeated"):
        nearest.nearest(rows(("a", "", [1, 0], None)), queries, 1)


def test_row_blocks_do_not_shrink_with_k(spark, monkeypatch):
    """With k above the row count of a block of queries, rows still stay together."""
    monkeypatch.setattr(nearest.sizing, "MAX_TASK_HITS", 100)
    monkeypatch.setattr(nearest.sizing, "MAX_BROADCAST_BYTES", 1)
    rows = spark.range(300).select(F.col("id").cast("string").alias("_id"), F.array(F.col("id").cast("float")).alias("embedding"))
    queries = spark.range(7).select(F.col("id").alias("query_id"), F.array(F.col("id").cast("float")).alias("embedding"))
    checked = nearest.check_queries(queries, 1, 50)
    assert nearest._with_blocks(rows, checked, 50, "l2").count() == 7 * 50


def test_pairs_for_scripts_without_spaces(spark, rows):
    found = spark.sql("SELECT '我们研究 GPU4 ไทย か' AS t").select(pair_tokens("t")).first()[0]
    assert found == ["我们", "们研", "研究", "gpu4", "ไท", "ทย", "か"]
    held = rows(("a", "我们研究机器学习算法", None, "{}"), ("b", "天气很好", None, "{}"), ("c", None, None, "{}"))
    asked = Contains("机器学习", pair_tokens)
    assert ids(held.where(asked.column())) == ["a"]
    index = fulltext.term_index(held, pair_tokens)
    assert ids(fulltext.bm25_one(index, "机器学习", 5, tokenizer=pair_tokens)) == ["a"]
    branch = hybrid.TextBranch(where_document=asked, index=index, tokenizer=pair_tokens)
    assert ids(hybrid.text_branch(held, branch, 5)) == ["a"]


def test_pages_sort_ids_only(rows):
    held = rows(*[(f"{i:03d}", f"text {i}", None, "{}") for i in range(50)])
    for direct in (reads.DIRECT_PAGE, 5):
        for limit, offset in ((5, 10), (100, 45), (3, 50), (0, 2), (None, 48), (60, 0)):
            page = reads.page(held, limit, offset, direct)
            expected = [f"{i:03d}" for i in range(50)][offset:][:limit]
            assert [r["_id"] for r in page.collect()] == expected
            assert "TakeOrdered" not in page._jdf.queryExecution().executedPlan().toString()


def test_a_cluster_needs_a_shared_folder(spark):
    class Conf:
        def __init__(self, **held):
            self.held = held

        def get(self, key, default=None):
            return self.held.get(key, default)

    class Session:
        def __init__(self, master, **held):
            self.conf = Conf(**{"spark.master": master, "spark.sql.warehouse.dir": "/w"} | held)

    assert storage.storage_root(Session("local[2]")) == "/w/docweave"
    assert storage.storage_root(Session("yarn", **{"spark.checkpoint.dir": "/s/"})) == "/s/docweave"
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ConfigError):
            storage.storage_root(Session(master))
