import json

import pytest
from conftest import ids
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from docweave.errors import InvalidInputError
from docweave.functions import filters as f
from docweave.functions.text import AllOf, AnyOf, Contains, Regex
from docweave.operators import reads

BIG = 2**60 + 1


@pytest.fixture(scope="module")
def typed(spark):
    """One row per kind of stored value under key `v`."""
    values = {
        "int": 12, "float": 12.5, "exp": 1e300, "big": BIG, "text": "12", "word": "abc", "yes": True,
        "no": False, "null": None, "list": [12], "object": {"x": 12},
    }
    data = [(k, json.dumps({"v": v, "other": 1})) for k, v in values.items()] + [("missing", "{}"), ("none", None)]
    frame = spark.createDataFrame(data, "_id string, j string").select(
        "_id", F.parse_json("j").alias("metadata"))
    # Through Parquet, so that the predicates are pushed into the scan.
    from docweave.sources.storage import stored
    return stored(frame, "typed")


EXISTING = ["big", "exp", "float", "int", "list", "no", "null", "object", "text", "word", "yes"]


@pytest.mark.parametrize("predicate,expected", [
    (lambda: f.eq("v", 12), ["int"]),
    (lambda: f.eq("v", 12.0), ["int"]),
    (lambda: f.eq("v", "12"), ["text"]),
    (lambda: f.eq("v", True), ["yes"]),
    (lambda: f.eq("v", False), ["no"]),
    (lambda: f.eq("v", 1), []),
    (lambda: f.eq("v", BIG), ["big"]),
    (lambda: f.eq("v", BIG - 1), []),
    (lambda: f.eq("v", None), []),
    (lambda: f.ne("v", None), []),
    (lambda: f.ne("v", 12), [i for i in EXISTING if i != "int"]),
    (lambda: f.ne("v", "12"), [i for i in EXISTING if i != "text"]),
    (lambda: f.gt("v", 12), ["big", "exp", "float"]),
    (lambda: f.gte("v", 12), ["big", "exp", "float", "int"]),
    (lambda: f.gt("v", BIG), ["exp"]),
    (lambda: f.lt("v", 12.5), ["int"]),
    (lambda: f.lte("v", 12.5), ["float", "int"]),
    (lambda: f.gt("v", "1"), ["text", "word"]),
    (lambda: f.lt("v", "b"), ["text", "word"]),
    (lambda: f.is_in("v", [12, "abc", True]), ["int", "word", "yes"]),
    (lambda: f.is_in("v", [BIG, 12.5]), ["big", "float"]),
    (lambda: f.is_in("v", []), []),
    (lambda: f.not_in("v", []), EXISTING),
    (lambda: f.not_in("v", [12, "12"]), [i for i in EXISTING if i not in ("int", "text")]),
    (lambda: f.is_in("v", [12, None]), ["int"]),
    (lambda: f.not_in("v", [12, None]), []),
    (lambda: f.negate(f.gt("v", 12)), [i for i in EXISTING if i not in ("big", "exp", "float")]),
    (lambda: f.all_of(f.gt("v", 1), f.lt("v", 13)), ["float", "int"]),
    (lambda: f.any_of(f.eq("v", 12), f.eq("v", "abc")), ["int", "word"]),
    (lambda: f.eq("v.x", 12), ["object"]),
    (lambda: f.eq("v[0]", 12), ["list"]),
])
def test_typed_comparison(typed, predicate, expected):
    assert ids(typed.where(predicate())) == sorted(expected)


def test_comparison_reads_only_the_path(typed):
    plan = typed.where(f.gt("v", 12)).select("_id")._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("ReadSchema"):]
    assert "metadata:struct<" in scan  # fields taken out of the VARIANT, not the whole of it


def test_odd_keys(spark):
    text = json.dumps({"a-b": 1, "it's": 2, "x": {"y z": 3}})
    one = spark.createDataFrame([("1", text)], "_id string, j string").select(
        "_id", F.parse_json("j").alias("metadata"))
    for predicate in (f.eq("a-b", 1), f.eq("it's", 2), f.eq("x.y z", 3)):
        assert ids(one.where(predicate)) == ["1"]


@pytest.mark.parametrize("field", ["", ".a", "a..b", "a[", "a[x]", """a'"b"""])
def test_bad_fields(field):
    with pytest.raises(InvalidInputError):
        f.eq(field, 1)


@pytest.mark.parametrize("value", [[1], {"a": 1}, 2**63, float("nan")])
def test_bad_values(value):
    with pytest.raises(InvalidInputError):
        f.eq("a", value)


def test_empty_combinations():
    for call in (f.all_of, f.any_of, AllOf, AnyOf):
        with pytest.raises(InvalidInputError):
            call()
    assert f.conjunction(None, None) is None


def test_value_tables(spark, typed):
    numbers = spark.createDataFrame([(12.0,), (12.5,)], "n double")
    assert ids(reads.field_in(typed, "v", numbers)) == ["float", "int"]
    assert ids(reads.field_not_in(typed, "v", numbers)) == [
        i for i in EXISTING if i not in ("float", "int")]
    texts = spark.createDataFrame([("12",), ("abc",), ("abc",)], "t string")
    assert ids(reads.field_in(typed, "v", texts)) == ["text", "word"]
    with_null = spark.createDataFrame([("12",), (None,)], "t string")
    assert ids(reads.field_in(typed, "v", with_null)) == ["text"]
    assert ids(reads.field_not_in(typed, "v", with_null)) == []
    none = texts.limit(0)
    assert ids(reads.field_in(typed, "v", none)) == []
    assert ids(reads.field_not_in(typed, "v", none)) == EXISTING


DOCS = [("1", "Hello, world"), ("2", "say HELLO"), ("3", "othello"), ("4", "b2b wörld"), ("5", ""), ("6", None)]


@pytest.mark.parametrize("doc,expected", [
    (Contains("hello"), ["1", "2"]),
    (Contains("WÖRLD nothing"), ["4"]),
    (Contains("b2b hello!"), ["1", "2", "4"]),
    (Contains("?!"), []),
    (Contains(""), []),
    (Regex("hell"), ["3"]),
    (Regex("^hell", ignore_case=True), ["1"]),
    (AnyOf(Regex("^b"), Regex("d$")), ["1", "4"]),
    (AllOf(Contains("hello"), Regex("[A-Z]{5}")), ["2"]),
    (AnyOf(AllOf(Contains("hello"), Regex("^s")), Regex("^o")), ["2", "3"]),
])
def test_document_filters(spark, doc, expected):
    frame = spark.createDataFrame(DOCS, "_id string, document string")
    assert ids(frame.where(doc.column())) == expected
    kept = frame.where(~F.coalesce(doc.column(), F.lit(False)))
    assert len(ids(kept)) == len(DOCS) - len(expected)


@settings(max_examples=60, deadline=None)
@given(st.text(st.characters(blacklist_characters="\"'.[]", blacklist_categories=("Cs", "Cc")), min_size=1, max_size=8))
def test_any_plain_key_makes_a_path(key):
    assert f.variant_path(key).startswith("$")
