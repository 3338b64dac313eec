import pytest
from pyspark.sql import functions as F

from docweave.functions import codecs


def one(spark, value, kind, function):
    return spark.createDataFrame([(value,)], f"x {kind}").select(function("x").alias("y")).first()["y"]


@pytest.mark.parametrize("vector,text", [
    ([1.0, 2.5, 3.0], "[1,2.5,3]"),
    ([0.0, -0.25], "[0,-0.25]"),
    ([1e-7, -1.5e-6], "[0.0000001,-0.0000015]"),
    ([16777216.0, 1e10, -1e20], "[16777216,10000000000,-100000000000000000000]"),
    ([], "[]"),
])
def test_vector_text(spark, vector, text):
    assert one(spark, vector, "array<float>", codecs.vector_to_text) == text
    assert one(spark, text, "string", codecs.text_to_vector) == pytest.approx(vector)


def test_special_floats(spark):
    text = one(spark, [float("inf"), float("-inf"), float("nan")], "array<float>", codecs.vector_to_text)
    assert text == "[inf,-inf,NaN]"


def test_bad_elements_are_dropped(spark):
    assert one(spark, "[1, x, 2f, ,+3 ,1e2,0x1]", "string", codecs.text_to_vector) == [1, 3, 100]
    assert one(spark, "", "string", codecs.text_to_vector) == []
    assert one(spark, "1,2", "string", codecs.text_to_vector) == [1, 2]


def test_null_vector(spark):
    assert one(spark, None, "array<float>", codecs.vector_to_text) is None


def test_metadata_text(spark):
    def round_trip(x):
        return F.to_json(codecs.text_to_metadata(x))

    assert one(spark, '{"b": 1, "a": [true, null]}', "string", round_trip) == '{"a":[true,null],"b":1}'
    assert one(spark, "{broken", "string", round_trip) is None


@pytest.mark.parametrize("raw,text", [
    (b"abc", "abc"), ("né".encode(), "né"), (b"a\xffb", "a�b"), (b"\xe2\x82A", "�A")])
def test_id_bytes(spark, raw, text):
    assert one(spark, raw, "binary", codecs.bytes_to_id) == text
