"""Codes inside cells: exact with a full shortlist, near that with a short one, small in bytes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.errors import InvalidInputError
from docweave.operators import cells, codes, nearest

DIMENSION, PARTS = 16, 4


@pytest.fixture(scope="module")
def held(spark):
    rng = np.random.default_rng(8)
    middle = rng.normal(size=(5, DIMENSION))
    vectors = (middle[rng.integers(0, 5, 700)] + 0.4 * rng.normal(size=(700, DIMENSION))).astype(np.float32)
    vectors[400:600] = vectors[0]  # more than a quarter are copies
    base = [(f"r{i:04}", v.tolist(), "d", "{}") for i, v in enumerate(vectors)] + [("none", None, "d", "{}")]
    rows = spark.createDataFrame(base, "_id string, embedding array<float>, document string, m string").select(
        "_id", "document", "embedding", F.parse_json("m").alias("metadata"))
    asked = spark.createDataFrame([(f"q{i}", (v + 0.2 * rng.normal(size=DIMENSION)).tolist())
                                   for i, v in enumerate(vectors[:30])], "query_id string, embedding array<float>")
    return rows, asked


@pytest.mark.parametrize("distance", ["l2", "cosine", "inner_product"])
def test_codes_shortlist(held, distance):
    rows, asked = held
    model = cells.train_cells(rows, 5, distance)
    indexed = cells.assign_cells(rows, model).where("embedding IS NOT NULL")
    books = codes.train_codebooks(indexed, model, PARTS, 32)
    coded = codes.encode(indexed, books).cache()
    assert coded.count() == 700 and {len(r.code) for r in coded.collect()} == {PARTS}

    def ids(hits):
        return {(r["query_id"], r["rank"], r["_id"]) for r in hits.collect()}

    def by_codes(probes, shortlist, **more):
        return ids(codes.nearest_by_codes(rows, coded, books, asked, 10, probes, shortlist, distance, include=[], **more))

    exact = ids(nearest.nearest(rows, asked, 10, distance, include=[]))
    assert by_codes(5, 700) == exact
    probed = ids(cells.nearest_in_cells(indexed, model, asked, 10, 2, distance, include=[]))
    assert by_codes(2, 700) == probed
    # copies share a code, so a shortlist that they fill is longer than they are many
    short = by_codes(5, 300)
    assert len({(q, i) for q, _, i in short} & {(q, i) for q, _, i in exact}) / len(exact) > 0.9
    assert by_codes(5, 700, where=F.col("_id") < "r0100") == ids(
        nearest.nearest(rows.where(F.col("_id") < "r0100"), asked, 10, distance, include=[]))


def test_codes_lie_nearer_than_centres(held):
    rows, _ = held
    model = cells.train_cells(rows, 5, "l2")
    indexed = cells.assign_cells(rows, model).where("embedding IS NOT NULL")
    books = codes.train_codebooks(indexed, model, PARTS, 32)
    both = codes.decoded(codes.encode(indexed, books), books).withColumnRenamed("embedding", "near").join(indexed, "_id")
    true, near = (np.array(x) for x in zip(*both.select("embedding", "near").collect()))
    points = cells.centres_of(model).points
    to_centre = np.min(np.linalg.norm(true[:, None] - points[None], axis=2), axis=1)
    assert np.mean(np.linalg.norm(true - near, axis=1)) < 0.6 * np.mean(to_centre)


def test_codes_refuse_bad_settings(held):
    rows, asked = held
    model = cells.Centres(np.zeros((1, DIMENSION)), False)
    with pytest.raises(InvalidInputError):
        codes.train_codebooks(rows, model, DIMENSION + 1)
    with pytest.raises(InvalidInputError):
        codes.train_codebooks(rows, model, 2, 257)
    with pytest.raises(InvalidInputError):
        codes.nearest_by_codes(rows, rows, codes.Codebooks((), model), asked, 10, 1, 5)
