import math
import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import ids, ranked_ids
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from docweave.errors import EmbeddingError, InvalidInputError
from docweave.functions import filters as f
from docweave.functions.blocks import BestHits, pair_distances
from docweave.functions.distance import distance
from docweave.functions.embedding import BatchEmbedding
from docweave.functions.text import Contains, Regex
from docweave.operators import cells, nearest, reads
from docweave.plans import ranking, sizing
from docweave.sources.storage import stored


@pytest.fixture
def three(rows):
    return rows(("qa1", "rust integration test", [0, 0, 0], '{"score": 10, "tag": "x"}'),
                ("qa2", "other document", [1, 0, 0], '{"score": 20, "tag": "y"}'),
                ("qa3", "rust and databases", [0, 1, 0], '{"score": 30, "tag": "x"}'),
                ("qa4", "no vector", None, '{"score": 40, "tag": "x"}'))


def test_distances_filters_and_ties(three, vectors):
    q = vectors([0, 0, 0])
    assert ranked_ids(nearest.nearest(three, q, 2, "l2")) == ["qa1", "qa2"]  # qa2, qa3 tie
    assert ranked_ids(nearest.nearest(three, q, 9, "l2")) == ["qa1", "qa2", "qa3"]
    assert ranked_ids(nearest.nearest(three, q, 2, "l2", where=f.gt("score", 15))) == ["qa2", "qa3"]
    assert ranked_ids(nearest.nearest(three, q, 2, "l2", where=f.is_in("tag", ["x"]))) == ["qa1", "qa3"]
    assert ranked_ids(nearest.nearest(three, q, 2, "l2", where_document=Contains("rust"))) == ["qa1", "qa3"]
    assert ranked_ids(nearest.nearest(three, q, 1, "l2", where_document=Regex("rust"))) == ["qa1"]
    assert ranked_ids(nearest.nearest(three, q, 2, "cosine")) == []  # no angle to a zero vector
    up = vectors([1, 0, 0])
    assert ranked_ids(nearest.nearest(three, up, 2, "ip")) == ["qa1", "qa3"]
    assert ranked_ids(nearest.nearest(three, up, 1, "negative_inner_product")) == ["qa2"]


def test_included_columns(three, vectors):
    q = vectors([0, 0, 0])
    def columns(include):
        return nearest.nearest(three, q, 1, "l2", include=include).columns

    assert columns(None) == ["query_id", "rank", "_id", "document", "metadata", "distance"]
    assert columns([]) == ["query_id", "rank", "_id", "distance"]
    assert columns(["embeddings"]) == ["query_id", "rank", "_id", "embedding", "distance"]
    with pytest.raises(InvalidInputError):
        columns(["distances"])


def test_bad_queries(three, vectors, spark):
    for queries, k in ((vectors([0, 0, 0]).limit(0), 1), (vectors([0, 0]), 1), (vectors([0, 0, 0]), 0)):
        with pytest.raises(InvalidInputError):
            nearest.nearest(three, queries, k, "l2", dimension=3)
    no_vector = spark.createDataFrame([(1, None)], "query_id int, embedding array<float>")
    with pytest.raises(InvalidInputError):
        nearest.nearest(three, no_vector, 1, "l2", dimension=3)


def test_texts(rows, spark):
    embedder = BatchEmbedding.of(lambda texts: [[0.2, 0.2, 0.2]] * len(texts), 3)
    base = rows(("qt1", "hello rust", [0.2, 0.2, 0.2], None), ("qt2", "hello", [0.2, 0.2, 0.2], None))
    queries = spark.createDataFrame([(0, "hello rust")], "query_id int, text string")
    assert ranked_ids(nearest.nearest_texts(base, queries, 2, embedder, distance="cosine")) == ["qt1", "qt2"]
    with pytest.raises(EmbeddingError):
        nearest.nearest_texts(base, queries, 2, None, distance="cosine")


def test_nested_keeps_queries_without_hits(three, vectors):
    q = vectors([0, 0, 0], [1, 1, 1])
    hits = nearest.nearest(three, q, 2, "l2", where=f.eq("tag", "y"))
    got = {r["query_id"]: [h["_id"] for h in r["hits"]] for r in nearest.nested(hits, q).collect()}
    assert got == {0: ["qa2"], 1: ["qa2"]}
    none = nearest.nested(nearest.nearest(three, q, 2, "l2", where=f.eq("tag", "z")), q)
    assert {r["query_id"]: r["hits"] for r in none.collect()} == {0: [], 1: []}


def brute(base, queries, k, metric):
    found = {}
    for qid, q in queries:
        q = np.array([q], dtype=np.float64)
        scored = []
        for rid, v in base:
            d = pair_distances(np.array([v], dtype=np.float64), q, metric)[0]
            if not math.isnan(d):
                scored.append((d, rid))
        found[qid] = [rid for _, rid in sorted(scored)[:k]]
    return found


def points(n, seed, copies=0.34, dimension=5):
    """Random vectors on a coarse grid; a third of all rows are copies of one."""
    rng = random.Random(seed)
    one = [rng.randint(-2, 2) / 2 for _ in range(dimension)]
    return [(f"r{i}", one if rng.random() < copies else
             [float(np.float32(rng.randint(-20, 20) / 10)) for _ in range(dimension)]) for i in range(n)]


@pytest.mark.parametrize("metric", nearest.METRICS)
@pytest.mark.parametrize("blocks", [False, True])
def test_both_plans_equal_brute_force(spark, metric, blocks, monkeypatch):
    base, queries = points(400, 1), points(30, 2)
    if blocks:  # neither side fits: hash blocks of a few rows
        monkeypatch.setattr(sizing, "MAX_BROADCAST_BYTES", 0)
        monkeypatch.setattr(sizing, "BLOCK_BYTES", 5 * 8 * 50)
    rows = spark.createDataFrame(base, "_id string, embedding array<float>").repartition(3)
    asked = spark.createDataFrame(queries, "query_id string, embedding array<float>")
    hits = nearest.nearest(rows, asked, 7, metric, include=[]).orderBy("query_id", "rank").collect()
    got = {}
    for h in hits:
        got.setdefault(h["query_id"], []).append(h["_id"])
    assert got == {q: r for q, r in brute(base, queries, 7, metric).items() if r}


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 9), st.sampled_from(nearest.METRICS), st.integers(1, 50))
def test_kernel_in_any_batches(seed, k, metric, batch):
    base, queries = points(120, seed), points(6, seed + 1)
    best = BestHits(np.array([q for _, q in queries]), k, metric)
    for start in range(0, len(base), batch):
        part = base[start:start + batch]
        best.add(pa.array([i for i, _ in part]), np.array([v for _, v in part]))
    got = {}
    for row in best.result().to_pylist():
        got.setdefault(queries[row["q"]][0], []).append(row["_id"])
    assert got == {q: r for q, r in brute(base, queries, k, metric).items() if r}


def test_kernel_agrees_with_column_distances(spark):
    base = points(50, 3, copies=0)
    rows = spark.createDataFrame([(i, v, base[0][1]) for i, v in base],
                                 "_id string, a array<float>, b array<float>")
    for metric in ("l2", "cosine", "inner_product"):
        columns = {r["_id"]: r["d"] for r in rows.select("_id", distance(metric, "a", "b").alias("d")).collect()}
        for i, v in base:
            exact = pair_distances(np.array([v]), np.array([base[0][1]]), metric)[0]
            assert columns[i] == pytest.approx(exact, abs=1e-9)


def test_cells(spark, monkeypatch):
    base, queries = points(600, 4), points(40, 5, copies=0.1)
    rows = spark.createDataFrame(base, "_id string, embedding array<float>").withColumn(
        "document", F.lit("d")).withColumn("metadata", F.parse_json(F.lit("{}")))
    asked = spark.createDataFrame(queries, "query_id string, embedding array<float>")
    model = cells.train_cells(rows, 6, "l2")
    location = stored(cells.assign_cells(rows, model), "cells").inputFiles()[0].rsplit("/", 1)[0] + "_by_cell"
    cells.write_cells(cells.assign_cells(rows, model), location)
    indexed = spark.read.parquet(location)

    def search(probes):
        hits = cells.nearest_in_cells(indexed, model, asked, 5, probes, "l2", include=[])
        return {(r["query_id"], r["rank"], r["_id"]) for r in hits.collect()}

    exact = {(r["query_id"], r["rank"], r["_id"])
             for r in nearest.nearest(rows, asked, 5, "l2", include=[]).collect()}
    assert search(6) == exact
    few = search(2)
    assert len({(q, i) for q, _, i in few} & {(q, i) for q, _, i in exact}) / len(exact) > 0.6
    # The same cells searched block by block, with a third of the rows in one cell.
    monkeypatch.setattr(sizing, "MAX_BROADCAST_BYTES", 0)
    monkeypatch.setattr(sizing, "BLOCK_BYTES", 5 * 8 * 40)
    assert search(6) == exact
    assert search(2) == few


def test_probed_cells_prune_directories(spark):
    rows = spark.createDataFrame(points(100, 6), "_id string, embedding array<float>")
    model = cells.train_cells(rows, 4, "cosine")
    root = stored(rows, "prune").inputFiles()[0].rsplit("/", 1)[0] + "_by_cell"
    cells.write_cells(cells.assign_cells(rows, model), root)
    one = spark.createDataFrame([points(1, 7)[0]], "query_id string, embedding array<float>")
    hits = cells.nearest_in_cells(spark.read.parquet(root), model, one, 3, 1, "cosine", include=[])
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


@pytest.mark.parametrize("k", [5, 40])
def test_top_k_beyond_the_group_limit(spark, k, monkeypatch):
    monkeypatch.setattr(ranking, "GROUP_LIMIT_THRESHOLD", 10)
    data = [("hot" if i % 3 else "cold", f"r{i:03d}", i * 7 % 101) for i in range(200)]
    frame = spark.createDataFrame(data, "g string, _id string, s int").repartition(6)
    got = ranking.top_k(frame, "g", [F.col("s"), F.col("_id")], k).collect()
    for g in ("hot", "cold"):
        want = [i for s, i in sorted((s, i) for h, i, s in data if h == g)][:k]
        assert [r["_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["g"] == g] == want


def test_plan_of_a_search(three, vectors):
    """One scan of two columns goes to the kernel, and only its hits are shuffled."""
    base = stored(three, "plan")
    hits = nearest.nearest(base, vectors([0, 0, 0]), 2, "l2", where=f.gt("score", 5), include=[])
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "WindowGroupLimit" in plan
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    scan = plan[plan.index("ReadSchema"):]
    assert "document" not in scan.split("\n")[0]
    assert ids(hits) == ["qa1", "qa2"]


@pytest.mark.parametrize("metric", nearest.METRICS)
def test_a_large_k_over_blocks(spark, monkeypatch, metric):
    """k above a block's rows: the same hits as over all rows, without every pair being given back."""
    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(f"r{i:04d}", [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(1500, 3)))]
                                 + [(f"s{i:03d}", [0.5, 0.5, 0.5]) for i in range(300)] + [("none", None)],
                                 "_id string, embedding array<float>")
    queries = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(30, 3)))],
                                    "query_id int, embedding array<float>")
    k = 60
    expected = nearest.nearest(rows, queries, k, metric, include=[]).collect()
    monkeypatch.setattr(nearest.sizing, "MAX_BROADCAST_BYTES", 1)
    monkeypatch.setattr(nearest.sizing, "BLOCK_BYTES", 50 * 3 * 8)
    emitted, blocks = [], nearest._with_blocks

    def counted(*given):
        hits = blocks(*given)
        emitted.append(hits.count())
        return hits

    monkeypatch.setattr(nearest, "_with_blocks", counted)
    found = nearest.nearest(rows, queries, k, metric, include=[]).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, expected)) and len(found) == 30 * k
    assert len(emitted) > 2 and sum(emitted) < 30 * 1800 * 0.75


@pytest.mark.parametrize("kind", ["numbers", "prefixed", "odd"])
def test_pages_by_a_sketch(spark, kind):
    """Both ends of any page, among ids with long common beginnings, NUL bytes and repeats."""
    rng = random.Random(5)
    listed = {"numbers": [str(i * 7) for i in range(3000)],
              "prefixed": [f"collection/part-{i % 3:05d}/document-{i:09d}" for i in range(3000)],
              "odd": ["", "\0", "\0\0", "ä", "äa", "\U0001f600", "z" * 300] + ["same"] * 900 + ["same\0"] * 300
              + ["".join(rng.choice("ab\0") for _ in range(rng.randrange(12))) for _ in range(1500)]}[kind]
    held = spark.createDataFrame([(i,) for i in listed], "_id string")
    expected = sorted(listed, key=str.encode)
    ranks = [0, 1, 7, 450, 1200, 1201, len(listed) - 1, len(listed), 10**6]
    assert reads.nth_ids(held, ranks, 20) == [expected[n] if n < len(expected) else None for n in ranks]
    if kind != "odd":
        for limit, offset in ((30, 1500), (5000, 2990), (10, 3000), (None, 2995)):
            page = reads.page(held, limit, offset, 100)
            assert [r[0] for r in page.collect()] == expected[offset:][:limit]
            assert "TakeOrdered" not in page._jdf.queryExecution().executedPlan().toString()
