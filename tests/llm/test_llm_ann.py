"""Nearest vectors by graphs against brute force: recall, ties, copies, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import ann, hnsw

SCHEMA = "vec_id long, embedding array<float>, shard int, dim string"


def brute(rows, queries, k=20):
    """{(query, rank): (vec_id, score)} over whole tables."""
    out = {}
    for q, x in queries:
        scored = sorted((-float(np.dot(np.float64(x), np.float64(v))), i) for i, v in rows if i != q and len(v) == len(x))
        out |= {(q, r): (i, -s) for r, (s, i) in enumerate(scored[:k], 1)}
    return out


def nearest(spark, rows, k=20, shard_rows=ann.SHARD_ROWS, every=20):
    frame = spark.createDataFrame([(i, v and [None if x is None else float(x) for x in v], 5, "x") for i, v in rows], SCHEMA)
    usable = ann.usable(frame)
    found = ann.search(ann.build_index(usable, k, shard_rows), usable.where(F.col("vec_id") % every == 0), k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in found.collect()}


def points(n, dim=16, seed=0, clusters=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    if clusters:
        x = x * 0.05 + rng.normal(size=(clusters, dim))[rng.integers(0, clusters, n)]
    return x.astype(np.float32)


@pytest.mark.parametrize("clusters", [0, 7])
def test_recall_of_a_graph(clusters):
    x = np.float64(points(4000, 48, 1, clusters))
    rng = np.random.default_rng(3)
    layers = hnsw.build(hnsw.on_sphere(x), np.sort(hnsw.levels_of(1 - rng.random(len(x))))[::-1])
    assert hnsw.reached(layers[0]).all() and len(layers) > 1
    assert all((layer < len(layer)).all() for layer in layers)
    queries = x[rng.permutation(len(x))[:200]]
    found = hnsw.search(hnsw.on_sphere(x), layers, hnsw.as_queries(queries), ann.WIDTH)
    scores = queries @ x.T
    true = np.argsort(-scores, axis=1)[:, :20]
    best = [set(sorted(f[f >= 0], key=lambda i: -scores[q, i])[:20]) for q, f in enumerate(found)]
    assert np.mean([len(b & set(t)) / 20 for b, t in zip(best, true)]) > 0.95


def test_recall_over_shards(spark):
    x = points(3000, 32, 5) * np.random.default_rng(6).uniform(0.2, 3, (3000, 1)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = nearest(spark, rows, shard_rows=500)
    expected = brute(rows, rows[::20])
    assert found.keys() == expected.keys()
    pairs = {(q, i) for (q, _), (i, _) in found.items()}
    true = {(q, i) for (q, _), (i, _) in expected.items()}
    assert len(pairs & true) > 0.95 * len(true)
    for (q, _), (i, score) in found.items():
        assert abs(score - float(np.float64(x[q]) @ np.float64(x[i]))) < 1e-9


def test_small_tables_are_exact_with_copies_and_ties(spark):
    rng = np.random.default_rng(8)
    x = rng.integers(-2, 3, size=(80, 3))
    rows = [(i - 20, [int(c) for c in v]) for i, v in enumerate(x) if v.any()]
    rows += [(200 + i, [1, 1, 1]) for i in range(60)]  # one vector on a large share of the rows
    found, expected = nearest(spark, rows, k=5), brute(rows, [r for r in rows if r[0] % 20 == 0], 5)
    assert found == expected and len(expected) > 20


def test_odd_rows(spark):
    rows = [(0, [1, 0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [0, 0]), (5, [None, 1]), (6, [float("nan"), 1]),
            (7, [float("inf"), 1]), (None, [1, 1]), (20, [1, 2, 3]), (40, [1, 2, 3]), (60, [5]), (8, [9, 9]), (8, [-1, 0])]
    usable = [(0, [1, 0]), (1, [0.5, 0.5]), (8, [-1, 0]), (20, [1, 2, 3]), (40, [1, 2, 3]), (60, [5])]
    assert nearest(spark, rows) == brute(usable, [r for r in usable if r[0] % 20 == 0])
    assert nearest(spark, []) == {} and nearest(spark, [(2, None), (4, [0, 0])]) == {}
    assert nearest(spark, [(0, [1, 0])]) == {}
