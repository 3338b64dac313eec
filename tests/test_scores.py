"""The kernel of full-text search, and the plans that use it."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docweave.functions import blocks, scores
from docweave.operators import blockwords, fulltext
from docweave.plans import sizing
from docweave.sources.storage import stored


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def texts(n, seed):
    rng = random.Random(seed)
    return [(f"r{i:04d}", " ".join(f"w{min(rng.randrange(60), rng.randrange(60))}" for _ in range(rng.randrange(12))))
            for i in range(n)]


def held(spark, n=400):
    return spark.createDataFrame([*texts(n, 1), ("none", None)], "_id string, document string")


def asked(spark):
    """Longer texts, one query id that comes twice and one without a known word."""
    return spark.createDataFrame([(0, "w0 w1 w2 w3 w59"), (1, "w58"), (1, "w58 w57"), (2, "unknown")],
                                 "query_id int, text string")


def found(hits):
    return sorted((r.query_id, r["rank"], r["_id"], r.score) for r in hits.collect())


def test_words_of_a_block_become_rows_only_once_counted(spark):
    """Before, each word of each row was shuffled and its counts gathered by an aggregate."""
    plan = plan_of(blockwords.entries(held(spark), 8))
    assert "MapInArrow" in plan and "Aggregate" not in plan and plan.count("Exchange") == 1


def test_index_rows_equal_a_plain_count(spark):
    rows = [*texts(300, 3), ("none", None), ("empty", "")]
    frame = spark.createDataFrame([(*r, 1) for r in rows] + [("r0001", "w1 old", -1)],
                                  "_id string, document string, sign int")
    want = {}
    for i, text, sign in [(*r, 1) for r in rows] + [("r0001", "w1 old", -1)]:
        words = (text or "").split()
        for word in set(words):
            want.setdefault(word, []).append((i, words.count(word), len(words), sign))
    got, heads = {}, []
    for r in blockwords.entries(frame, 7).collect():
        got.setdefault(r.token, []).extend(tuple(e) for e in r.entries)
        heads.append((r.n, r.max_tf, r.min_len) == (
            sum(e.sign for e in r.entries), max(e.tf for e in r.entries), min(e.len for e in r.entries)))
    assert {w: sorted(e) for w, e in got.items()} == {w: sorted(e) for w, e in want.items()} and all(heads)
    counted = blockwords.counted(frame)
    assert blockwords.totals(counted) == blockwords.totals(frame)
    assert blockwords.totals(frame) == blockwords.Totals(300, sum(len((t or "").split()) for _, t in rows) - 2)


@pytest.mark.parametrize("allowed", [False, True])
def test_block_search_by_kernel_equals_joins(spark, allowed, monkeypatch):
    rows = held(spark)
    index = blockwords.BlockIndex(stored(blockwords.entries(rows, 9), "entries"), blockwords.totals(rows),
                                  blockwords.FOLDERS, blocks=9)
    ids = rows.where("_id like '%3%'").select("_id") if allowed else None
    hits = blockwords.bm25(index, asked(spark), 4, ids, first=2)
    assert "MapInArrow" in plan_of(hits)  # no (query, row, word) rows
    by_kernel = found(hits)
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 0)
    assert by_kernel == found(blockwords.bm25(index, asked(spark), 4, ids, first=2)) != []


def test_search_by_kernel_equals_joins(spark, monkeypatch):
    """Repeated and missing ids of rows and repeated ids of queries count as in joins."""
    rows = held(spark).union(held(spark, 20)).union(spark.createDataFrame(
        [(None, "w0 w58"), (None, "w1 w2")], "_id string, document string"))
    index = stored(fulltext.term_index(rows), "index")
    monkeypatch.setattr(fulltext, "ROWS_AT_ONCE", 50)
    hits = fulltext.bm25(index, asked(spark), 6)
    assert "MapInArrow" in plan_of(hits)  # no (query, row) sums beyond the rows a task is at
    key = lambda hit: (hit[0], hit[1])
    by_kernel = sorted(((r.query_id, r["rank"], r["_id"], r.score) for r in hits.collect()), key=key)
    monkeypatch.setattr(sizing, "MAX_TASK_HITS", 0)
    hits = fulltext.bm25(index, asked(spark), 6)
    assert by_kernel == sorted(((r.query_id, r["rank"], r["_id"], r.score) for r in hits.collect()), key=key)
    assert any(h[2] is None for h in by_kernel)


@pytest.mark.parametrize("least", [1, 3, 100])
def test_groups_never_cut_a_value(least):
    values = [None, None, "", "a", "a", "a", "b", "c", "c"]
    batches = [pa.record_batch({"v": pa.array(values[i:i + 2], pa.string())}) for i in range(0, 9, 2)]
    parts = [p["v"].to_pylist() for p in scores.groups(batches, "v", least)]
    assert sum(parts, []) == values
    assert all(a[-1] != b[0] for a, b in zip(parts, parts[1:]))


def test_products_of_many_queries_stay_bounded(monkeypatch):
    """Rows and queries are both cut, so a product is bounded however many queries there are."""
    sizes, plain = [], blocks._approximate
    monkeypatch.setattr(blocks, "_approximate", lambda x, q, m: sizes.append((len(x), len(q))) or plain(x, q, m))
    rng = np.random.default_rng(5)
    base, queries = rng.normal(size=(600, 4)), rng.normal(size=(20_000, 4))
    best = blocks.BestHits(queries, 3, "l2")
    best.add(pa.array([f"r{i:03d}" for i in range(600)]), base)
    assert all(r * q <= 1_000_000 for r, q in sizes) and max(r for r, _ in sizes) == 600
    hits = best.result()
    want = np.argsort(((queries[:50, None] - base) ** 2).sum(axis=2), axis=1)[:, :3]
    assert hits["_id"].to_pylist()[:150] == [f"r{i:03d}" for i in want.ravel()]
