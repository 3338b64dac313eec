import math
import re
from collections import Counter

import pytest
from conftest import ids, ranked_ids
from pyspark.sql import functions as F

from docweave.errors import EmbeddingError, InvalidInputError
from docweave.functions import filters as f
from docweave.functions.embedding import BatchEmbedding
from docweave.functions.text import AllOf, AnyOf, Contains, Regex
from docweave.operators import fulltext, hybrid, reads
from docweave.plans import sizing
from docweave.sources.storage import stored

TEXTS = {
    "hf1": "machine learning with rust", "hf2": "python data science", "hf3": "machine learning basics",
    "hf4": "rust rust rust", "hf5": "", "hf6": None, "hf7": "Machine: machine, 2 machines!",
}


@pytest.fixture
def base(rows):
    scores = {"hf1": 95, "hf2": 80, "hf3": 90}
    places = {"hf1": [1, 2, 3], "hf2": [0, 0, 1], "hf3": [1.1, 2.1, 3.1]}
    return rows(*[(i, t, places.get(i), '{"category": "AI", "score": %d}' % scores[i] if i in scores else None)
                  for i, t in TEXTS.items()])


def bm25_by_hand(query, where=lambda i: True):
    words = {i: re.findall(r"\w+", t.lower()) for i, t in TEXTS.items() if t is not None}
    mean = sum(map(len, words.values())) / len(words)
    out = {}
    for i, listed in words.items():
        score = 0.0
        for w in set(re.findall(r"\w+", query.lower())):
            df = sum(w in other for other in words.values())
            tf = Counter(listed)[w]
            idf = math.log(1 + (len(words) - df + 0.5) / (df + 0.5))
            score += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(listed) / mean))
        if score > 0 and where(i):
            out[i] = score
    return out


def test_term_index(base):
    index = fulltext.term_index(base)
    counted = {(r["token"], r["_id"]): r["tf"] for r in fulltext.postings(index).collect()}
    want = {}
    for i, text in TEXTS.items():
        for w, n in Counter(re.findall(r"\w+", (text or "").lower())).items():
            want[(w, i)] = n
    assert counted == want
    assert {r["_id"]: r["doc_len"] for r in index.collect()}["hf5"] == 0


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("saved", [True, False])
def test_bm25(base, spark, small, saved, monkeypatch):
    if not small:
        monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 3)
    index = fulltext.term_index(base)
    index = stored(index, "index") if saved else index
    texts = ["machine rust", "RUST, rust", "nothing here", "data science of machines"]
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id int, text string")
    hits = fulltext.bm25(index, queries, 3).collect()
    for n, text in enumerate(texts):
        want = sorted(bm25_by_hand(text).items(), key=lambda x: (-x[1], x[0]))[:3]
        got = sorted((r for r in hits if r["query_id"] == n), key=lambda r: r["rank"])
        assert [r["_id"] for r in got] == [i for i, _ in want]
        assert [r["score"] for r in got] == pytest.approx([s for _, s in want])
        alone = fulltext.bm25_one(index, text, 3).orderBy("rank").collect()
        assert [(r["_id"], r["score"]) for r in alone] == [(r["_id"], r["score"]) for r in got]


def test_bm25_filter_keeps_collection_statistics(base, spark):
    got = fulltext.bm25_one(fulltext.term_index(base), "machine", 5, f.gte("score", 95)).collect()
    assert {r["_id"]: r["score"] for r in got} == pytest.approx(
        bm25_by_hand("machine", lambda i: i == "hf1"))


def branch(base, where, doc, k=10):
    return ranked_ids(hybrid.text_branch(base, hybrid.TextBranch(where, doc), k))


def test_text_branch(base):
    assert branch(base, f.eq("category", "AI"), None) == ["hf1", "hf2", "hf3"]
    assert set(branch(base, f.eq("category", "AI"), Contains("machine"))) == {"hf1", "hf3"}
    any_word = branch(base, None, AllOf(Contains("machine"), Contains("python")))
    assert set(any_word) == {"hf1", "hf2", "hf3", "hf7"}  # texts are joined, any word matches
    assert branch(base, None, AllOf(Contains("machine"), Regex("rust$"))) == ["hf1"]
    assert branch(base, None, Regex("rust$")) == ["hf1", "hf4"]
    assert branch(base, f.gt("score", 90), Regex("a")) == ["hf1"]
    either = branch(base, None, AnyOf(Contains("python"), Regex("^rust")))
    assert either == ["hf2", "hf4"]  # matched words first, the rest after them
    assert branch(base, None, AnyOf(Contains("python"), AllOf(Contains("machine"), Regex("basics")))) == [
        "hf2", "hf3"]
    with pytest.raises(InvalidInputError):
        branch(base, None, None)


def test_advanced_with_filters_on_both_branches(base, vectors):
    text = hybrid.TextBranch(f.eq("category", "AI"), Contains("machine"))
    knn = hybrid.KnnBranch(vectors([1, 2, 3]), f.gte("score", 90))
    hits = hybrid.hybrid_search_advanced(base, text, knn, hybrid.Rrf(60, 60), 5).orderBy("rank").collect()
    assert {r["_id"] for r in hits} == {"hf1", "hf3"}
    order = ranked_ids(hybrid.text_branch(base, text, 60))
    near = ["hf1", "hf3"]
    for r in hits:
        want = 1 / (61 + order.index(r["_id"])) + 1 / (61 + near.index(r["_id"]))
        assert r["fused_score"] == pytest.approx(want)
        assert r["document"] == TEXTS[r["_id"]] and r["score"] > 0 and r["distance"] is not None


def test_fusion_window_and_missing_sides(spark):
    def ranking(name, *listed):
        return spark.createDataFrame([(0, n + 1, i, 1.0) for n, i in enumerate(listed)],
                                     f"query_id int, rank long, _id string, {name} double")

    fused = hybrid.fuse(ranking("score", "a", "b", "c"), ranking("distance", "b", "d", "a"), 10, 2, 10)
    got = {r["_id"]: r["fused_score"] for r in fused.collect()}
    assert got == pytest.approx({"a": 1 / 11, "b": 1 / 12 + 1 / 11, "d": 1 / 12})
    assert ranked_ids(fused) == ["b", "a", "d"]


def test_knn_only_uses_the_limit_of_the_call(base, vectors):
    knn = hybrid.KnnBranch(vectors([1, 2, 3], [0, 0, 1]), n_results=1)
    hits = hybrid.hybrid_search_advanced(base, knn=knn, n_results=2)
    assert hits.count() == 4


def test_simple(base, spark):
    embedder = BatchEmbedding.of(lambda texts: [[1.0, 2.0, 3.0]] * len(texts), 3)
    queries = spark.createDataFrame([(0, "rust")], "query_id int, text string")
    plain = hybrid.hybrid_search(base, queries, n_results=2, embedder=embedder)
    assert ranked_ids(plain) == ["hf1", "hf3"]
    # The metadata predicate holds for both branches, the document filter for the text branch.
    both = hybrid.hybrid_search(base, queries, f.gte("score", 80), Contains("python"), 3, embedder=embedder)
    assert ids(both) == ["hf1", "hf2", "hf3"]
    assert ids(hybrid.hybrid_search(base, None, None, Contains("python"))) == ["hf2"]
    with pytest.raises(InvalidInputError):
        hybrid.hybrid_search(base)
    with pytest.raises(EmbeddingError):
        hybrid.hybrid_search(base, queries)


def test_filtered_mode(base, vectors):
    text = hybrid.TextBranch(f.gte("score", 80), Contains("machine"))
    knn = hybrid.KnnBranch(vectors([0, 0, 1]), f.lt("score", 95))
    assert ids(hybrid.hybrid_filtered(base, text, knn)) == ["hf3"]
    alone = hybrid.hybrid_filtered(base, text).collect()
    assert [(r["_id"], r["distance"]) for r in alone] == [("hf1", 0.0), ("hf3", 0.0)]
    with pytest.raises(InvalidInputError):
        hybrid.hybrid_filtered(base)


def test_distances_of_hits(spark):
    hits = spark.createDataFrame([("a", None, 2.0), ("b", 1.0, 3.0), ("c", None, None)],
                                 "_id string, distance double, score double")
    got = {r["_id"]: r["distances"] for r in hybrid.with_distances(hits).collect()}
    assert got == {"a": 2.0, "b": 1.0, "c": 0.0}


def test_pages(spark, monkeypatch):
    names = [f"{i:04d}" for i in range(300)]
    frame = spark.createDataFrame([(n, "d", None, None) for n in names],
                                  "_id string, document string, embedding array<float>, metadata string")
    frame = frame.withColumn("metadata", F.parse_json("metadata")).repartition(5)

    def page(limit=None, offset=None):
        return [r["_id"] for r in reads.get(frame, limit=limit, offset=offset).collect()]

    for threshold in (10**6, 20):  # past the threshold the first id of a page is searched for
        monkeypatch.setattr(reads, "DIRECT_PAGE", threshold)
        assert page(5) == names[:5]
        assert page(5, 290) == names[290:295]
        assert page(None, 297) == names[297:]
        assert page(50, 100) == names[100:150]
        assert page(3, 300) == page(3, 5000) == page(None, 300) == []
        assert page(0) == []
    with pytest.raises(InvalidInputError):
        page(-1)
    assert ids(reads.get(frame, ids=[])) == []
    assert ids(reads.get(frame, ids=["0003", "x"])) == ["0003"]
    assert ids(reads.get(frame, ids=names + ["x"] * 2000)) == names
    assert reads.count(frame).first()["count"] == 300
    assert [r["_id"] for r in reads.peek(frame, 2).collect()] == names[:2]
