"""Stored collections: folders by id, versions, indexes that follow writes, removal."""

import math
import random
import re
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docweave import (
    ConfigError, ConflictError, Contains, InvalidInputError, KnnBranch, NotFoundError, Rrf, TextBranch, create_collection,
    drop_collection, open_collection,
)
from docweave.functions import filters as f
from docweave.functions.text import pair_tokens
from docweave.operators import blockwords, cells, fulltext, writes
from docweave.sources import storage, versions
from conftest import ids, ranked_ids


@pytest.fixture
def name():
    return f"s_{uuid.uuid4().hex[:10]}"


def sample(spark, n=200, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    return spark.createDataFrame(
        [(f"id{i}", None if i % 31 == 0 else " ".join(words[int(rng.random() ** 3 * 60)] for _ in range(rng.randrange(0, 30))),
          [rng.gauss(0, 1), rng.gauss(0, 1)], f'{{"n": {i}, "even": {str(i % 2 == 0).lower()}}}') for i in range(n)],
        "_id string, document string, embedding array<float>, metadata string").withColumn("metadata", F.parse_json("metadata"))


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def held(version):
    return {folder: tuple(paths) for folder, paths in version.rows.items()}


# Writes

def test_a_write_touches_only_the_folders_it_changes(spark, name):
    c = create_collection(spark, name, 2, "l2", sample(spark), folders=16)
    first = c.version()
    assert len(first.rows) == 16 and c.count() == 200
    c.delete(ids=["id7"])
    second = c.version()
    changed = {x for x in first.rows if held(first)[x] != held(second).get(x)}
    assert len(changed) == 1 and c.count() == 199 and c.rows(first.number).count() == 200
    c.delete(where=f.eq("n", 8))
    assert len({x for x in second.rows if held(second)[x] != held(c.version()).get(x)}) == 1
    third = c.version()
    c.update(spark.createDataFrame([("id9", '{"n": -1}'), ("nobody", "{}")], "_id string, metadata string"))
    assert len({x for x in third.rows if held(third)[x] != held(c.version()).get(x)}) == 1
    assert ids(c.get(where=f.lt("n", 0))) == ["id9"]
    fourth = c.version()
    c.upsert(spark.createDataFrame([("id10", "new text"), ("fresh", "other")], "_id string, document string"))
    kept = [x for x in fourth.rows if held(fourth)[x] == held(c.version())[x]]
    assert len(kept) >= 14 and c.count() == 199
    # the folder of the new id was not rewritten, only joined by a file
    assert sum(held(c.version())[x][:1] == held(fourth)[x][:1] for x in fourth.rows) >= 15
    fifth = c.version()
    c.update(spark.createDataFrame([("nobody", "{}")], "_id string, metadata string"))
    assert held(c.version()) == held(fifth)


def test_stored_writes_equal_the_operators(spark, name):
    rows, wide = sample(spark), lambda df: sorted(
        (r[0], r[1], r[2], r[3]) for r in df.select("_id", "document", "embedding", F.to_json("metadata")).collect())
    c = create_collection(spark, name, 2, "l2", rows, folders=8)
    changes = rows.where("_id LIKE '%3'").select(F.concat(F.col("_id"), F.when(F.col("_id") > "id5", "x").otherwise(F.lit(""))).alias("_id"),
                                                 F.lit("changed").alias("document"))
    c.upsert(changes)
    expected = writes.upsert(rows, changes, 2)
    c.delete(where=f.eq("even", True), where_document=Contains("changed w1"))
    expected = writes.delete(expected, where=f.eq("even", True), where_document=Contains("changed w1"))
    gone = spark.createDataFrame([("id1",), ("id2",), ("nobody",)], "_id string")
    c.delete(ids=gone, where=f.lte("n", 1))
    expected = writes.delete(expected, gone, f.lte("n", 1))
    assert wide(c.rows()) == wide(expected)
    c.delete(where=f.gte("n", 0))
    c.delete(ids=[r["_id"] for r in c.rows().collect()])
    assert c.count() == 0 and c.version().rows == {}


def test_point_reads_open_their_folders_only(spark, name):
    c = create_collection(spark, name, 2, "l2", sample(spark), folders=16)
    asked = spark.createDataFrame([("id3",), ("id4",), (None,)], "_id string")
    for found in (c.get(ids=["id3", "id4"]), c.get(ids=asked)):
        assert ids(found) == ["id3", "id4"]
        pruned = re.search(r"PartitionFilters: \[([^\]]*)", plan_of(found)).group(1)
        assert "folder" in pruned
    assert c.get(ids=[]).count() == 0
    assert "id3" in re.search(r"PushedFilters: \[([^\]]*)", plan_of(c.get(ids=["id3"]))).group(1)


def test_one_of_two_writers_is_refused(spark, name):
    c = create_collection(spark, name, 2, "l2", sample(spark, 20))
    batch = lambda i: spark.createDataFrame([(i, "t", [0.0, 1.0])], "_id string, document string, embedding array<float>")
    other = open_collection(spark, name)
    seen = other.version()
    other.version = lambda: seen  # it read before the first one published
    c.add(batch("b"))
    with pytest.raises(ConflictError):
        other.add(batch("b"))
    with pytest.raises(ConflictError):
        other.delete(where=f.gte("n", 0))
    with pytest.raises(ConflictError):
        other.build_text_index()
    assert c.count() == 21 and ids(c.get(ids=["b"])) == ["b"]


def test_a_number_is_published_once(spark, tmp_path):
    path = f"{tmp_path}/versions/1"
    assert storage.publish(spark, path, "first") and not storage.publish(spark, path, "second")
    assert storage.read_small(spark, path) == "first" and storage.names_in(spark, f"{tmp_path}/versions") == ["1"]
    assert storage.names_in(spark, f"{tmp_path}/nowhere") == []


def test_vacuum_and_drop(spark, name):
    c = create_collection(spark, name, 2, "l2", sample(spark), folders=8)
    c.build_text_index()
    c.build_vector_index(2)
    before = ids(c.rows())
    for i in range(3):
        c.delete(ids=[f"id{i}"])
    assert c.vacuum(older_than=3600) == 5  # old versions; their files are too young
    assert len(versions.numbers(spark, c.root)) == 1
    assert c.vacuum(older_than=-60) > 0
    assert set(ids(c.rows())) == set(before) - {"id0", "id1", "id2"}
    queries = spark.createDataFrame([(0, "w0 w1")], "query_id int, text string")
    assert c.search_text(queries, 5).count() == 5 and c.vacuum(older_than=-60) == 0
    with pytest.raises(NotFoundError):
        versions.load(spark, f"{c.root}/nowhere")
    drop_collection(spark, name)
    assert storage.names_in(spark, c.root) == []
    with pytest.raises(NotFoundError):
        drop_collection(spark, name)


# Text index

def brute_bm25(rows, texts, k):
    """{(query, rank): (_id, score)} with the usual parameters, scores in whole 1e-12."""
    tokens = lambda t: re.findall(r"\w+", t.lower())
    counted = {i: Counter(tokens(d)) for i, d in rows if d is not None}
    n, mean = len(counted), sum(sum(c.values()) for c in counted.values()) / max(1, len(counted))
    df = Counter(w for c in counted.values() for w in c)
    out = {}
    for q, text in texts:
        scores = []
        for i, c in counted.items():
            total = 0
            for w in set(tokens(text)) & set(c):
                share = math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean))
                total += math.floor(share * 1e12 + 0.5)
            if total:
                scores.append((-total, i))
        out |= {(q, r): (i, round(-s / 1e12, 9)) for r, (s, i) in enumerate(sorted(scores)[:k], 1)}
    return out


TEXTS = [(0, "w0 w1"), (1, "w55 w58 w59"), (2, "w3"), (3, "nothing"), (4, "w2 w2 w40 new")]


def found_bm25(hits):
    return {(r.query_id, r["rank"]): (r["_id"], round(r.score, 9)) for r in hits.collect()}


@pytest.mark.parametrize("first", [1, 4])
def test_stored_postings_equal_brute_force_after_writes(spark, name, first, monkeypatch):
    monkeypatch.setattr(blockwords, "BLOCK_ROWS", 16)
    monkeypatch.setattr(blockwords, "FIRST_BLOCKS", (first, first))
    c = create_collection(spark, name, 2, "l2", sample(spark), folders=8)
    c.build_text_index(folders=16)
    queries = spark.createDataFrame(TEXTS, "query_id int, text string")

    def check():
        rows = [(r["_id"], r.document) for r in c.rows().collect()]
        assert found_bm25(c.search_text(queries, 5, include=[])) == brute_bm25(rows, TEXTS, 5)
        index = c.text_index()
        assert (index.totals.rows, index.totals.words) == (
            sum(d is not None for _, d in rows), sum(len(re.findall(r"\w+", d)) for _, d in rows if d is not None))

    check()
    c.update(spark.createDataFrame([("id3", "new w0 w0 w0"), ("id62", "w59 now it has words")], "_id string, document string")
             .withColumn("embedding", F.array(F.lit(1.0).cast("float"), F.lit(0.0).cast("float"))))
    c.upsert(spark.createDataFrame([("id5", "{}"), ("more", "{}")], "_id string, metadata string"))
    check()
    c.delete(where=f.eq("even", False))
    c.upsert(spark.createDataFrame([("id4", "w55 new new"), ("again", "w58 w59")], "_id string, document string"))
    check()
    parts = len(c.version().text.parts)
    c.compact()
    assert parts > 3 and len(c.version().text.parts) == 1
    assert c.text_index().frame.where("n <= 0").count() == 0
    check()


def test_filtered_text_search(spark, name):
    rows = sample(spark)
    c = create_collection(spark, name, 2, "l2", rows, folders=8)
    with pytest.raises(ConfigError):
        c.search_text(rows)
    c.build_text_index()
    queries = spark.createDataFrame(TEXTS, "query_id int, text string")
    expected = fulltext.bm25(fulltext.term_index(rows), queries, 7, where=f.eq("even", True))
    assert found_bm25(c.search_text(queries, 7, where=f.eq("even", True), include=[])) == found_bm25(expected)
    found = c.search_text(queries, 3)
    assert found.columns == ["query_id", "rank", "_id", "document", "metadata", "score"]
    with pytest.raises(InvalidInputError):
        c.search_text(queries, 0)


def test_blocks_without_a_result_are_not_scored(spark):
    """A rare word decides; blocks that hold only common words are skipped, and hits are those of all rows."""
    rng = random.Random(4)
    rows = [(f"r{i:04d}", " ".join(["common", "usual"] + [f"x{rng.randrange(500)}" for _ in range(20)]
                                   + (["rare", "rarer"] if i % 200 == 7 else []))) for i in range(3000)]
    held = spark.createDataFrame(rows, "_id string, document string")
    frame = storage.stored(blockwords.entries(held, 3000 // 16), "entries")
    index = blockwords.BlockIndex(frame, blockwords.totals(held), blockwords.FOLDERS)
    queries = spark.createDataFrame([(0, "common rare rarer"), (1, "usual rarer")], "query_id int, text string")
    plan = blockwords.plan(index, queries)
    best, rest = blockwords.chosen_blocks(plan, 10)
    scored = blockwords.scored(plan, best.unionByName(rest), None).count()
    assert scored < 2 * 3000 / 5
    expected = fulltext.bm25(fulltext.term_index(held), queries, 10)
    assert found_bm25(blockwords.bm25(index, queries, 10)) == found_bm25(expected)


def test_word_search_opens_its_words_folders(spark, name):
    c = create_collection(spark, name, 2, "l2", sample(spark), folders=8)
    c.build_text_index()
    words = spark.createDataFrame([("w1",), ("w2",)], "token string")
    read = plan_of(blockwords.only_words(c.text_index(), words))
    assert re.search(r"PartitionFilters: \[[^\]]*folder", read)


def test_the_tokenizer_stays_with_the_collection(spark, name, rows):
    """Documents without spaces are found before and after the index is built."""
    c = create_collection(spark, name, 1, "l2", rows(
        ("a", "我们研究机器学习算法", [1], "{}"), ("b", "天气很好", [2], "{}"), ("c", "words only", [3], "{}")), tokenizer="pairs")
    branch = TextBranch(where_document=Contains("机器学习", pair_tokens))
    assert ids(c.hybrid_search_advanced(branch)) == ["a"]
    c.build_text_index()
    assert ids(c.hybrid_search_advanced(branch)) == ids(open_collection(spark, name).hybrid_search_advanced(branch)) == ["a"]
    # words of another tokenizer are not looked up in these postings
    other = TextBranch(where_document=Contains("天气很好"), tokenizer=fulltext.tokens)
    assert ids(c.hybrid_search_advanced(other)) == ["b"]
    c.upsert(spark.createDataFrame([("c", "算法")], "_id string, document string"))
    assert ids(c.hybrid_search_advanced(TextBranch(where_document=Contains("算法", pair_tokens)))) == ["a", "c"]
    with pytest.raises(ConfigError):
        create_collection(spark, name + "x", 1, "l2", tokenizer="none")


# Vector index

def test_cells_follow_writes(spark, name):
    c = create_collection(spark, name, 2, "l2", sample(spark), folders=8)
    c.build_vector_index(6)
    queries = spark.createDataFrame([(i, [0.3 * i - 1, 0.5 - 0.2 * i]) for i in range(5)], "query_id int, embedding array<float>")

    def check():
        exact = [tuple(r) for r in c.query(queries, 6, include=[]).orderBy("query_id", "rank").collect()]
        assert [tuple(r) for r in c.query(queries, 6, include=[], probes=6).orderBy("query_id", "rank").collect()] == exact
        some = c.query(queries, 6, include=[], probes=6, where=f.eq("even", True))
        assert ranked_ids(some) == ranked_ids(c.query(queries, 6, include=[], where=f.eq("even", True)))

    check()
    c.update(spark.createDataFrame([(f"id{i}", [0.3 * i - 1, 0.5]) for i in range(8)], "_id string, embedding array<float>"))
    c.upsert(spark.createDataFrame([("id1", [9.0, 9.0]), ("near", [-1.0, 0.5])], "_id string, embedding array<float>"))
    check()
    c.delete(ids=["near", "id0", "id60"])
    c.update(spark.createDataFrame([("id9", '{"even": true}')], "_id string, metadata string"))
    assert len(c.version().vectors.parts) == 4  # metadata alone adds no part
    check()
    c.compact(folders=4)
    assert len(c.version().vectors.parts) == 1 and c.version().folders == 4
    check()


def test_centres_from_a_table(spark, name, rows):
    held = rows(*[(f"v{i}", "", [math.cos(i), math.sin(i)], "{}") for i in range(40)])
    table = spark.createDataFrame([(3, [0.0, -2.0]), (1, [1.0, 0.0]), (2, [0.0, 5.0])], "cell int, embedding array<float>")
    model = cells.centres_from(table, "cosine")
    assert model.points.tolist() == [[1, 0], [0, 1], [0, -1]] and model.unit
    c = create_collection(spark, name, 2, "cosine", held)
    c.build_vector_index(3, centres=table)
    queries = spark.createDataFrame([(0, [0.9, 0.1])], "query_id int, embedding array<float>")
    one = c.query(queries, 40, include=[], probes=1)
    inside = {f"v{i}" for i in range(40) if math.cos(i) > abs(math.sin(i)) or (math.cos(i) >= math.sin(i) and math.cos(i) >= -math.sin(i))}
    assert set(ids(one)) == inside and c.query(queries, 40, probes=3).count() == 40
    for bad in (table.where("cell > 9"), spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "cell int, embedding array<float>")):
        with pytest.raises(InvalidInputError):
            cells.centres_from(bad, "l2")


def test_probes_in_hybrid_search(spark, name):
    c = create_collection(spark, name, 2, "cosine", sample(spark), folders=8)
    c.build_text_index()
    queries = spark.createDataFrame([(i, [1.0 - i, 0.5]) for i in range(3)], "query_id int, embedding array<float>")
    text = TextBranch(f.eq("even", True), Contains("w1 w2"))
    with pytest.raises(ConfigError):
        c.hybrid_search_advanced(text, KnnBranch(queries, probes=2), Rrf(), 8, [])
    c.build_vector_index(5)
    for where in (None, f.lt("n", 120), f.lt("n", 9)):
        full = c.hybrid_search_advanced(text, KnnBranch(queries, where, 20, probes=5), Rrf(30, 20), 8, [])
        exact = c.hybrid_search_advanced(text, KnnBranch(queries, where, 20), Rrf(30, 20), 8, [])
        assert [tuple(r) for r in full.orderBy("query_id", "rank").collect()] == [
            tuple(r) for r in exact.orderBy("query_id", "rank").collect()]
    # a predicate that few rows pass is answered exactly, however few cells are probed
    few = c.hybrid_search_advanced(None, KnnBranch(queries, f.lt("n", 9), probes=1), None, 9, [])
    assert few.count() == 27


# Metadata keys

def test_keys_prune_and_change_no_result(spark, name, rows, monkeypatch):
    monkeypatch.setattr(versions, "ROW_GROUP_BYTES", 4096)
    odd = ['{"k": "5"}', '{"k": 5}', '{"k": 5.0}', '{"k": true}', '{"k": null}', "{}", '{"k": [5]}', '{"k": 9007199254740993}',
           '{"a": {"b c": "x"}}', '{"a": {"b c": 7}}', "null", None]
    c = create_collection(spark, name, 1, "l2", rows(
        *[(f"o{i}", "t", [i], m) for i, m in enumerate(odd)],
        *[(f"r{i}", f"text {i}", [i], f'{{"k": {i}, "a": {{"b c": "v{i % 7}"}}}}') for i in range(3000)]),
        folders=2, keys={"k": "number", "a.b c": "string", "flag": "boolean"})
    c = open_collection(spark, name)
    by = c.filters
    pairs = [(by.eq("k", 5), f.eq("k", 5)), (by.eq("k", "5"), f.eq("k", "5")), (by.eq("k", True), f.eq("k", True)),
             (~by.eq("k", 5), ~f.eq("k", 5)), (by.gt("k", 9007199254740992), f.gt("k", 9007199254740992)),
             (by.lt("k", 3), f.lt("k", 3)), (~by.lte("k", 2990.5), ~f.lte("k", 2990.5)), (by.gte("k", 2999), f.gte("k", 2999)),
             (by.is_in("k", [1, 2.0, "5"]), f.is_in("k", [1, 2.0, "5"])), (by.is_in("k", [1, 2.0]), f.is_in("k", [1, 2.0])),
             (by.eq("a.b c", "x"), f.eq("a.b c", "x")), (by.ne("a.b c", "v1"), f.ne("a.b c", "v1")), (by.eq("k", None), f.eq("k", None)),
             (by.not_in("k", [5]), f.not_in("k", [5])), (by.is_in("a.b c", []), f.is_in("a.b c", [])), (by.eq("other", 1), f.eq("other", 1))]
    for with_keys, without in pairs:
        assert ids(c.get(where=with_keys)) == ids(c.get(where=without))
    read = plan_of(c.get(where=by.eq("k", 77), include=[]))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(key_0,77.0\)", read)
    # sorted files: a value lies in one row group of each folder, as the statistics tell
    import pyarrow.parquet as pq
    files = [p.removeprefix("file:").replace("%20", " ") for p in c.rows().inputFiles()]
    metas = [pq.ParquetFile(p).metadata for p in files]
    groups = [m.row_group(g) for m in metas for g in range(m.num_row_groups)]
    stats = [c.statistics for g in groups for c in map(g.column, range(g.num_columns)) if c.path_in_schema == "key_0"]
    assert len(stats) > 6 and sum(s.has_min_max and s.min <= 1500 <= s.max for s in stats) <= 2
    c.update(spark.createDataFrame([("r5", '{"k": -4}')], "_id string, metadata string"))
    assert ids(c.get(where=by.lt("k", 0))) == ["r5"] and ids(c.query(spark.createDataFrame(
        [(0, [4.0])], "query_id int, embedding array<float>"), 1, where=by.eq("k", -4))) == ["r5"]
    with pytest.raises(InvalidInputError):
        create_collection(spark, name + "x", 1, "l2", keys={"k": "date"})
