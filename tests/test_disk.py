"""What writes to stored collections leave on disk, and what they hold there on their way."""

import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docweave import create_collection
from docweave.functions import filters as f
from docweave.operators import blockwords, writes
from docweave.plans import sizing
from docweave.sources import collection, storage
from docweave.sources.versions import FOLDER


def texts(spark, n=120, start=0, word="old"):
    return spark.range(start, start + n).select(
        F.col("id").cast("string").alias("_id"),
        F.when(F.col("id") % 11 != 0, F.concat(F.lit(f"{word} common w"), F.col("id") % 7)).alias("document"),
        F.array(F.lit(1.0), F.col("id")).cast("array<float>").alias("embedding"),
        F.parse_json(F.to_json(F.struct((F.col("id") % 4).alias("n")))).alias("metadata"))


def made(spark):
    c = create_collection(spark, f"d_{uuid.uuid4().hex[:10]}", 2, "l2", texts(spark))
    c.build_text_index()
    return c


def hits(spark, c):
    queries = spark.createDataFrame([(0, "old w1"), (1, "new w3 w4"), (2, "added common"), (3, "none")],
                                    "query_id int, text string")
    return sorted(tuple(r) for r in c.search_text(queries, 9, include=[]).collect())


def write(spark, c):
    """Each kind of write."""
    c.upsert(texts(spark, 90, 60, "new"))
    c.update(spark.createDataFrame([("7", "new common common"), ("no", "x")], "_id string, document string")
             .withColumn("embedding", F.lit(None).cast("array<float>")))
    c.delete(where=f.eq("n", 1))
    c.delete(ids=spark.createDataFrame([("8",), ("12",)], "_id string"))
    c.add(texts(spark, 20, 500, "added"))


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle")}


@pytest.fixture
def own_root(tmp_path, monkeypatch):
    """A shared folder that no other run writes to."""
    monkeypatch.setattr(storage, "storage_root", lambda spark: f"{tmp_path}/docweave")


def temporary(spark):
    """Tables beside the collections, by what they are called."""
    root = storage.storage_root(spark)
    return {(name, table) for name in storage.names_in(spark, root) for table in storage.names_in(spark, f"{root}/{name}")}


def test_writes_leave_no_tables_of_their_own(spark, own_root):
    c = made(spark)
    before = temporary(spark)
    write(spark, c)
    c.compact()
    assert temporary(spark) == before and c.count() > 0


def test_a_failed_write_leaves_no_tables(spark, own_root):
    c = made(spark)
    before = temporary(spark)
    with pytest.raises(Exception, match="ids exist already"):
        c.add(texts(spark, 3))
    assert temporary(spark) == before


def test_shuffle_files_of_written_rows_go_at_once(spark):
    """Writes alone, since counts and checks are plain queries whose small files stay until garbage is collected."""
    rows = texts(spark, 400).repartition(4, "_id")
    before = shuffle_files(spark)
    with storage.scratch(spark):
        with storage.tidy(spark):
            kept = storage.stored(rows, "tidied")
        assert kept.count() == 400 and spark.conf.get(storage.CLEANUP) == "true"
    assert spark.conf.get(storage.CLEANUP, "false") == "false"
    for _ in range(50):  # removed in the background
        left = {x for x in shuffle_files(spark) - before if x.endswith(".data")}
        if len(left) <= 1:  # of the count
            break
        spark.range(10).count()
    assert len(left) <= 1


@pytest.fixture
def rounds(monkeypatch):
    monkeypatch.setattr(collection, "_rounds", lambda *given: 3)
    monkeypatch.setattr(collection, "ROUND_BYTES", 1)
    monkeypatch.setattr(blockwords, "BLOCK_ROWS", 16)
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 0)


def test_rounds_change_nothing(spark, rounds, monkeypatch):
    """Rows and hits are those of writes in one go."""
    monkeypatch.setattr(blockwords, "FIRST_BLOCKS", (1, 1))
    few = made(spark)
    write(spark, few)
    monkeypatch.setattr(sizing, "MAX_BROADCAST_ROWS", 100_000)
    assert few.text_index().rounds == collection.MOST_ROUNDS
    found = hits(spark, few)
    rows = sorted((r[0], r[1], r[2]) for r in few.rows().collect())
    monkeypatch.setattr(collection, "ROUND_BYTES", 2 ** 40)
    monkeypatch.setattr(collection, "_rounds", lambda *given: 1)
    one = made(spark)
    write(spark, one)
    assert one.text_index().rounds == 1
    assert rows == sorted((r[0], r[1], r[2]) for r in one.rows().collect()) and len(rows) > 100
    assert found == hits(spark, one) and len(found) > 20


def test_each_round_reads_its_folders(spark, rounds):
    """The share of a round reaches the scan of the stored rows: the others are not read for it."""
    c = made(spark)
    version = c.version()
    base = c._scan(version)
    merged = writes.upsert(base, texts(spark, 10, 50, "new"), 2, dealt_by=collection._dealt(version))
    plan = merged.where(F.col(FOLDER).isin([0, 3]))._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [{FOLDER}" in plan.replace("isnotnull(folder", "folder") and plan.count("Exchange ") == 1


def test_changed_texts_meet_in_one_shuffle(spark):
    before, after = texts(spark, 30).where("_id <> '3'"), texts(spark, 40).where("_id <> '5'").withColumn(
        "document", F.when(F.col("_id") == "7", F.lit("other")).when(F.col("_id") == "9", F.lit(None)).otherwise(F.col("document")))
    changed = blockwords.changes(before, after, 5)
    assert changed._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    got = {(r["_id"], r["document"], r["sign"]) for r in changed.collect()}
    old, new = ({(r[0], r[1]) for r in x.select("_id", "document").collect() if r[1] is not None} for x in (before, after))
    assert got == {(*x, -1) for x in old - new} | {(*x, 1) for x in new - old} and len(got) == 14
    some = [blockwords.changes(before, after, 5, *r).collect() for r in ((0, 2), (2, 5))]
    assert {(r["_id"], r["document"], r["sign"]) for r in sum(some, [])} == got and all(some)


def test_index_rows_are_packed_on_their_way(spark, tmp_path, monkeypatch):
    """Packs hold what they are made of, and the files what went in, also of several writes."""
    monkeypatch.setattr(blockwords, "SHARE_BLOCKS", 3)
    index = storage.stored(blockwords.entries(texts(spark, 300), 10), "entries")
    blockwords.write_entries(index.where("block < 4"), f"{tmp_path}/i")
    blockwords.write_entries(index.where("block >= 4"), f"{tmp_path}/i")
    read = spark.read.schema(collection._ENTRIES).parquet(f"{tmp_path}/i").select(*index.columns)
    plain = lambda frame: sorted(
        (*r[:6], sorted(tuple(e) for e in r[6])) for r in frame.collect())
    assert plain(read) == plain(index)
    assert blockwords.words_in(read) == blockwords.totals(texts(spark, 300)).words
    rows = index.toArrow()
    packs = blockwords._packed(rows.to_batches())
    assert packs.num_rows == len({(r["folder"], r["block"] // 3) for r in rows.to_pylist()}) < len(rows)
    assert sum(len(p) for p in packs["held"].to_pylist()) > 0 and packs.schema.field("held").type == pa.binary()
