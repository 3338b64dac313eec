"""Benchmark decontamination as a prefix-filtered join, with DataFrame functions only.

Each benchmark item is cut into windows of 13 consecutive words (a shorter item is one window). A
document holds a window only if it holds all its words, so the rarest one, by its number of
occurrences in all documents, is the only prefix needed: document words are joined with those
tokens alone. The token's place in the window and the lengths on either side bound where the
window may lie, and there its words are compared exactly. Windows with a word that occurs in no
document are dropped at once.

Documents are read twice (to count the benchmark's words, then to join) and never shuffled: what
is shuffled is one row for each document and one for each window found. The benchmark's tokens are
broadcast while their measured number is small; beyond that the join carries the 25 words
around each document word and shuffles them. NULL texts have no words. NULL and repeated ids keep
one row for each input row. Items without words never occur. Items with a NULL id are one item: its
windows count as hits and it counts once in n_items, but it adds no id to the digest.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from docweave.plans.sizing import MAX_BROADCAST_ROWS, broadcast_if_small, fits
from docweave.sources.storage import stored

WIDTH = 13
SHARE = 20  # contaminated from 1 / 20 of the words on
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LAST = "\x00"  # stands after a document's words; no word holds it


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def item_windows(benchmark: DataFrame, width: int = WIDTH, id_column: str = "item_id",
                 text_column: str = "text") -> DataFrame:
    """(item, window): every run of `width` words of each item, or all words of a shorter one."""
    items = benchmark.select(F.col(id_column).alias("item"), words(F.col(text_column)).alias("words")).where(
        F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - width + 1))
    return items.select("item", "words", F.explode(starts).alias("at")).select(
        "item", F.slice("words", F.col("at"), F.lit(width)).alias("window")).distinct()


def rarest_tokens(windows: DataFrame, texts: DataFrame) -> DataFrame:
    """(token, item, window, place): for each window its rarest word and where it first stands,
    from 0. Only the benchmark's words are counted in the documents."""
    vocabulary = windows.select(F.explode("window").alias("token")).distinct()
    if fits(vocabulary, MAX_BROADCAST_ROWS):
        vocabulary = F.broadcast(vocabulary)
    counts = (texts.select(F.explode("words").alias("token")).join(vocabulary, "token")
              .groupBy("token").agg(F.count("*").alias("n")))
    each = windows.select("item", "window", F.posexplode("window").alias("place", "token"))
    known = each.join(counts, "token", "left")
    chosen = known.groupBy("item", "window").agg(
        F.min_by(F.struct("token", "place"), F.struct(F.coalesce("n", F.lit(0)), "token", "place")).alias("rare"),
        F.min(F.coalesce("n", F.lit(0))).alias("least"))
    return chosen.where(F.col("least") > 0).select("rare.token", "item", "window", "rare.place")


def _found(texts: DataFrame, tokens: DataFrame, width: int) -> DataFrame:
    """(_row, _id, n_words, start, length, item): every occurrence of every window, and for
    each document one row of length 0."""
    kind = tokens.schema["item"].dataType
    last = tokens.sparkSession.createDataFrame([(LAST,)], "token string").select(
        "token", F.lit(None).cast(kind).alias("item"), F.array(F.lit(LAST)).alias("window"), F.lit(0).alias("place"))
    tokens = stored(tokens.unionByName(last), "benchmark_tokens")
    here = texts.select("_row", "_id", F.size("words").alias("n_words"),
                        F.array_append("words", F.lit(LAST)).alias("words"))
    start, length = F.col("at") - F.col("place"), F.size("window")
    counted = F.when(F.col("token") == LAST, 0).otherwise(length)
    if fits(tokens, MAX_BROADCAST_ROWS):
        each = here.select("_row", "_id", "n_words", "words", F.posexplode("words").alias("at", "token"))
        near = each.join(F.broadcast(tokens), "token").where((start >= 0) & (start + length <= F.size("words")))
        hit = near.where(F.slice("words", start + 1, length) == F.col("window"))
    else:
        each = here.select("_row", "_id", "n_words", "words", F.posexplode("words").alias("at", "token")).select(
            "_row", "_id", "n_words", "at", "token", F.least("at", F.lit(width - 1)).alias("left"),
            F.slice("words", F.greatest(F.lit(1), F.col("at") - width + 2), F.lit(2 * width - 1)).alias("near"))
        own = F.col("left") - F.col("place")
        hit = each.join(tokens, "token").where((start >= 0) & (own + length <= F.size("near"))).where(
            F.slice("near", own + 1, length) == F.col("window"))
    return hit.select("_row", "_id", "n_words", start.alias("start"), counted.alias("length"), "item")


def covered(spans: Column) -> Column:
    """Number of words in the union of (start, end) spans sorted by start."""
    begin = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(state: Column, span: Column) -> Column:
        fresh = F.greatest(F.lit(0), span["end"] - F.greatest(state["end"], span["start"]))
        return F.struct(F.greatest(state["end"], span["end"]).alias("end"), (state["n"] + fresh).alias("n"))

    return F.aggregate(spans, begin, add, lambda s: s["n"])


def clean(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          width: int = WIDTH, share: int = SHARE) -> DataFrame:
    """The input's rows and columns without contaminated documents. Those are few, so their ids
    and the digests of their texts go to the documents where their measured number allows."""
    digest = F.md5(F.coalesce(F.col(text_column), F.lit("")))
    judged = contamination(docs, benchmark, id_column, text_column, width, share, digest)
    bad = stored(judged.where("contaminated").select(F.col("_digest")).distinct(), "contaminated")
    marked = docs.withColumn("_digest", digest)
    return marked.join(broadcast_if_small(bad), "_digest", "left_anti").drop("_digest")


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id",
                  text_column: str = "text", width: int = WIDTH, share: int = SHARE,
                  digest: Column | None = None) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) of every document, and `_digest` if
    an expression for it is given."""
    extra = {} if digest is None else {"_digest": digest}
    texts = docs.select(F.struct(F.col(id_column).alias("id"), *(c.alias(n) for n, c in extra.items())).alias("_id"),
                        F.monotonically_increasing_id().alias("_row"), words(F.col(text_column)).alias("words"))
    windows = stored(item_windows(benchmark, width), "benchmark_windows")
    found = _found(texts, rarest_tokens(windows, texts), width)
    hit = F.col("length") > 0  # any item may have a NULL id; only the last row has no length
    span = F.when(hit, F.struct("start", (F.col("start") + F.col("length")).alias("end")))
    by_text = found.groupBy("_row").agg(
        F.first("_id").alias("_id"), F.max("n_words").cast("long").alias("n_words"),
        F.sort_array(F.collect_set(span)).alias("spans"),
        F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"),
        F.max((hit & F.col("item").isNull()).cast("int")).alias("nameless"))
    return by_text.select(
        F.col("_id.id").alias(id_column), "n_words", covered(F.col("spans")).cast("long").alias("n_hit"),
        (F.size("items") + F.col("nameless")).cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        *(f"_id.{n}" for n in extra)).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
