"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of runs of five words (lower-cased runs of letters, digits and characters beyond
ASCII; a text of fewer words is one run). Equal sets are one class at once, found by a digest. The
classes' MinHash values are cut into bands; classes that agree in a band are candidates. Inside a
task their values are compared a few at a time: under a uniform prior, the number of agreements so
far gives the posterior probability that the similarity reaches the threshold, and a pair is
dropped when that falls below the tolerance. What is left is verified on the sets themselves.

Pairs never become rows. A band's bucket is cut into blocks of bounded size, a task holds two
blocks, and it returns for each class its number of links and one edge of a spanning forest. A
pair that agrees in several bands counts in the first one only. Sets travel only for classes with
a pair that survived pruning. Edges are joined to components by label propagation with pointer
jumping over stored tables.

Texts without words, NULL among them, are equal to nothing: each is its own component without links.
Rows with a NULL id take part in links and components; the component's id is its least non-NULL
id. Repeated rows are links like any other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docweave.llm.common import (
    ALNUM, encoded, hashes, in_batches, mixed, owners, rolling, slices, spans, words,
)
from docweave.plans.sizing import broadcast_if_small
from docweave.sources.storage import stored

SHINGLE = 5
THRESHOLD = 0.8
TOLERANCE = 1e-8          # asked at each of 16 looks: a pair right at 0.8 is pruned with about 2e-7
BANDS, ROWS = 32, 5       # a pair right at 0.8 misses all bands with probability 3e-6, one at 0.85 5e-9
HASHES = BANDS * ROWS
STEP = 10                 # hashes compared before each look at the posterior
BLOCK = 256
PAIRS_AT_ONCE = 200_000
GROUP = ("band", "key", "one", "two")
_DRAWN = np.random.default_rng(20).integers(1, 1 << 31, (2, HASHES), dtype=np.uint32)
_FACTORS, _SHIFTS = _DRAWN[0] * np.uint32(2) + np.uint32(1), _DRAWN[1]


def shingles(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word runs, and where each text's start."""
    found, starts = words(texts, ALNUM)
    distinct, ids = encoded(found)
    values = hashes(distinct)[ids]
    counts = np.diff(starts)
    of, text_of = rolling(values, width), owners(starts)
    whole = text_of[:len(of)] == text_of[width - 1:] if len(of) else np.zeros(0, bool)
    runs, run_of = of[whole], text_of[:len(of)][whole]
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        own = [rolling(np.append(values[starts[t]:starts[t + 1]], np.uint64(counts[t])), counts[t] + 1)[0] for t in short]
        runs, run_of = np.append(runs, np.array(own, np.uint64)), np.append(run_of, short)
    order = np.lexsort((runs, run_of))
    runs, run_of = runs[order], run_of[order]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:] != runs[:-1]) | (run_of[1:] != run_of[:-1])
    return runs[first], np.concatenate(([0], np.cumsum(np.bincount(run_of[first], minlength=len(texts)))))


def signatures(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash values (sets x HASHES, 16 bits kept) of sets that are not empty."""
    short = (sets >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts) - 1, HASHES), np.uint16)
    for i in range(HASHES):
        out[:, i] = np.minimum.reduceat((short ^ _SHIFTS[i]) * _FACTORS[i], starts[:-1]) & 0xFFFF
    return out


def row_key(id_column: str, text_column: str):
    """Digest of a row's id and text; NULL is told from empty."""
    parts = [F.coalesce(F.md5(F.col(c).cast("string")), F.lit("NULL")) for c in (id_column, text_column)]
    return F.unhex(F.md5(F.concat_ws("|", *parts)))


def sketches(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, row, set_key, signature) of every text; NULL key for one without words."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                sets, starts = shingles(part["text"])
                sizes = np.diff(starts)
                full = sizes > 0
                # two sums over mixed hashes tell sets apart: 128 bits
                sums = np.zeros((len(sizes), 2), np.uint64)
                marks = np.zeros((len(sizes), HASHES), np.uint16)
                if full.any():
                    held = np.append(starts[:-1][full], len(sets))
                    sums[full, 0] = np.add.reduceat(mixed(sets), held[:-1])
                    sums[full, 1] = np.add.reduceat(mixed(sets ^ np.uint64(0x5851F42D4C957F2D)), held[:-1])
                    marks[full] = signatures(sets, held)
                keys = [s.tobytes() if f else None for s, f in zip(sums, full)]
                marked = [m.tobytes() if f else None for m, f in zip(marks, full)]
                yield pa.RecordBatch.from_arrays(
                    [part["id"], part["row"], pa.array(keys, pa.binary()), pa.array(marked, pa.binary())],
                    names=["id", "row", "set_key", "signature"])

    rows = docs.select(F.col(id_column).alias("id"), row_key(id_column, text_column).alias("row"),
                       F.col(text_column).alias("text"))
    return in_batches(rows, run, f"id {kind}, row binary, set_key binary, signature binary")


def least_agreements(threshold: float, tolerance: float) -> np.ndarray:
    """For each number n of compared hashes the fewest agreements m with a posterior probability
    P(similarity >= threshold | m of n) of at least the tolerance (uniform prior, so a Beta(m + 1,
    n - m + 1) tail, which equals a binomial sum)."""
    out = np.zeros(HASHES + 1, np.int32)
    for n in range(1, HASHES + 1):
        tail, m = 0.0, 0
        for m in range(n + 2):
            # P(S >= t | m, n) = P(Binomial(n + 1, t) <= m)
            tail += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
        out[n] = m
    return out


def partners(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """For each row of whole groups, sorted by side, the run of rows it is to be compared with:
    the other side's, or the later rows where a block meets itself."""
    n = len(table)
    change = np.zeros(n, bool)
    change[0] = True
    for name in GROUP:
        values = np.asarray(table[name])
        change[1:] |= values[1:] != values[:-1]
    group = np.cumsum(change) - 1
    begin = np.flatnonzero(change)
    size = np.diff(np.append(begin, n))
    side = np.asarray(table["side"])
    n_right = np.bincount(group, side, len(begin)).astype(np.int64)
    end = (begin + size)[group]
    same = np.asarray(table["one"]) == np.asarray(table["two"])
    start = np.where(same, np.arange(n) + 1, end - n_right[group])
    return start, np.where(same | (side == 0), end - start, 0)


def surviving(table: pa.Table, fewest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs that pruning leaves, each pair once over all bands: one that agrees in an
    earlier band belongs there."""
    marks = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint16).reshape(-1, HASHES)
    band = np.asarray(table["band"])
    start, length = partners(table)
    out_i, out_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    at = 0
    totals = np.cumsum(length)
    while at < len(table):
        before = totals[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(totals, before + PAIRS_AT_ONCE, side="right")))
        i = np.repeat(np.arange(at, stop), length[at:stop])
        j = spans(start[at:stop], length[at:stop])
        at = stop
        agree = np.zeros(len(i), np.int32)
        for h in range(0, HASHES, STEP):
            agree += (marks[i, h:h + STEP] == marks[j, h:h + STEP]).sum(axis=1, dtype=np.int32)
            stay = agree >= fewest[h + STEP]
            if not stay.all():
                i, j, agree = i[stay], j[stay], agree[stay]
        for k in range(0, len(i), 20_000):  # in slices, as all bands are compared
            a, b = i[k:k + 20_000], j[k:k + 20_000]
            equal = (marks[a] == marks[b]).reshape(len(a), BANDS, ROWS).all(axis=2)
            own = np.argmax(equal, axis=1) == band[a]
            out_i.append(a[own])
            out_j.append(b[own])
    return np.concatenate(out_i), np.concatenate(out_j)


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by group: the last group of a batch waits for
    the next batch."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        last = [table[n][-1].as_py() for n in GROUP]
        own = np.ones(len(table), bool)
        for name, value in zip(GROUP, last):
            own &= np.asarray(table[name]) == value
        cut = len(table) - int(own[::-1].argmin()) if not own.all() else 0
        if cut:
            yield pa.concat_tables([*held, table.slice(0, cut)]).combine_chunks()
            held = [table.slice(cut)]
        elif held and [held[-1][n][-1].as_py() for n in GROUP] != last:
            yield pa.concat_tables(held).combine_chunks()
            held = [table]
        else:
            held.append(table)
    if held:
        yield pa.concat_tables(held).combine_chunks()


def by_group(rows: DataFrame) -> DataFrame:
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP, "side")


def verified(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sets reach the threshold, by exact intersection sizes."""
    if not len(i):
        return np.zeros(0, bool)
    sizes = np.array([len(s) for s in sets])
    distinct, ids = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    inside = np.zeros(len(distinct), bool)
    out = np.zeros(len(i), bool)
    scaled = round(threshold * 1_000_000)
    order = np.argsort(i, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(i[order])) + 1):
        own = ids[starts[i[group[0]]]:starts[i[group[0]] + 1]]
        inside[own] = True
        others = j[group]
        spread = np.concatenate([ids[starts[o]:starts[o + 1]] for o in others])
        ends = np.concatenate(([0], np.cumsum(sizes[others])))[:-1]
        common = np.add.reduceat(inside[spread].astype(np.int64), ends)
        inside[own] = False
        out[group] = common * 1_000_000 >= scaled * (len(own) + sizes[others] - common)
    return out


def buckets(classes: DataFrame) -> DataFrame:
    """(band, key, set_key, block, n_blocks): members of every bucket with two classes or more."""
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.struct(
        b.alias("band"), F.xxhash64(b, F.substring("signature", b * ROWS * 2 + 1, F.lit(ROWS * 2))).alias("key")))
    each = classes.select("set_key", F.explode(bands).alias("_b")).select("_b.band", "_b.key", "set_key")
    sizes = each.groupBy("band", "key").agg(F.count("*").alias("members")).where("members > 1")
    held = each.join(sizes, ["band", "key"])
    n_blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    return held.select("band", "key", "set_key", n_blocks.alias("n_blocks"),
                       F.pmod(F.xxhash64("set_key"), n_blocks.cast("bigint")).cast("int").alias("block"))


def in_pairs(members: DataFrame) -> DataFrame:
    """Each member once for every pair of blocks that its block is in: (band, key, one, two, side)."""
    others = F.transform(F.sequence(F.lit(0), F.col("n_blocks") - 1), lambda b: F.struct(
        F.least(b, "block").alias("one"), F.greatest(b, "block").alias("two"),
        F.when(b < F.col("block"), 1).otherwise(0).alias("side")))
    return members.select("band", "key", "set_key", F.explode(others).alias("_p")).select(
        "band", "key", "_p.one", "_p.two", "_p.side", "set_key")


def near_links(docs: DataFrame, classes: DataFrame, id_column: str, text_column: str,
               threshold: float, tolerance: float) -> DataFrame:
    """(set_key, links, other): for each class of a task with links, the number of rows linked in
    that task and a class of the same component."""
    fewest = least_agreements(threshold, tolerance)
    group = "band int, key long, one int, two int, side int"
    pairs = in_pairs(buckets(classes)).join(classes.select("set_key", "signature"), "set_key")

    def prune(batches: Iterator[pa.RecordBatch]):
        for table in whole_groups(batches):
            i, j = surviving(table, fewest)
            kept = table.take(pa.array(np.unique(np.concatenate((i, j))))).select([*GROUP, "side", "set_key"])
            yield from kept.to_batches()

    active = stored(in_batches(by_group(pairs.select(*GROUP, "side", "set_key", "signature")), prune,
                               f"{group}, set_key binary"), "near_candidates")
    wanted = classes.join(active.select("set_key").distinct(), "set_key").select("set_key", "signature", "copies", "row")

    def with_runs(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch):
                sets, starts = shingles(part["text"])
                yield pa.RecordBatch.from_arrays(
                    [part["set_key"], part["signature"], part["copies"],
                     pa.array([sets[a:b].tobytes() for a, b in zip(starts, starts[1:])], pa.binary())],
                    names=["set_key", "signature", "copies", "runs"])

    texts = docs.select(row_key(id_column, text_column).alias("row"), F.col(text_column).alias("text"))
    one_each = (texts.join(broadcast_if_small(stored(wanted, "near_wanted")), "row").groupBy("set_key").agg(
        F.first("signature").alias("signature"), F.first("copies").alias("copies"), F.first("text").alias("text")))
    held = in_batches(one_each, with_runs, "set_key binary, signature binary, copies long, runs binary")

    def verify(batches: Iterator[pa.RecordBatch]):
        for table in whole_groups(batches):
            i, j = surviving(table, fewest)
            sets = [np.frombuffer(r, np.uint64) for r in table["runs"].to_pylist()]
            real = verified(sets, i, j, threshold)
            i, j = i[real], j[real]
            copies = np.asarray(table["copies"])
            links = np.bincount(i, copies[j], len(table)) + np.bincount(j, copies[i], len(table))
            root = list(range(len(table)))

            def find(a: int) -> int:
                while root[a] != a:
                    root[a] = root[root[a]]
                    a = root[a]
                return a

            for a, b in zip(i.tolist(), j.tolist()):
                a, b = find(a), find(b)
                root[max(a, b)] = min(a, b)
            rows = np.flatnonzero(links)
            keys = table["set_key"]
            yield from pa.table({
                "set_key": keys.take(pa.array(rows)), "links": pa.array(links[rows].astype(np.int64)),
                "other": keys.take(pa.array([find(r) for r in rows.tolist()], pa.int64()))}).to_batches()

    return in_batches(by_group(active.join(held, "set_key")), verify, "set_key binary, links long, other binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each component, for every node with an edge (a, b). Each
    round takes the least label among the neighbours, then that label's own label; rounds end
    when nothing changes. Every round is a stored table, so lineage stays short."""
    both = stored(edges.where("a <> b").select("a", "b").unionByName(
        edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near_edges")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label"))
                    .withColumnRenamed("a", "node"), "near_labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy("a").agg(F.min("label").alias("least")).withColumnRenamed("a", "node"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "least").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = stored(lower.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("next", "label")).alias("label")), "near_labels")
        labels = moved.select("node", "label")
        if moved.where("label <> old").isEmpty():
            return labels


def grouped(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
            threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """(id, row, class_id, n_links, keeps, worded) for every row: the least id of its component, the number
    of other rows whose similarity reaches the threshold, and whether it is the one row of its
    component that stays (the least id, then the least digest of id and text)."""
    sketch = stored(sketches(docs, id_column, text_column), "near_sketches")
    classes = stored(sketch.where("set_key IS NOT NULL").groupBy("set_key").agg(
        F.count("*").alias("copies"), F.min("id").alias("least_id"),
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("least"),
        F.first("signature").alias("signature")).withColumn("row", F.col("least.row")), "near_classes")
    links = stored(near_links(docs, classes, id_column, text_column, threshold, tolerance), "near_links")
    labels = components(links.select(F.col("set_key").alias("a"), F.col("other").alias("b"))).select(
        F.col("node").alias("set_key"), "label")
    own = (classes.select("set_key", "copies", "least_id", "least").join(labels, "set_key", "left")
           .join(links.groupBy("set_key").agg(F.sum("links").alias("links")), "set_key", "left")
           .withColumn("label", F.coalesce("label", "set_key")))
    heads = own.groupBy("label").agg(F.min("least_id").alias("class_id"), F.min("least").alias("head"))
    known = own.join(heads, "label").select("set_key", "copies", "links", "class_id", "head")
    return (sketch.select("id", "row", "set_key").join(known, "set_key", "left").select(
        F.col("id").alias(id_column), "row", F.when(F.col("set_key").isNull(), F.col("id")).otherwise(
            F.col("class_id")).alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
        (F.col("set_key").isNull() | (F.col("row") == F.col("head.row"))).alias("keeps"),
        F.col("set_key").isNotNull().alias("worded")))


def near_join(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
              threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """(id, class_id, n_links) for every row."""
    return grouped(docs, id_column, text_column, threshold, tolerance).select(id_column, "class_id", "n_links")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                threshold: float = THRESHOLD) -> DataFrame:
    """The input's rows and columns with one row of each component; texts without words all stay, however often."""
    rows = stored(grouped(docs, id_column, text_column, threshold), "near_groups")
    gone = rows.where(~F.col("keeps")).select("row").distinct()
    left = docs.withColumn("_row", row_key(id_column, text_column)).join(
        broadcast_if_small(gone.withColumnRenamed("row", "_row")), "_row", "left_anti")
    again = stored(rows.where("keeps AND worded").groupBy(F.col("row").alias("_row")).count().where("count > 1").select("_row"),
                   "near_repeated")
    if not again.isEmpty():  # the same id and text more than once
        marks = broadcast_if_small(again)
        once = left.join(marks, "_row", "left_semi").dropDuplicates(["_row"])
        left = left.join(marks, "_row", "left_anti").unionByName(once)
    return left.drop("_row")
