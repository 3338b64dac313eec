"""Quality rules as weak supervision: rules vote or abstain, and expectation-maximisation
weighs the votes.

Each rule says good (1), bad (-1) or nothing (0) about a text. Under a two-class model in which
rules err independently, EM estimates the share of good texts and, for each rule, how often it
votes which way in either class. A text is kept if its posterior probability of being good
reaches the limit. Votes are few values, so all that EM needs is how many texts show each
combination of votes: at most 3 ** rules rows, whatever the number of texts, counted over all.

A NULL or empty text has no words, so rules on shares abstain. NULL and repeated ids are kept as
they are. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from docweave.llm.common import (
    encoded, hashes, in_batches, owners, per_text, raw, rolling, slices, words,
)
from docweave.sources.storage import stored

WINDOW = 8
SYMBOLS = "#*$%&|<>"
GOOD_LIMIT = 0.5
AS_IS = np.arange(256, dtype=np.uint8)  # words keep their case

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals",
            "n_letters", "n_stops", "n_lines", "n_distinct")


def repeated_words(values: np.ndarray, starts: np.ndarray, ids: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """For each text, how many words lie in a run of `width` words that occurs twice or more in
    it. Runs with equal hashes are compared word by word; different ones are told apart."""
    text_of = owners(starts)
    runs = rolling(values, width)
    whole = text_of[:len(runs)] == text_of[width - 1:] if len(runs) else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    marked = np.zeros(len(values) + 1, np.int64)
    if len(at):
        key = runs[at] + text_of[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        order = np.argsort(key)
        at, key = at[order], key[order]
        same = np.concatenate(([False], key[1:] == key[:-1], [False]))
        group = np.flatnonzero(same[:-1] | same[1:])
        members = at[group]
        first = np.maximum.accumulate(np.where(same[group], -1, group))
        # members of a group hold the same words as its first one, but for colliding hashes
        equal = text_of[members] == text_of[at[first]]
        for k in range(width):
            equal &= ids[members + k] == ids[at[first] + k]
        if not equal.all():
            exact = np.column_stack([text_of[members], *(ids[members + k] for k in range(width))])
            _, back, counts = np.unique(exact, axis=0, return_inverse=True, return_counts=True)
            members = members[counts[back.ravel()] > 1]
        np.add.at(marked, members, 1)
        np.add.at(marked, members + width, -1)
    return per_text(np.cumsum(marked[:-1]) > 0, starts)


def duplicate_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each text: lines with a word, and those equal to an earlier line of the text."""
    lines = pc.split_pattern(texts, "\n")
    distinct, ids = encoded(lines.values)
    data, begins = raw(distinct)
    inside = (data != 32) & ~((data >= 9) & (data <= 13))
    filled = (per_text(inside, begins) > 0)[ids]
    starts = np.asarray(lines.offsets).astype(np.int64)
    key = np.unique(owners(starts)[filled] * np.int64(max(1, len(distinct))) + ids[filled])
    several = np.bincount((key // max(1, len(distinct))).astype(np.int64), minlength=len(texts))
    total = per_text(filled, starts)
    return total, total - several


def features(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             stop_length: int = 3) -> DataFrame:
    """(id, counts named in FEATURES) of every whole text, without a shuffle."""
    kind = docs.schema[id_column].dataType.simpleString()
    symbol = np.isin(np.arange(256), [ord(c) for c in SYMBOLS])

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_column):
                texts = pc.fill_null(part[text_column], "")
                data, begins = raw(texts)
                found, starts = words(texts, AS_IS)
                distinct, ids = encoded(found)
                space = (data == 32) | (data >= 9) & (data <= 13)
                short = np.asarray(pc.less_equal(pc.utf8_length(distinct), stop_length)) & np.asarray(
                    pc.utf8_is_alpha(distinct)) if len(distinct) else np.zeros(0, bool)
                lines, twice = duplicate_lines(texts)
                key = np.unique(owners(starts) * np.int64(max(1, len(distinct))) + ids)
                counts = {
                    "n_words": np.diff(starts),
                    "word_chars": per_text(~space & ((data & 0xC0) != 0x80), begins),
                    "n_symbols": per_text(symbol[data], begins),
                    "n_dup_lines": twice,
                    "n_repeat_words": repeated_words(hashes(distinct)[ids], starts, ids),
                    "n_capitals": per_text((data >= 65) & (data <= 90), begins),
                    "n_letters": per_text((data >= 65) & (data <= 90) | (data >= 97) & (data <= 122)
                                          | (data >= 0xC3), begins),
                    "n_stops": per_text(short[ids], starts),
                    "n_lines": lines,
                    "n_distinct": np.bincount((key // max(1, len(distinct))).astype(np.int64),
                                              minlength=len(texts)),
                }
                yield pa.RecordBatch.from_arrays(
                    [part[id_column], *(pa.array(counts[f].astype(np.int64)) for f in FEATURES)],
                    names=[id_column, *FEATURES])

    return in_batches(docs.select(id_column, text_column), run,
                      f"`{id_column}` {kind}, " + ", ".join(f"{f} long" for f in FEATURES))


def _vote(value: Column, good: Column, bad: Column) -> Column:
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The rules over the counts; each gives 1, -1 or 0."""
    def share(part: str, whole: str) -> Column:
        return F.col(part) / F.nullif(F.col(whole), F.lit(0))

    length = share("word_chars", "n_words")
    symbols = share("n_symbols", "n_words")
    lines = share("n_dup_lines", "n_lines")
    repeats = share("n_repeat_words", "n_words")
    capitals = share("n_capitals", "n_letters")
    stops = share("n_stops", "n_words")
    distinct = share("n_distinct", "n_words")
    return {
        "word_length": _vote(length, length.between(3, 9), ~length.between(2, 14)),
        "symbols": _vote(symbols, symbols < 0.02, symbols > 0.2),
        "line_repeats": _vote(lines, lines < 0.1, lines > 0.3),
        "word_repeats": _vote(repeats, repeats < 0.05, repeats > 0.25),
        "capitals": _vote(capitals, capitals < 0.12, capitals > 0.4),
        "short_words": _vote(stops, stops > 0.1, stops < 0.04),
        "variety": _vote(F.when(F.col("n_words") >= 50, distinct), distinct > 0.5, distinct < 0.3),
    }


def em(votes: np.ndarray, counts: np.ndarray, rounds: int = 500) -> tuple[np.ndarray, float, np.ndarray]:
    """Posterior of good for each combination of votes, the share of good texts, and for each
    rule and class (bad, good) how often its vote is good when it votes at all.

    An abstention says nothing. Starts from "bad if any rule says so", so class 1 is the one
    that good votes point to; one vote of either kind more than counted keeps shares off 0."""
    if not len(votes):
        return np.zeros(0), 0.5, np.zeros((0, 2))
    good, bad = (votes > 0).astype(float), (votes < 0).astype(float)
    posterior = np.where(bad.any(axis=1), 0.1, np.where(good.any(axis=1), 0.9, 0.5))
    for _ in range(rounds):
        of_class = np.stack([counts * (1 - posterior), counts * posterior])
        share = (of_class[1].sum() + 1) / (counts.sum() + 2)
        says_good = ((of_class @ good + 1) / (of_class @ (good + bad) + 2)).T
        logs = good @ np.log(says_good) + bad @ np.log(1 - says_good) + np.log([1 - share, share])
        after = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))
        moved = np.abs(after - posterior).max()
        posterior = after
        if moved < 1e-9:
            break
    return posterior, share, says_good


def judge(counted: DataFrame, votes: dict[str, Column] | None = None, limit: float = GOOD_LIMIT) -> DataFrame:
    """Adds `posterior` and `good` to rows of counts, by votes weighed over all the rows.
    `counted` is read twice: store it before."""
    votes = rules() if votes is None else votes
    names = list(votes)
    code = sum(((votes[n] + 1) * 3 ** i for i, n in enumerate(names)), F.lit(0)).cast("int")
    coded = counted.withColumn("_votes", code)
    seen = coded.groupBy("_votes").count().collect()  # at most 3 ** rules rows
    codes = np.array([r["_votes"] for r in seen], np.int64)
    each = np.stack([codes // 3 ** i % 3 - 1 for i in range(len(names))], axis=1) if len(codes) else np.zeros((0, len(names)))
    posterior, _, _ = em(each, np.array([r["count"] for r in seen], float))
    found = counted.sparkSession.createDataFrame(
        list(zip(codes.tolist(), posterior.tolist())), "_votes int, posterior double")
    return (coded.join(F.broadcast(found), "_votes", "left").drop("_votes")
            .withColumn("good", F.col("posterior") >= limit))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def quality(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, counts, base_failed, kept, posterior) of every text."""
    judged = judge(stored(features(docs, id_column, text_column), "quality_counts"))
    return judged.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & F.col("good"))
