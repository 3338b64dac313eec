"""Toxicity by a weighted lexicon matched with an Aho-Corasick automaton.

Texts are folded first: lower case, letters of other scripts and accented ones to the Latin
letter they look like, digits and signs that stand for letters between letters to those letters. The lexicon
is learned: words and stems (word beginnings) of labelled texts that occur far more often in
toxic ones, each weighted by its log odds; texts that share the least hash of their word pairs,
as copies do, count once. A word counts only as a whole, a stem only at the start of a word, and
neither inside an exception phrase: two neighbouring words, one of them an entry, that occur
together mostly in clean texts. The sum of weights, and the sum for each hundred words, go
through a logistic curve fitted on the same labels.

Fitting reads at most about `fit_rows` labelled rows, chosen by a hash of the id; scoring covers
every whole text. A NULL or empty text scores as one without a match. Labels that are NULL
teach nothing; if no label of either kind exists, every score is 0. NULL and repeated ids stay.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from docweave.llm.common import in_batches
from docweave.sources.storage import stored

FIT_ROWS = 20_000
LIMIT = 0.3
MIN_TOXIC_TEXTS = 3
MIN_TOXIC_SHARE = 0.005
MIN_LOG_ODDS = 2.5
STEM_LENGTHS = range(4, 9)
END = "$"  # marks an entry that is a whole word

# Characters that look like a Latin letter, by letter.
LOOKALIKES = {
    "a": "аáàâäãåāăąα@", "b": "ьвβ", "c": "сçćčϲ", "d": "ԁďđ", "e": "еéèêëēėęěε€", "g": "ɡğģ",
    "h": "һħ", "i": "іíìîïīįıι¡", "j": "јĵ", "k": "кκķ", "l": "ӏłļľ|", "m": "мμ", "n": "ոñńňņη",
    "o": "оóòôöõōőøοσ", "p": "рρ", "q": "ԛ", "r": "гŕř", "s": "ѕśšşș$", "t": "тτťţț",
    "u": "υúùûüūůűų", "v": "ѵν", "w": "ԝωŵ", "x": "хχ", "y": "уýÿγ", "z": "ʐźžż",
}
# Digits and signs that stand for a letter.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "!": "i", "+": "t"}

_SAME = {ord(c): letter for letter, others in LOOKALIKES.items() for c in others}
_SAME |= {0xFF21 + i: chr(97 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)}
_SAME |= {ord(c): None for c in "​‌‍⁠﻿­"}
_NUMERIC = re.compile(r"[0-9!+]+")
_SWAP = {ord(d): letter for d, letter in DIGITS.items()}
_WORD = re.compile(r"[a-z]+")


def fold(text: str) -> str:
    """Lower case and Latin letters only where others stand for them. Digits and signs are
    replaced where a letter precedes and follows the run, or touches it for digits alone."""
    text = text.lower().translate(_SAME)

    def swap(found: re.Match) -> str:
        before = found.start() > 0 and text[found.start() - 1].isalpha()
        after = found.end() < len(text) and text[found.end()].isalpha()
        run = found.group()
        return run.translate(_SWAP) if before and after or (before or after) and run.isdigit() and len(run) < 3 else run

    return _NUMERIC.sub(swap, text) if _NUMERIC.search(text) else text


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: set[str] = field(default_factory=set)
    curve: tuple[float, float, float] = (-30.0, 0.0, 0.0)


class Matcher:
    """The lexicon as an automaton, built once for a task's texts."""

    def __init__(self, lexicon: Lexicon):
        self.curve = np.array(lexicon.curve)
        self.automaton = ahocorasick.Automaton()
        for entry, weight in sorted(lexicon.weights.items()):  # a whole word after its stem
            self.automaton.add_word(entry.rstrip(END), (len(entry.rstrip(END)), weight, entry.endswith(END)))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(phrase, (len(phrase), 0.0, True))
        if len(self.automaton):
            self.automaton.make_automaton()

    def matches(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight) of the entries that count in a folded text, in order."""
        if not len(self.automaton):
            return []
        found, free = [], []
        for last, (length, weight, whole) in self.automaton.iter(folded):
            start, end = last - length + 1, last + 1
            if start and folded[start - 1].isalpha() or whole and end < len(folded) and folded[end].isalpha():
                continue
            (found if weight else free).append((start, end, weight))
        if free:
            found = [m for m in found if not any(a <= m[0] and m[1] <= b for a, b, _ in free)]
        return found

    def measures(self, text: str) -> tuple[float, float, int]:
        """Sum of weights (a repeated match adds the logarithm of its number), the sum for each
        hundred words (at least 20), and the number of matches."""
        folded = fold(text)
        found = self.matches(folded)
        counts = Counter((folded[start:end], weight) for start, end, weight in found)
        total = math.fsum(weight * (1 + math.log(n)) for (_, weight), n in counts.items())
        return total, 100 * total / max(20, text.count(" ") + text.count("\n") + 1), len(found)

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Score and number of matches of each text."""
        total, rate, n = np.array([self.measures(t) for t in texts], float).reshape(-1, 3).T
        z = self.curve[0] + _points(total, rate) @ self.curve[1:]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500))), n


def _kin(words: list[str]) -> int:
    """Least hash of the neighbouring words: mostly alike in near copies."""
    return min((zlib.crc32(f"{a} {b}".encode()) for a, b in zip(words, words[1:])), default=0)


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps, with a small ridge."""
    design = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        ridge = np.diag([1e-3, 1e-2, 1e-2])
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + ridge,
                               design.T @ (y - p) - ridge @ beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(beta.tolist())


def _points(total: np.ndarray, rate: np.ndarray) -> np.ndarray:
    return np.column_stack([np.log1p(total), np.log1p(rate)])


def _features(words: list[str]) -> set[str]:
    """Whole words (marked) and stems of a text."""
    distinct = {w for w in words if len(w) >= 3}
    return {w + END for w in distinct} | {w[:n] for w in distinct for n in STEM_LENGTHS if n <= len(w)}


def choose(odds: dict[str, float], support: dict[str, int]) -> dict[str, float]:
    """Of entries that begin alike, the most specific one with the same support, and no longer
    entry beside a stem of about its weight."""
    longer: dict[str, int] = {}
    for entry in odds:
        for n in range(1, len(entry)):
            longer[entry[:n]] = max(longer.get(entry[:n], 0), support[entry])
    kept: dict[str, float] = {}
    for entry in sorted(odds, key=lambda e: (len(e), e)):
        if longer.get(entry, 0) >= 0.95 * support[entry]:
            continue
        if any(kept.get(entry[:n], -1e9) >= odds[entry] - 1 for n in range(1, len(entry))):
            continue
        kept[entry] = odds[entry]
    return kept


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, id_column: str = "doc_id",
        text_column: str = "text", label_column: str = "toxic") -> Lexicon:
    """Learn entries, weights, exceptions and the curve from labelled rows."""
    known = (labels.where(F.col(label_column).isin(0, 1)).groupBy(id_column)
             .agg(F.max(label_column).cast("int").alias("label")))
    share = int(min(1.0, fit_rows / max(1, known.count())) * 1_000_000)
    chosen = known.where(F.pmod(F.xxhash64(id_column), F.lit(1_000_000)) < share)

    def with_kin(batches):
        for batch in batches:
            texts = pc.fill_null(batch[text_column], "")
            kin = [_kin(_WORD.findall(fold(t))) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["label"], texts, pa.array(kin, pa.int64())],
                                             names=["label", "text", "kin"])

    texts = stored(in_batches(docs.select(id_column, text_column).join(chosen, id_column)
                              .select(text_column, "label"), with_kin, "label int, text string, kin long"),
                   "toxicity_fit")
    size = {r["label"]: r["n"] for r in
            texts.groupBy("label").agg(F.count_distinct("kin").alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        return Lexicon()

    def counted(rows: DataFrame, find) -> DataFrame:
        """How many unlike texts of either label show each entry that `find` sees in a text."""
        def run(batches):
            for batch in batches:
                found = [sorted(find(t)) for t in batch["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch["label"], batch["kin"], pa.array(found, pa.list_(pa.string()))],
                    names=["label", "kin", "entries"])

        each = in_batches(rows, run, "label int, kin long, entries array<string>")
        kin = F.col("kin")
        return (each.select("label", "kin", F.explode("entries").alias("entry")).groupBy("entry")
                .agg(F.count_distinct(F.when(F.col("label") == 1, kin)).alias("t"),
                     F.count_distinct(F.when(F.col("label") == 0, kin)).alias("c")))

    least = max(MIN_TOXIC_TEXTS, MIN_TOXIC_SHARE * toxic)
    support = {r["entry"]: r["t"] for r in counted(
        texts.where("label = 1"), lambda t: _features(_WORD.findall(fold(t)))).where(F.col("t") >= least).collect()}
    candidates = frozenset(support)
    in_clean = {r["entry"]: r["c"] for r in counted(
        texts.where("label = 0"), lambda t: _features(_WORD.findall(fold(t))) & candidates).collect()}
    odds = {e: round(math.log((t + 0.1) / (toxic + 0.2) / ((in_clean.get(e, 0) + 0.1) / (clean + 0.2))), 6)
            for e, t in support.items()}
    lexicon = Lexicon(choose({e: w for e, w in odds.items() if w >= MIN_LOG_ODDS}, support))

    def pairs(text: str) -> set[str]:
        """The two neighbouring words around each match."""
        text = fold(text)
        found = set()
        for start, end, _ in Matcher(lexicon).matches(text) if any_entry.search(text) else ():
            before = _WORD.findall(text[max(0, start - 40):start])[-1:]
            own, *after = _WORD.findall(text[start:end + 80])[:2]
            found |= {f"{a} {b}" for a, b in zip(before + [own], [own] + after)}
        return found

    if lexicon.weights:
        any_entry = re.compile("|".join(re.escape(e.rstrip(END)) for e in sorted(lexicon.weights)))
        lexicon.exceptions = {r["entry"] for r in counted(texts, pairs).where(
            (F.col("c") >= 5) & (F.col("c") > 3 * F.col("t") * clean / toxic)).collect()}

    def measure(batches):
        matcher = Matcher(lexicon)
        for batch in batches:
            found = [matcher.measures(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["label"], pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.float64())],
                names=["label", "total", "rate"])

    points = in_batches(texts.select("label", "text"), measure, "label int, total double, rate double").toArrow()
    lexicon.curve = _fit_curve(_points(np.asarray(points["total"]), np.asarray(points["rate"])),
                               np.asarray(points["label"]).astype(float))
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon, id_column: str = "doc_id", text_column: str = "text",
          keep: tuple[str, ...] = (), limit: float = LIMIT) -> DataFrame:
    """(id, columns of `keep`, score, predicted, n_matches) of every whole text."""
    names = list(dict.fromkeys((id_column, *keep)))
    schema = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names)
    known = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches):
        matcher = Matcher(known.value)
        for batch in batches:
            p, n = matcher.scores(pc.fill_null(batch[text_column], "").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(p), pa.array((p >= limit).astype(np.int32)),
                 pa.array(n.astype(np.int64))], names=[*names, "score", "predicted", "n_matches"])

    return in_batches(docs.select(*names, text_column), run,
                      f"{schema}, score double, predicted int, n_matches long")
