"""Language identification by rank-order profiles of character n-grams.

A profile is the list of a language's most frequent 1- to 3-grams, counted over all training
texts. A text is ranked the same way; each of its most frequent n-grams adds the distance
between its rank there and in a language's profile ("out of place"), or the profile's length
where the profile lacks it. The language with the least sum wins; equal sums go to the first
in order of name.

N-grams are taken from words of letters, lower-cased, with a mark at either end of a word. They
are told apart by 31-bit hashes, alike in every task. A NULL text, or one without a letter, is
`und` with score 0. NULL ids stay, NULL languages teach nothing, and without any training text
every text is `und`. Profiles are as long as the parameter says, so what the driver holds and
sends out is languages x length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from docweave.llm.common import in_batches, mixed, raw, slices
from docweave.sources.storage import stored

PROFILE_LENGTH = 400
#: A text is near a profile that it stays this share or more below the greatest distance from. On sf0.1
#: every text with a letter has 0.40 or more, random letters 0.09 to 0.16, other scripts 0. A short profile can only
#: hold as many n-grams as it has, so the share is taken of those, and chance counts for more: the share that is
#: asked for rises to LEAST_NEAR_SHORT as profiles get shorter.
LEAST_NEAR, LEAST_NEAR_SHORT = 0.2, 0.5
UNDETERMINED = "und"
ORDERS = (1, 2, 3)
SLICE_BYTES = 1 << 18
_HASH_BITS = 31

_LOWER: np.ndarray | None = None


def lower_letters() -> np.ndarray:
    """For each code point: its lower case if it is a letter, else 0."""
    global _LOWER
    if _LOWER is None:
        _LOWER = np.zeros(0x110000, np.uint32)
        for point in range(0x110000):
            char = chr(point)
            if char.isalpha():
                low = char.lower()
                _LOWER[point] = ord(low) if len(low) == 1 else point
    return _LOWER


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys `text << 31 | n-gram hash` of every n-gram, and letters in each text."""
    data, starts = raw(texts)
    try:
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    except UnicodeDecodeError:  # bad bytes count as one mark each
        data = np.where(data < 128, data, 32).astype(np.uint8)
        points = data.astype(np.uint32)
    leads = (data & 0xC0) != 0x80
    ends = np.concatenate(([0], np.cumsum(leads)))[starts]
    letters = lower_letters()[points]
    text_of = np.repeat(np.arange(len(starts) - 1, dtype=np.int64), np.diff(ends))
    per_text = np.bincount(text_of[letters > 0], minlength=len(starts) - 1)
    # words of letters with one mark (0) between them; texts are parted by a mark as well
    first = np.zeros(len(points), bool)
    first[ends[:-1][np.diff(ends) > 0]] = True
    keep = letters > 0
    opens = keep & (first | ~np.concatenate(([False], keep[:-1])))
    at = np.flatnonzero(keep)
    place = np.arange(len(at)) + np.cumsum(opens[at])
    size = len(at) + int(opens.sum()) + 1
    line = np.zeros(size + 2, np.uint64)
    line[place] = letters[at]
    owner = np.zeros(size + 2, np.int64)
    owner[place] = text_of[at]
    word_start = np.flatnonzero(opens[at])
    owner[place[word_start] - 1] = text_of[at[word_start]]
    keys = []
    code = np.zeros(size, np.uint64)
    for order in ORDERS:
        code = code << np.uint64(21) | line[order - 1:order - 1 + size]
        # an n-gram lies within a mark, a word, and the mark after it
        middle = line[:size] > 0 if order == 1 else line[1:1 + size] > 0
        whole = np.flatnonzero(middle)
        spread = mixed(code[whole] + np.uint64(order << 62 & (1 << 64) - 1)) >> np.uint64(64 - _HASH_BITS)
        keys.append(owner[whole] << _HASH_BITS | spread.astype(np.int64))
    keys = np.concatenate(keys)
    keys.sort()
    return keys, per_text


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and how often each occurs."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.diff(np.append(at, len(keys)))


def train(docs: DataFrame, length: int = PROFILE_LENGTH, text_column: str = "text",
          lang_column: str = "lang") -> DataFrame:
    """(lang, gram, rank) of each language's profile, from all rows that have a language.
    N-grams are summed in each batch, in each task and then over all; frequent ones are equal
    in all languages, so no key holds more than one row for each batch."""
    def run(batches):
        for batch in batches:
            langs = np.array(batch[lang_column].to_pylist(), object)
            for lang in sorted(set(langs)):
                of_lang = batch.filter(pa.array(langs == lang))
                total: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.int64), np.zeros(0, np.int64))
                for part in slices(of_lang, text_column, SLICE_BYTES):
                    keys, _ = grams(part[text_column])
                    keys &= (1 << _HASH_BITS) - 1
                    keys.sort()
                    found, counts = counted(keys)
                    both = np.concatenate((total[0], found))
                    total_keys, back = np.unique(both, return_inverse=True)
                    total = total_keys, np.bincount(back, np.concatenate((total[1], counts)),
                                                    len(total_keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(total[0]), pa.string()), *map(pa.array, total)],
                    names=["lang", "gram", "n"])

    known = docs.select(F.col(lang_column).cast("string").alias(lang_column), text_column).where(
        F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    counts = in_batches(known, run, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= length).select("lang", "gram", "rank")


class Profiles:
    """Profiles as arrays: languages x n-grams."""

    def __init__(self, rows: list, length: int):
        self.length = length
        self.langs = sorted({r["lang"] for r in rows})
        self.grams = np.array(sorted({r["gram"] for r in rows}), np.int64)
        self.ranks = np.full((len(self.langs), len(self.grams) + 1), length, np.int32)
        at = {lang: i for i, lang in enumerate(self.langs)}
        for r in rows:
            self.ranks[at[r["lang"]], np.searchsorted(self.grams, r["gram"])] = r["rank"] - 1
        self.in_profile = self.ranks < length
        self.sizes = self.in_profile.sum(axis=1)
        self.least_near = LEAST_NEAR_SHORT - (LEAST_NEAR_SHORT - LEAST_NEAR) * self.sizes / length

    def distances(self, keys: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """Out-of-place sums (texts x languages), and how many n-grams of each text counted."""
        found, counts = counted(keys)
        text_of = found >> _HASH_BITS
        # rank within the text: more frequent first, then by hash
        most = np.int64(1) << 31
        order = np.argsort((text_of << 32) + (most - np.minimum(counts, most)), kind="stable")
        text_of = text_of[order]
        begin = np.searchsorted(text_of, np.arange(texts))
        rank = np.arange(len(order)) - begin[text_of]
        top = rank < self.length
        text_of, rank = text_of[top], rank[top]
        gram = found[order[top]] & ((1 << _HASH_BITS) - 1)
        place = np.searchsorted(self.grams, gram)
        hit = place < len(self.grams)
        hit[hit] = self.grams[place[hit]] == gram[hit]
        place[~hit] = len(self.grams)
        sums = np.empty((texts, len(self.langs)))
        for i in range(len(self.langs)):
            away = np.where(self.in_profile[i][place], np.abs(self.ranks[i][place] - rank), self.length)
            sums[:, i] = np.bincount(text_of, weights=away, minlength=texts)
        return sums, np.bincount(text_of, minlength=texts)


def predict(docs: DataFrame, profiles: DataFrame, length: int = PROFILE_LENGTH,
            id_column: str = "doc_id", text_column: str = "text", keep: tuple[str, ...] = (),
            usable: str | None = None) -> DataFrame:
    """(id, lang_pred, score) and the columns named in `keep`. `usable` names one more column: whether
    a text has a letter and is near any profile (each by its own limit, see LEAST_NEAR); when there is
    no profile at all, letters are enough. The score is the share of the
    greatest possible distance that the best language stays below, raised by the lead over the
    second language; 0 for `und`."""
    spark: SparkSession = docs.sparkSession
    known = spark.sparkContext.broadcast(Profiles(profiles.collect(), length))
    names = list(dict.fromkeys((id_column, text_column, *keep)))
    rest = [n for n in names if n != text_column or n in keep]
    schema = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in rest)

    def run(batches):
        held = known.value
        for batch in batches:
            for part in slices(batch, text_column, SLICE_BYTES):
                keys, letters = grams(part[text_column])
                langs = np.full(len(part), UNDETERMINED, object)
                score = np.zeros(len(part))
                good = letters > 0
                if held.langs:
                    sums, counted_grams = held.distances(keys, len(part))
                    near = 1 - sums / np.maximum(1, counted_grams * held.length)[:, None]
                    best = np.argmin(sums, axis=1)
                    some = letters > 0
                    langs[some] = np.array(held.langs, object)[best[some]]
                    lead = np.partition(near, -2, axis=1)[:, -2] if len(held.langs) > 1 else np.zeros(len(part))
                    top = near[np.arange(len(part)), best]
                    reach = np.minimum(held.sizes[None, :], counted_grams[:, None]) / np.maximum(1, counted_grams)[:, None]
                    good &= (near >= held.least_near * reach).any(axis=1)
                    score[some] = np.clip(top + (1 - top) * (top - lead), 0, 1)[some]
                yield pa.RecordBatch.from_arrays(
                    [*(part[n] for n in rest), pa.array(langs, pa.string()), pa.array(score),
                     *([pa.array(good)] if usable else [])],
                    names=[*rest, "lang_pred", "score", *([usable] if usable else [])])

    return in_batches(docs.select(*names), run, f"{schema}, lang_pred string, score double" + (
        f", `{usable}` boolean" if usable else ""))


def stored_profiles(docs: DataFrame, length: int = PROFILE_LENGTH) -> DataFrame:
    return stored(train(docs, length), "language_profiles")
