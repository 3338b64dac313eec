"""Encode whole texts through a table of their distinct pieces.

The split pattern of the byte-level vocabularies surely starts a new match at some places,
whatever stands around: at a space after another character, after a letter that no letter
follows, and after a lone line end. So a text may be cut there, each distinct piece (with its
leading space) encoded once, and the results gathered by numpy. Places that would need more of
the text to decide are not cut, so a piece may be long."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from docweave.llm.common import encoded, raw, spans, strings

MEMO_ENTRIES = 400_000
LONGEST = 64  # bytes of pieces that are remembered
#: Space characters beyond ASCII, as UTF-8 bytes in one number.
SPACES2 = np.array([0xC285, 0xC2A0])
SPACES3 = np.array([0xE19A80, 0xE1A08E, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])
#: First bytes of UTF-8 space characters beyond ASCII.
SPACE_LEADS = (0xC2, 0xE1, 0xE2, 0xE3)
_SPACE = np.array([b == 32 or 9 <= b <= 13 or 28 <= b <= 31 for b in range(256)])
_LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])
_SIGN = np.array([b < 128 and not chr(b).isalpha() and b != 32 for b in range(256)])
#: First bytes of two-byte characters that are letters: Latin (but the two of _NO_LETTER) and Cyrillic.
_LETTER_LEAD = np.array([0xC3 <= b <= 0xC9 or 0xD0 <= b <= 0xD1 for b in range(256)])
_NO_LETTER = np.array([0xC397, 0xC3B7])


def _joint(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The `width` bytes from each place on, as one number."""
    out = np.zeros(len(at), np.int64)
    for k in range(width):
        out = out << 8 | data[np.clip(at + k, 0, len(data) - 1)]
    return out


def space_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place (beyond 0) is a space."""
    last = data[at - 1]
    out = _SPACE[last]
    if (beyond := np.flatnonzero(last >= 128)).size:
        some = at[beyond]
        out[beyond] = np.isin(_joint(data, some - 2, 2), SPACES2) | np.isin(_joint(data, some - 3, 3), SPACES3)
    return out


def space_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that starts at each place is a space."""
    first = data[at]
    out = _SPACE[first]
    if (beyond := np.flatnonzero(first >= 0xC2)).size:
        some = at[beyond]
        out[beyond] = np.isin(_joint(data, some, 2), SPACES2) | np.isin(_joint(data, some, 3), SPACES3)
    return out


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pieces start: at each text that is not empty, and inside texts."""
    mark = np.zeros(len(data), bool)
    at = np.flatnonzero(data[1:] == 32) + 1
    mark[at[~space_before(data, at)]] = True
    at = np.flatnonzero(_SIGN[data[1:]]) + 1
    letter, lead = _LETTER[data[at - 1]], _LETTER_LEAD[data[at - 2]] & (data[at - 1] >= 128) & (at >= 2)
    lead[lead] = ~np.isin(_joint(data, at[lead] - 2, 2), _NO_LETTER)
    mark[at[letter | lead]] = True
    at = np.flatnonzero(data[:-1] == 10) + 1
    at = at[at >= 2]
    lone = (data[at - 2] < 128) & ~_SPACE[data[at - 2]]
    mark[at[lone & ~space_at(data, at)]] = True
    mark[starts[:-1][starts[:-1] < len(data)]] = True
    return np.flatnonzero(mark)


def parted_oddly(chunks: pa.Array, held: list[str]) -> np.ndarray:
    """Which chunks are empty or have a space character at either end."""
    data, starts = raw(chunks)
    odd = np.diff(starts) == 0
    first = data[np.minimum(starts[:-1], len(data) - 1)] if len(data) else np.zeros(len(odd), np.uint8)
    last = data[np.maximum(starts[1:] - 1, 0)] if len(data) else first
    ascii_space = lambda b: (b == 32) | (b >= 9) & (b <= 13) | (b >= 28) & (b <= 31)
    odd |= ascii_space(first) | ascii_space(last)
    for i in np.flatnonzero(~odd & (np.isin(first, SPACE_LEADS) | (last >= 128))):
        odd[i] = held[i][0].isspace() or held[i][-1].isspace()
    return odd


class _Table:
    """Pieces seen and their ids, packed."""

    def __init__(self):
        self.names = pa.array([], pa.string())
        self.ids, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.uses = np.zeros(0, np.int32)

    def find(self, pieces: pa.Array) -> np.ndarray:
        """Number of each piece, or -1."""
        return np.asarray(pc.fill_null(pc.index_in(pieces, value_set=self.names), -1)).astype(np.int64)

    def add(self, pieces: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.names = pa.concat_arrays([self.names, pieces])
        self.ids = np.concatenate((self.ids, ids))
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(sizes)))
        self.uses = np.concatenate((self.uses, np.zeros(len(pieces), np.int32)))

    def shrink(self, n: int) -> None:
        """Keep the n pieces that most batches had, and count anew."""
        kept = np.sort(np.argsort(-self.uses, kind="stable")[:n])
        sizes = np.diff(self.starts)[kept]
        self.names = self.names.take(pa.array(kept))
        self.ids = self.ids[spans(self.starts[kept], sizes)]
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.uses = np.zeros(len(kept), np.int32)


class ChunkEncoder:
    """`encode(texts, joint)` gives the ids of a list of texts one after the other and the number of each. `joint` tells
    how texts may be joined to be encoded as one: " ", as they are, for each begins with a space and neither
    goes on nor ends with one; "\\n", with that between them, for none begins or ends with a space; "", not at all.

    A table maps pieces seen in this worker to ids. When it is full, the less used half goes; it bounds memory
    and never changes a result."""

    def __init__(self, encode: Callable[[list[str], str], tuple[np.ndarray, np.ndarray]], entries: int | None = None):
        self.encode = encode
        self.entries = entries or MEMO_ENTRIES
        self.table = _Table()

    def _new(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """An order of the pieces, with long ones last; in that order all ids and the number of each; and how many are short."""
        data, starts = raw(pieces)
        sizes = np.diff(starts)
        full = np.flatnonzero(sizes > 0)
        kind = np.zeros(len(pieces), np.int8)  # 0: by itself, 1: with a space before, 2: bare
        first, last = starts[:-1][full], starts[1:][full]
        ends = ~space_before(data, last)
        led = (data[first] == 32) & (sizes[full] > 1)
        led[led] = ~space_at(data, first[led] + 1)
        kind[full[ends & led]] = 1
        kind[full[ends & ~space_at(data, first)]] = 2
        long = sizes > LONGEST
        kind[long] = 0
        order, ids, counts = [], [], []
        for some, joint in ((kind == 1, " "), (kind == 2, "\n"), ((kind == 0) & ~long, ""), (long, "")):
            at = np.flatnonzero(some)
            if len(at):
                found, n = self.encode(pieces.take(pa.array(at)).to_pylist(), joint)
                order, ids, counts = order + [at], ids + [found], counts + [n]
        return np.concatenate(order), np.concatenate(ids), np.concatenate(counts), int((~long).sum())

    def ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An array of ids, where the ids of each of the pieces, all distinct, start in it, and how many they are."""
        table = self.table
        if len(table.names) > self.entries:
            table.shrink(self.entries // 2)
        at = table.find(pieces)
        new, more, extra = np.flatnonzero(at < 0), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(new):
            order, ids, counts, short = self._new(pieces.take(pa.array(new)))
            at[new[order]] = len(table.names) + np.arange(len(new))
            n = int(counts[:short].sum())
            table.add(pieces.take(pa.array(new[order[:short]])), ids[:n], counts[:short])
            more, extra = ids[n:], counts[short:]
        table.uses[at[at < len(table.names)]] += 1
        begins = np.concatenate((table.starts, table.starts[-1] + np.cumsum(extra)))
        return np.concatenate((table.ids, more)) if len(more) else table.ids, begins[at], np.diff(begins)[at]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's ids start."""
        data, starts = raw(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(starts), np.int64)
        at = cuts(data, starts)
        distinct, codes = encoded(strings(data, np.append(at, len(data))))
        held, begins, lengths = self.ids(distinct)
        each = lengths[codes]
        before = np.concatenate(([0], np.cumsum(each)))
        return held[spans(begins[codes], each)], before[np.searchsorted(at, starts)]
