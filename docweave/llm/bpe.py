"""Byte-level BPE encoding and decoding by a lazily determinised finite-state transducer.

A byte string has exactly one merge encoding, and a sequence of tokens is it just when every
two neighbours are the encoding of their joint bytes. So a nondeterministic transducer over
the token trie, which may end a token wherever that rule allows, has one accepting run. Its
subset construction is done on demand: a state is the set of trie positions still possible,
each with the token before it; each (state, byte) step is computed once per worker and tells
the one token that ends at that byte. Tokens are written up to where all positions of the state
agree, which lies a bounded number of bytes back (a long piece is written window by window).

NULL and empty texts have no ids. Equal texts have equal ids. Rows keep their id, NULL too.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from docweave.llm.chunks import MEMO_ENTRIES, ChunkEncoder
from docweave.llm.common import in_batches, slices, worker_cache

MAX_STATES = 300_000
MAX_JOINS = 400_000
MAX_PIECES = 60_000
SLICE_BYTES = 3 << 20
WINDOW = 4096
ROOT = 0


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank of each line of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Encoder of byte strings by merge ranks; `encode` of a whole piece gives its ids."""

    def __init__(self, ranks: dict[bytes, int], tables: float = 1.0):
        self.max_states, self.max_joins = int(MAX_STATES * tables), int(MAX_JOINS * tables)
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.child: dict[int, int] = {}
        self.token_at: list[int | None] = [None]
        self.depth = [0]
        self.inner = {ROOT}
        for token, rank in ranks.items():
            node = ROOT
            for byte in token:
                self.inner.add(node)
                below = self.child.setdefault(node << 8 | byte, len(self.depth))
                if below == len(self.depth):
                    self.token_at.append(None)
                    self.depth.append(self.depth[node] + 1)
                node = below
            self.token_at[node] = rank
        self.joins: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        start = ((ROOT, None),)
        self.states, self.number, self.steps = [start], {start: 0}, {}

    def merged(self, data: bytes) -> list[int]:
        """Merge the lowest rank first, leftmost first; for short strings only."""
        parts, ranks = [data[i:i + 1] for i in range(len(data))], self.ranks
        found = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
        while known := [r for r in found if r is not None]:
            at = found.index(min(known))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del found[at]
            if at < len(found):
                found[at] = ranks.get(parts[at] + parts[at + 1])
            if at:
                found[at - 1] = ranks.get(parts[at - 1] + parts[at])
        return [ranks[p] for p in parts]

    def may_follow(self, last: int | None, token: int) -> bool:
        """Whether the two tokens are the encoding of their joint bytes."""
        key = token if last is None else last + 1 << 32 | token
        known = self.joins.get(key)
        if known is None:
            if len(self.joins) > self.max_joins:
                self.joins.clear()
            expected = [token] if last is None else [last, token]
            known = self.merged(b"".join(self.bytes_of[t] for t in expected)) == expected
            self.joins[key] = known
        return known

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        """Next state, and the token that ends here in the encoding of what was read."""
        after, ended = [], None
        for node, last in self.states[state]:
            below = self.child.get(node << 8 | byte)
            if below is None:
                continue
            if below in self.inner:
                after.append((below, last))
            token = self.token_at[below]
            if ended is None and token is not None and self.may_follow(last, token):
                ended = token
        after.append((ROOT, ended))
        reached = tuple(after)
        number = self.number.setdefault(reached, len(self.states))
        if number == len(self.states):
            self.states.append(reached)
        self.steps[state << 8 | byte] = number, ended
        return number, ended

    def _back(self, ends: list[int], at: int) -> list[int]:
        """Tokens of the encoding that ends at a position, given the token that ends at each."""
        out, length = [], self.length
        while at:
            token = ends[at]
            out.append(token)
            at -= length[token]
        out.reverse()
        return out

    def _settled(self, ends: list[int], state: int) -> int:
        """The last position that the encoding passes whatever follows: where the ways back
        from all trie positions of the state meet."""
        starts = {len(ends) - 1 - self.depth[node] for node, _ in self.states[state]}
        while len(starts) > 1:
            last = max(starts)
            starts.remove(last)
            starts.add(last - self.length[ends[last]])
        return starts.pop()

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None or not piece:
            return [] if whole is None else [whole]
        if len(self.states) > self.max_states:
            self._forget()
        state, ends, written, known = 0, [0], [], self.steps.get
        for at in range(0, len(piece), WINDOW):
            for byte in piece[at:at + WINDOW]:
                state, ended = known(state << 8 | byte) or self._step(state, byte)
                ends.append(ended)
            settled = len(ends) - 1 if at + WINDOW >= len(piece) else self._settled(ends, state)
            written += self._back(ends, settled)
            ends[:settled + 1] = [0]
        return written


class TextEncoder:
    """Splits texts by the pattern and encodes each match; remembers short matches."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, tables: float = 1.0):
        self.transducer = Transducer(ranks, tables)
        self.max_pieces = int(MAX_PIECES * tables)
        self.pieces = regex.compile(pattern)
        self.memo: dict[str, list[int]] = {}

    def ids(self, text: str) -> bytes:
        out, memo = [], self.memo
        for piece in self.pieces.findall(text):
            found = memo.get(piece)
            if found is None:
                found = self.transducer.encode(piece.encode())
                if len(piece) <= 32:
                    if len(memo) > self.max_pieces:
                        memo.clear()
                    memo[piece] = found
            out += found
        return array("I", out).tobytes()

    def batch(self, texts: list[str], chunks: bool) -> tuple[np.ndarray, np.ndarray]:
        found = [self.ids(text) for text in texts]
        return np.frombuffer(b"".join(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found)) // 4


class Utf8Decoder:
    """Incremental UTF-8 decoder: `feed` gives the text certain so far and keeps at most
    three bytes back. Bad bytes become U+FFFD, one for each maximal bad part."""

    def __init__(self):
        self.held = b""

    @staticmethod
    def _open(tail: bytes) -> int:
        """Length of an unfinished sequence at the end. States: bytes still needed, and the
        range that the next one must lie in."""
        for start in range(max(0, len(tail) - 3), len(tail)):
            lead = tail[start]
            need, low, high = (
                (1, 0x80, 0xBF) if 0xC2 <= lead <= 0xDF else
                (2, 0xA0 if lead == 0xE0 else 0x80, 0x9F if lead == 0xED else 0xBF) if 0xE0 <= lead <= 0xEF else
                (3, 0x90 if lead == 0xF0 else 0x80, 0x8F if lead == 0xF4 else 0xBF) if 0xF0 <= lead <= 0xF4 else
                (0, 0, 0))
            for byte in tail[start + 1:]:
                if not low <= byte <= high or not need:
                    need = 0
                    break
                need, low, high = need - 1, 0x80, 0xBF
            if need:
                return len(tail) - start
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        keep = self._open(data)
        self.held = data[len(data) - keep:]
        return data[:len(data) - keep].decode("utf-8", "replace")

    def finish(self) -> str:
        text, self.held = self.held.decode("utf-8", "replace"), b""
        return text


class Vocabulary:
    """Bytes of all ids in one array, to decode by gathering."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.fromiter(map(len, tokens), np.int32, size)
        self.starts = (np.cumsum(self.lengths) - self.lengths).astype(np.int32)

    def bytes_of(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths, dtype=np.int32 if len(ids) < 1 << 24 else np.int64)
        shift = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.data[np.arange(len(shift), dtype=shift.dtype) + shift].tobytes()

    def stream(self, ids: np.ndarray, size: int = 65_536) -> Iterator[str]:
        """Text of the ids, piece by piece."""
        decoder = Utf8Decoder()
        for at in range(0, len(ids), size):
            yield decoder.feed(self.bytes_of(ids[at:at + size]))
        yield decoder.finish()


def _chunks(path: str, pattern: str, tables: float = 1.0) -> ChunkEncoder:
    return worker_cache(("bpe", path, pattern, tables), lambda: ChunkEncoder(
        TextEncoder(read_ranks(path), pattern, tables).batch, int(MEMO_ENTRIES * tables)))


def _vocabulary(path: str) -> Vocabulary:
    return worker_cache(("vocabulary", path), lambda: Vocabulary(read_ranks(path)))


def id_lists(ids: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int32)))


def encode(docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id",
           text_column: str = "text", tables: float = 1.0) -> DataFrame:
    """(id, ids array<int>) of every text; `ranks` is a rank file that each executor has. `tables` is
    the size of a worker's tables and slices: less takes less memory and more time."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        chunks = _chunks(ranks, pattern, tables)
        for batch in batches:
            for part in slices(batch, text_column, int(SLICE_BYTES * tables)):
                ids, starts = chunks(part[text_column])
                yield pa.RecordBatch.from_arrays([part[id_column], id_lists(ids, starts)],
                                                 names=[id_column, "ids"])

    return in_batches(docs.select(id_column, text_column), run, f"`{id_column}` {kind}, ids array<int>")


def decode(encoded: DataFrame, ranks: str, id_column: str = "doc_id") -> DataFrame:
    """(id, data binary, text) of every list of ids; a NULL list is an empty one."""
    kind = encoded.schema[id_column].dataType.simpleString()

    def run(batches):
        vocabulary = _vocabulary(ranks)
        for batch in batches:
            data, texts = [], []
            for ids in batch["ids"]:
                held = np.asarray(ids.values) if ids.is_valid and ids.values is not None else np.zeros(0, np.int32)
                data.append(vocabulary.bytes_of(held))
                texts.append("".join(vocabulary.stream(held)))
            yield pa.RecordBatch.from_arrays([batch[id_column], pa.array(data, pa.binary()), pa.array(texts)],
                                             names=[id_column, "data", "text"])

    return in_batches(encoded.select(id_column, "ids"), run,
                      f"`{id_column}` {kind}, data binary, text string")


def encode_and_decode(docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id",
                      text_column: str = "text") -> DataFrame:
    """Round trip of every text where it is read: (id, n_tokens, ids_sha256,
    decoded_sha256, same_text). Digests are of the decimal ids joined by spaces and of the
    decoded bytes; `same_text` tells whether the decoded text is the input."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        chunks = _chunks(ranks, pattern)
        vocabulary = _vocabulary(ranks)
        decimal = pa.array([str(i) for i in range(len(vocabulary.lengths))])
        for batch in batches:
            for part in slices(batch, text_column, SLICE_BYTES):
                texts = pc.fill_null(part[text_column], "")
                ids, starts = chunks(texts)
                written = pc.binary_join(pa.ListArray.from_arrays(
                    pa.array(starts.astype(np.int32)), decimal.take(pa.array(ids))), " ")
                ids_digest, data_digest, same = [], [], []
                for i, text in enumerate(texts):
                    own = ids[starts[i]:starts[i + 1]]
                    ids_digest.append(hashlib.sha256(written[i].as_buffer()).hexdigest())
                    digest, decoder = hashlib.sha256(), Utf8Decoder()
                    decoded = []
                    for at in range(0, len(own), 65_536):
                        data = vocabulary.bytes_of(own[at:at + 65_536])
                        digest.update(data)
                        decoded.append(decoder.feed(data))
                    decoded.append(decoder.finish())
                    data_digest.append(digest.hexdigest())
                    same.append("".join(decoded) == text.as_py())
                yield pa.RecordBatch.from_arrays(
                    [part[id_column], pa.array(np.diff(starts)), pa.array(ids_digest),
                     pa.array(data_digest), pa.array(same)],
                    names=[id_column, "n_tokens", "ids_sha256", "decoded_sha256", "same_text"])

    return in_batches(
        docs.select(id_column, text_column), run,
        f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, same_text boolean")
