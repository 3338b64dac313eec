"""Alignment of two tokenizers over whole texts, scored by inverted pair bitmaps.

Both tokenizers encode a space and the text. Tokens of A and B whose byte ranges overlap are linked, and offsets
where tokens of both end cut the text into groups. NULL and empty texts, and texts whose bytes one of the
tokenizers does not give back, have no tokens: zeros and an empty digest. Repeated rows and NULL ids stay rows of
their own.

A document has a place: a block of at most 65,536 documents (a shard and a running number) and an offset
in it. For each pair of linked ids, and each block, the documents are held as bitmaps: plane j holds the documents
whose number of links of that pair has bit j set. A bitmap is a sorted list of 16-bit offsets, or 8 KB of bits from
`DENSE` documents on. Encoding tasks emit partial bitmaps; those of a block and pair are OR-merged; the popcount of a
plane, times 2^j, counts links, and that of all planes together counts documents. Sums over blocks give
each pair's counts. As postings, the bitmaps then take those counts back to their documents, one block at a time.

Neither tokenizer merges across a single space between other characters, so such texts are aligned
through a table of distinct space-separated chunks; all other texts are aligned whole."""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from docweave.llm.chunks import parted_oddly
from docweave.llm.common import encoded, in_batches, per_text, slices, spans, worker_cache
from docweave.llm.token_files import LibraryEncoder
from docweave.sources.storage import stored

BLOCK = 1 << 16        # documents whose offsets fit into 16 bits
BITMAP_BYTES = BLOCK // 8
DENSE = BITMAP_BYTES // 2  # so many offsets take as much room as the bits
TEXT_BYTES = 4 * 1024 * 1024
MEMO_ENTRIES = 400_000
JOINED = 512           # chunks encoded as one text
AT_ONCE = 100_000      # chunks aligned in one step


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others
    for the bytes left over, in order, from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class Aligner:
    """Aligns lists of texts; `table` of each tokenizer holds the bytes of every id."""

    def __init__(self, a_path: str, b_path: str):
        self.a = LibraryEncoder(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        of = byte_characters()
        names = [self.a.tokenizer.id_to_token(i) or "" for i in range(self.a.tokenizer.get_vocab_size())]
        a_bytes = [bytes(of[c] for c in n) if all(c in of for c in n) else n.encode() for n in names]
        size = self.b.get_piece_size()
        b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                   else self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(size)]
        self.tables = a_bytes, b_bytes
        self.lengths = [np.array([len(t) for t in table], np.int64) for table in self.tables]
        # a vocabulary with a space inside a piece, after other characters, could merge across chunks
        self.cuts = not any(b" " in t.lstrip(b" ") for t in b_bytes)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.counts = np.zeros((0, 3), np.int64)   # tokens of A, tokens of B, groups
        self.links = np.zeros(0, np.int64)         # pairs a << 32 | b of all entries, one after the other
        self.starts = np.zeros(1, np.int64)
        self.groups: list[bytes | None] = []       # None where the bytes differ

    def add(self, texts: list[str], chunks: bool = False) -> None:
        """Align each text as a whole and append it as an entry. Chunks neither begin nor end with a space
        character, so many of them may be encoded as one text."""
        for at in range(0, len(texts), AT_ONCE):
            part = texts[at:at + AT_ONCE]
            whole = [(" " + t).encode() for t in part]
            self._align(whole, [self._first(part, whole, chunks), _flat(self.b.encode(part, num_threads=1))])

    def _first(self, texts: list[str], whole: list[bytes], chunks: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of tokenizer A and their number for each text."""
        run = JOINED if chunks else 1
        joined = [" " + " ".join(texts[i:i + run]) for i in range(0, len(texts), run)]
        ids, sizes = _flat([self.a.tokenizer.encode_batch_fast([t], add_special_tokens=False)[0].ids for t in joined])
        if chunks:  # cut where the chunks' bytes end
            ends = np.cumsum(np.fromiter(map(len, whole), np.int64, len(whole)))
            stops = np.searchsorted(np.cumsum(self.lengths[0][ids]), ends, side="left") + 1
            sizes = np.diff(stops, prepend=0)
        return ids, sizes

    def _align(self, whole: list[bytes], sides: list[tuple[np.ndarray, np.ndarray]]) -> None:
        good = np.ones(len(whole), bool)
        joined = b"".join(whole)
        for (ids, sizes), table in zip(sides, self.tables):
            held = list(map(table.__getitem__, ids.tolist()))
            if b"".join(held) != joined:
                stops = np.cumsum(sizes).tolist()
                good &= [b"".join(held[x:y]) == w for x, y, w in zip([0, *stops], stops, whole)]
        if not good.all():  # texts that do not come back have no tokens
            sides = [(ids[np.repeat(good, sizes)], np.where(good, sizes, 0)) for ids, sizes in sides]
        flat, sizes = zip(*sides)
        a_ends, b_ends = (np.cumsum(length[ids]) for length, ids in zip(self.lengths, flat))
        # each stretch between two ends lies in one token of either side: one link
        ends = np.sort(np.concatenate((a_ends, b_ends)), kind="stable")
        again = ends[1:] == ends[:-1]
        common, ends = ends[1:][again], ends[np.append(~again, True)] if len(ends) else ends
        a_at, b_at = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        owner = np.repeat(np.arange(len(whole)), sizes[0])
        n_links = np.bincount(owner[a_at], minlength=len(whole))
        n_groups = np.bincount(owner[np.searchsorted(a_ends, common)], minlength=len(whole))
        self.links = np.concatenate((self.links, flat[0][a_at] << 32 | flat[1][b_at]))
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(n_links)))
        self.counts = np.concatenate((self.counts, np.column_stack((*sizes, n_groups))))
        data, offsets = _group_texts(flat, [np.searchsorted(common, e) for e in (a_ends, b_ends)])
        cuts = offsets[np.concatenate(([0], np.cumsum(sizes[0] + sizes[1])))].tolist()
        self.groups += [data[x:y - 1] if ok else None for x, y, ok in zip(cuts, cuts[1:], good.tolist())]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """(counts of each text, links of all texts, where each text's links start, digest of each text's groups)."""
        if len(self.known) > MEMO_ENTRIES:
            self.clear()
        texts = pc.fill_null(texts, "")
        parts = pc.split_pattern(texts, " ")
        begins = np.asarray(parts.offsets).astype(np.int64)
        distinct, codes = encoded(parts.values)
        names = distinct.to_numpy(zero_copy_only=False)
        plain = (per_text(parted_oddly(distinct, names)[codes], begins) == 0) & self.cuts
        used = np.zeros(len(names), bool)
        used[codes[np.repeat(plain, np.diff(begins))]] = True
        entry = np.full(len(names), -1, np.int64)
        wanted = names[used].tolist()
        new = [n for n in wanted if n not in self.known]
        base = len(self.groups)
        self.add(new, chunks=True)
        for i, n in enumerate(new):
            self.known[n] = base + i
        entry[used] = [self.known[n] for n in wanted]
        bad = np.zeros(len(names), bool)
        bad[used] = self.counts[entry[used], 0] == 0  # a chunk whose bytes do not come back
        plain &= per_text(bad[codes], begins) == 0
        # texts aligned whole are entries after all others, and are forgotten again
        kept = len(self.groups), len(self.links)
        whole = ~plain & (np.asarray(pc.binary_length(texts)) > 0)
        self.add(texts.filter(pa.array(whole)).to_pylist())
        entries = np.where(np.repeat(plain, np.diff(begins)), entry[codes], -1)
        first = begins[:-1][whole]
        entries[first] = kept[0] + np.arange(len(first))
        held = np.where(plain, np.diff(begins), whole.astype(np.int64))
        entries = entries[entries >= 0]
        starts = np.concatenate(([0], np.cumsum(held)))
        n_links = np.diff(self.starts)[entries]
        links = self.links[spans(self.starts[entries], n_links)]
        link_starts = np.concatenate(([0], np.cumsum(n_links)))[starts]
        counts = np.column_stack([per_text(self.counts[entries, c], starts) for c in range(3)])
        digests = []
        listed, groups = entries.tolist(), self.groups
        for x, y, n in zip(starts[:-1].tolist(), starts[1:].tolist(), counts[:, 0].tolist()):
            digests.append(hashlib.sha256(b";".join([groups[e] for e in listed[x:y]])).hexdigest() if n else "")
        del self.groups[kept[0]:]
        self.counts, self.links = self.counts[:kept[0]], self.links[:kept[1]]
        self.starts = self.starts[:kept[0] + 1]
        return counts, links, link_starts, digests


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers one after the other, and the length of each list."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


def _group_texts(ids: list[np.ndarray], groups: list[np.ndarray]) -> tuple[bytes, np.ndarray]:
    """`a1,a2|b1;` of all groups in order, and where each token's text starts (one more at the end)."""
    value, group = np.concatenate(ids), np.concatenate(groups)
    side = np.repeat([0, 1], [len(i) for i in ids])
    order = np.argsort(group * 2 + side, kind="stable")
    value, group, side = value[order], group[order], side[order]
    if not len(value):
        return b"", np.zeros(1, np.int64)
    next_group, next_side = np.append(group[1:], -1), np.append(side[1:], -1)
    mark = np.where(next_group != group, 2, np.where(next_side != side, 1, 0))
    marks = pa.array([",", "|", ";"]).take(pa.array(mark))
    texts = pc.binary_join_element_wise(pa.array(value).cast(pa.string()), marks, "")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[:len(texts) + 1].astype(np.int64)
    return texts.buffers()[2].to_pybytes(), offsets


def pack(group: np.ndarray, offset: np.ndarray, n: int) -> pa.Array:
    """One bitmap for each of n groups, from offsets sorted by group and then by size."""
    sizes = np.bincount(group, minlength=n)
    ends = np.cumsum(sizes)
    data = offset.astype("<u2").tobytes()
    if sizes.max(initial=0) < DENSE:
        return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(
            np.concatenate(([0], 2 * ends)).astype(np.int32)), pa.py_buffer(data)])
    out = []
    for size, end in zip(sizes.tolist(), ends.tolist()):
        if size < DENSE:
            out.append(data[2 * (end - size):2 * end])
        else:
            bits = np.zeros(BLOCK, np.uint8)
            bits[offset[end - size:end]] = 1
            out.append(np.packbits(bits).tobytes())
    return pa.array(out, pa.binary())


def unpack(bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, offset) of every document of a column of bitmaps."""
    if isinstance(bitmaps, pa.ChunkedArray):
        bitmaps = bitmaps.combine_chunks()
    sizes = np.asarray(pc.binary_length(bitmaps)).astype(np.int64)
    dense = sizes == BITMAP_BYTES
    sparse = bitmaps.filter(pa.array(~dense)) if dense.any() else bitmaps
    starts = np.frombuffer(sparse.buffers()[1], np.int32)[sparse.offset:sparse.offset + len(sparse) + 1] if len(sparse) else [0, 0]
    data = sparse.buffers()[2] if len(sparse) else None
    flat = np.frombuffer(data, np.uint8)[starts[0]:starts[-1]].view("<u2") if data is not None else np.zeros(0, np.uint16)
    rows = np.repeat(np.flatnonzero(~dense), sizes[~dense] // 2)
    offsets = flat.astype(np.int64)
    for row in np.flatnonzero(dense):
        found = np.flatnonzero(np.unpackbits(np.frombuffer(bitmaps[row].as_py(), np.uint8)))
        rows, offsets = np.concatenate((rows, np.full(len(found), row))), np.concatenate((offsets, found))
    return rows, offsets


def encode(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Align every text. Rows of two kinds, stored in one table: a document (`n_a` is not NULL) with its place, counts
    and digest, and a partial bitmap (`plane` is not NULL) of one pair in one block."""
    kind = docs.schema[id_column].dataType.simpleString()
    schema = (f"block long, at int, `{id_column}` {kind}, n_a long, n_b long, n_groups long, n_links long, "
              "groups_sha256 string, a int, b int, plane int, bits binary")
    names = ["block", "at", id_column, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "plane", "bits"]
    types = [pa.int64(), pa.int32(), None, *[pa.int64()] * 4, pa.string(), *[pa.int32()] * 3, pa.binary()]

    def rows(n, id_type, columns):
        return pa.RecordBatch.from_arrays(
            [columns[c] if c in columns else pa.nulls(n, t or id_type) for c, t in zip(names, types)], names=names)

    def run(batches):
        aligner = worker_cache(("align", a_path, b_path), lambda: Aligner(a_path, b_path))
        shard, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, text_column, TEXT_BYTES):
                while len(part):
                    now, part = part.slice(0, BLOCK - seen % BLOCK), part.slice(BLOCK - seen % BLOCK)
                    block, at = shard << 24 | seen >> 16, seen % BLOCK
                    counts, links, starts, digests = aligner(now[text_column])
                    n, id_type = len(now), now[id_column].type
                    yield rows(n, id_type, {
                        "block": pa.array(np.full(n, block)), "at": pa.array(np.arange(at, at + n, dtype=np.int32)),
                        id_column: now[id_column], "n_a": pa.array(counts[:, 0]), "n_b": pa.array(counts[:, 1]),
                        "n_groups": pa.array(counts[:, 2]), "n_links": pa.array(np.diff(starts)),
                        "groups_sha256": pa.array(digests, pa.string())})
                    for pair, plane, bits in _planes(links, starts, at):
                        m = len(pair)
                        yield rows(m, id_type, {
                            "block": pa.array(np.full(m, block)), "at": pa.array(np.full(m, at, np.int32)),
                            "a": pa.array((pair >> 32).astype(np.int32)), "b": pa.array((pair & 0xFFFFFFFF).astype(np.int32)),
                            "plane": pa.array(np.full(m, plane, np.int32)), "bits": bits})
                    seen += n

    return stored(in_batches(docs.select(id_column, text_column), run, schema), "alignment")


def _planes(links: np.ndarray, starts: np.ndarray, at: int):
    """Bitmaps of the pairs of some documents, plane by plane: (pairs, plane, bitmaps)."""
    if not len(links):
        return
    pairs, code = np.unique(links, return_inverse=True)
    n = len(starts) - 1
    keys, times = np.unique(code * n + np.repeat(np.arange(n), np.diff(starts)), return_counts=True)
    pair, offset = keys // n, keys % n + at
    for plane in range(int(times.max()).bit_length()):
        held = (times >> plane) & 1 == 1
        if held.any():
            mine, group = np.unique(pair[held], return_inverse=True)
            yield pairs[mine], plane, pack(group, offset[held], len(mine))


KEYS = ("block", "a", "b", "plane")


def merge(partial: DataFrame) -> DataFrame:
    """OR-merge the bitmaps of each block, pair and plane: `(block, a, b, plane, bits, n_links, n_docs)`. `n_docs`
    counts the documents of all planes together, on the first plane's row of the pair."""
    rows = partial.select(*KEYS, "bits").repartition("block").sortWithinPartitions(*KEYS)

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]).combine_chunks() if rest is not None else table
            changes = np.flatnonzero(_changes(table, KEYS[:3]))
            last = int(changes[-1]) if len(changes) else 0
            rest = table.slice(last)
            if last:
                yield _merged(table.slice(0, last))
        if rest is not None and len(rest):
            yield _merged(rest)

    return stored(in_batches(rows, run, "block long, a int, b int, plane int, bits binary, n_links long, n_docs long"),
                  "alignment_merged")


def _changes(table: pa.Table, keys) -> np.ndarray:
    """Rows whose keys differ from those of the row before; the first row does."""
    out = np.ones(len(table), bool)
    if len(table) > 1:
        out[1:] = False
        for key in keys:
            values = table[key].to_numpy()
            out[1:] |= values[1:] != values[:-1]
    return out


def _merged(table: pa.Table) -> pa.RecordBatch:
    fresh = _changes(table, KEYS)
    group = np.cumsum(fresh) - 1
    row, offset = unpack(table["bits"])
    held = np.unique(group[row] * BLOCK + offset)
    first = table.filter(pa.array(fresh))
    n = len(first)
    of = held // BLOCK
    links = np.bincount(of, minlength=n) << first["plane"].to_numpy()
    start = _changes(first, KEYS[:3])
    pair = np.cumsum(start) - 1
    docs = np.zeros(n, np.int64)
    docs[start] = np.bincount(np.unique(pair[of] * BLOCK + held % BLOCK) // BLOCK, minlength=int(start.sum()))
    columns = [first[k].combine_chunks() for k in KEYS]
    return pa.RecordBatch.from_arrays(
        [*columns, pack(of, held % BLOCK, n), pa.array(links.astype(np.int64)), pa.array(docs)],
        names=[*KEYS, "bits", "n_links", "n_docs"])


def pair_counts(merged: DataFrame) -> DataFrame:
    """`(a, b, n_links, n_docs, best)` of every pair; best: no other pair of that b has more links."""
    pairs = stored(merged.groupBy("a", "b").agg(F.sum("n_links").alias("n_links"), F.sum("n_docs").alias("n_docs")),
                   "alignment_pairs")
    most = pairs.groupBy("b").agg(F.max("n_links").alias("most"))
    return pairs.join(most, "b").select("a", "b", "n_links", "n_docs", (F.col("n_links") == F.col("most")).alias("best"))


def scores(merged: DataFrame, pairs: DataFrame) -> DataFrame:
    """`(block, at, n_best, count_sum)` of every document with links: the postings take the pairs' counts back.

    Only the keys of the postings go to the pairs and come back as a row before their bitmaps (plane -1), so
    bitmaps are shuffled to their blocks and nowhere else."""
    keys = merged.where("n_docs > 0").select("block", "a", "b")  # one row for each block and pair
    nothing = F.lit(None).cast("binary").alias("bits")
    counts = keys.join(pairs, ["a", "b"]).select(
        "block", "a", "b", F.lit(-1).alias("plane"), nothing, "n_links", F.col("best").cast("long").alias("best"))
    zero = F.lit(0).cast("long")
    bitmaps = merged.select("block", "a", "b", "plane", "bits", zero.alias("n_links"), zero.alias("best"))
    rows = bitmaps.unionByName(counts).repartition("block").sortWithinPartitions(*KEYS)
    names = ["block", "at", "n_best", "count_sum"]

    def result(block, sums):
        at = np.flatnonzero(sums[1])
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), block)), pa.array(at.astype(np.int32)),
                                           pa.array(sums[0][at]), pa.array(sums[1][at])], names=names)

    def run(batches):
        block, sums, held = None, np.zeros((2, BLOCK), np.int64), np.zeros((2, 1), np.int64)
        for batch in batches:
            blocks, plane = batch["block"].to_numpy(), batch["plane"].to_numpy().astype(np.int64)
            # each bitmap has the counts of the row with plane -1 before it, maybe in the batch before
            last = np.maximum.accumulate(np.where(plane < 0, np.arange(1, len(plane) + 1), 0))
            given = np.array([batch["best"].to_numpy(), batch["n_links"].to_numpy()])
            each = np.concatenate((held, given), axis=1)[:, last]
            held = each[:, -1:]
            row, offset = unpack(pc.fill_null(batch["bits"], b""))
            for now in np.unique(blocks).tolist():
                if block is not None and now != block:
                    yield result(block, sums)
                    sums[:] = 0
                block = now
                mine = blocks[row] == now
                for total, weight in zip(sums, each):
                    np.add.at(total, offset[mine], weight[row[mine]] << plane[row[mine]])
        if block is not None:
            yield result(block, sums)

    return in_batches(rows, run, "block long, at int, n_best long, count_sum long")


def alignment(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """`(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)` of every text."""
    rows = encode(docs, a_path, b_path, id_column, text_column)
    merged = merge(rows.where("plane IS NOT NULL"))
    found = scores(merged, pair_counts(merged))
    texts = rows.where("n_a IS NOT NULL").select("block", "at", id_column, "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return texts.join(found, ["block", "at"], "left").select(
        id_column, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
