"""Chat formatting as prefix trees: conversations that begin alike share their first turns.

Every turn becomes `<|im_start|>role\\ntext<|im_end|>\\n`; control strings inside texts are escaped
by one more backslash after `<`, so they can be taken back exactly. Turns are sorted by conversation
within partitions and streamed, so a conversation of any length is never held whole. The digest of
each prefix follows from the one before. Where PACK_CHARS characters are full a conversation
is cut: it is a row of chunks, each a path of turns from the prefix before it. Equal chunks after
equal prefixes are one; distinct ones are sorted by the prefix before and the digests of their
turns' prefixes over all partitions, which lays out each tree depth first, and every turn is written
once where it first appears. A pack is a run of that order of bounded size, so a tree with a third
of all conversations goes over many packs and tasks; a later pack of the same tree repeats
only the turns from the tree's root to where it goes on. A pack whose trees go on from a prefix
names its digest (`before`); its positions count from the conversation's start, and what lies before
is in other packs. The last stage reads a long conversation chunk by chunk.

A pack is one row: the text; for each node its start, end, parent and role; position ids as the
place of each node's first character on its path; the intervals of the text that a node may attend
to (its ancestors, and itself up to the own position); and the spans that carry loss (assistant
texts, without marks). Units are characters (code points): a token is one code point here, and
since nodes end at turn borders, any tokenizer can be applied node by node.

NULL texts are empty, NULL roles too. Turns are ordered by turn, then role, then text; repeated turn
numbers stay. Conversations with a NULL id are one conversation of that id.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from docweave.llm.common import BATCH_ROWS, in_batches
from docweave.sources.storage import stored

START, END = "<|im_start|>", "<|im_end|>"
PACK_CHARS = 100_000
BATCH_CHARS = 1 << 20
LOSS_ROLE = "assistant"
_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its text starts and ends in it."""
    head = f"{START}{escape_role(role)}\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def _batched(rows: Iterator[tuple[tuple, int]], types: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Batches of rows that come with their sizes; each ends with the row that fills it."""
    held, size = [], 0
    make = lambda: pa.RecordBatch.from_arrays(
        [pa.array(column, t) for column, t in zip(zip(*held), types.values())], names=list(types))
    for row, own in rows:
        held.append(row)
        size += own
        if size >= BATCH_CHARS or len(held) >= BATCH_ROWS:
            yield make()
            held, size = [], 0
    if held:
        yield make()


def _same(a, b) -> bool:
    return a == b or (a != a and b != b)  # NaN is one id


def paths(conversations: DataFrame, id_column: str = "conv_id", pack_chars: int = PACK_CHARS) -> DataFrame:
    """(conv_id, key, seq, before, skipped, path, turns, last): each conversation's turns in order, in
    chunks that end with the turn that fills pack_chars, so prefixes alike are cut alike. `key` numbers
    conversations; `before` is the digest of all turns before the chunk, `skipped` their characters;
    `path` has the digest of each prefix that ends in the chunk."""
    kind = conversations.schema[id_column].dataType.simpleString()
    turns = conversations.select(
        F.col(id_column).alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    schema = (f"conv_id {kind}, key long, seq int, before string, skipped long, path array<string>, "
              "turns array<struct<role: string, text: string>>, last boolean")

    types = {"conv_id": to_arrow_type(conversations.schema[id_column].dataType), "key": pa.int64(), "seq": pa.int32(),
             "before": pa.string(), "skipped": pa.int64(), "path": pa.list_(pa.string()),
             "turns": pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])), "last": pa.bool_()}

    def cut(batches: Iterator[pa.RecordBatch]):
        key, conv, chunk = (TaskContext.get().partitionId() << 40) - 1, None, None

        def written(last: bool) -> tuple[tuple, int]:
            return (conv, key, *(chunk[n] for n in ("seq", "before", "skipped", "path", "turns")), last), chunk["size"]

        for batch in batches:
            for this, role, text in zip(*(batch[n].to_pylist() for n in ("conv_id", "role", "text"))):
                if chunk is None or not _same(this, conv):
                    if chunk is not None:
                        yield written(True)
                    key, conv = key + 1, this
                    chunk = {"seq": 0, "before": "", "skipped": 0, "path": [], "turns": [], "size": 0, "digest": ""}
                elif chunk["size"] >= pack_chars:
                    yield written(False)
                    chunk = {"seq": chunk["seq"] + 1, "before": chunk["digest"], "skipped": chunk["skipped"] + chunk["size"],
                             "path": [], "turns": [], "size": 0, "digest": chunk["digest"]}
                digest = lambda s: hashlib.md5(s.encode()).hexdigest()
                chunk["digest"] = digest(f"{chunk['digest']}\n{digest(role)}\n{digest(text)}")
                chunk["path"].append(chunk["digest"])
                chunk["turns"].append({"role": role, "text": text})
                chunk["size"] += len(format_turn(role, text)[0])
        if chunk is not None:
            yield written(True)

    return in_batches(ordered, lambda batches: _batched(cut(batches), types), schema)


PACKED = ("pack string, before string, text string, starts array<int>, ends array<int>, parents array<int>, "
          "positions array<long>, attend array<array<int>>, roles array<string>, loss_starts array<int>, "
          "loss_ends array<int>, leaves array<int>, leaf_paths array<string>")


class Pack:
    """The tree being written: nodes in depth-first order."""

    def __init__(self, name: str, before: str = "", skipped: int = 0):
        self.name, self.before, self.skipped, self.size, self.text = name, before, skipped, 0, []
        self.rows = {n: [] for n in ("starts", "ends", "parents", "positions", "attend", "roles", "loss_starts",
                                     "loss_ends", "leaves", "leaf_paths")}
        self.open: list[tuple[str, int]] = []  # digest and node of the current path

    def add(self, turns: list[dict], path: list[str]) -> None:
        shared = 0
        while shared < min(len(path), len(self.open)) and self.open[shared][0] == path[shared]:
            shared += 1
        del self.open[shared:]
        r = self.rows
        for digest, turn in zip(path[shared:], turns[shared:]):
            parent = self.open[-1][1] if self.open else -1
            text, begin, end = format_turn(turn["role"], turn["text"])
            node, start = len(r["starts"]), self.size
            self.text.append(text)
            self.size += len(text)
            r["starts"].append(start)
            r["ends"].append(self.size)
            r["parents"].append(parent)
            r["positions"].append(r["positions"][parent] + r["ends"][parent] - r["starts"][parent] if parent >= 0 else self.skipped)
            own = r["attend"][parent] if parent >= 0 else []
            if own and own[-1] == start:  # neighbours on the path are one interval
                r["attend"].append([*own[:-1], self.size])
            else:
                r["attend"].append([*own, start, self.size])
            r["roles"].append(turn["role"])
            loss = turn["role"] == LOSS_ROLE
            r["loss_starts"].append(start + begin if loss else -1)
            r["loss_ends"].append(start + end if loss else -1)
            self.open.append((digest, node))
        r["leaves"].append(self.open[-1][1])
        r["leaf_paths"].append(path[-1])

    def row(self) -> dict:
        return {"pack": self.name, "before": self.before, "text": "".join(self.text), **self.rows}


def pack(distinct: DataFrame, pack_chars: int = PACK_CHARS) -> DataFrame:
    """Packs (see PACKED) of distinct chunks (before, skipped, path, turns); written in ranges of the paths."""
    ordered = distinct.select("before", "path", "skipped", "turns").repartitionByRange("before", "path").sortWithinPartitions(
        "before", "path")
    shape = {"list": pa.list_(pa.int32())}
    types = {"pack": pa.string(), "before": pa.string(), "text": pa.string(), "positions": pa.list_(pa.int64()), "attend": pa.list_(shape["list"]),
             "roles": pa.list_(pa.string()), "leaf_paths": pa.list_(pa.string())}

    def run(batches: Iterator[pa.RecordBatch]):
        task, number, current = TaskContext.get().partitionId(), 0, None
        fields = [c.split(" ")[0] for c in PACKED.split(", ")]

        def written(done: Pack) -> pa.RecordBatch:
            row = done.row()
            return pa.RecordBatch.from_arrays([pa.array([row[f]], types.get(f, shape["list"])) for f in fields], names=fields)

        for batch in batches:
            for before, path, skipped, turns in zip(*(batch[n] for n in ("before", "path", "skipped", "turns"))):
                if current is not None and (current.size >= pack_chars or current.before != before.as_py()):
                    yield written(current)
                    number, current = number + 1, None
                if current is None:
                    current = Pack(f"{task}-{number}", before.as_py(), skipped.as_py())
                current.add(turns.as_py(), path.as_py())
        if current is not None:
            yield written(current)

    return in_batches(ordered, run, PACKED)


def format_conversations(conversations: DataFrame, id_column: str = "conv_id", pack_chars: int = PACK_CHARS) -> tuple[DataFrame, DataFrame]:
    """The stored packs, and (conv_id, key, seq, last, path) that tells the leaf of each conversation's chunks."""
    chunks = stored(paths(conversations, id_column, pack_chars), "chat_paths")
    leaf = F.element_at("path", -1)
    distinct = chunks.groupBy(leaf.alias("leaf")).agg(
        *(F.first(n).alias(n) for n in ("before", "skipped", "path", "turns")))
    packs = stored(pack(distinct, pack_chars), "chat_packs")
    return packs, chunks.select("conv_id", "key", "seq", "last", leaf.alias("path"))


RESULT = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(packs: DataFrame, pack_chars: int = PACK_CHARS) -> DataFrame:
    """(path, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, whole, loss) of every
    distinct chunk, from the packs alone: the attention intervals of its leaf are its text, and the
    loss spans inside them its answers. `whole` and `loss` are the bytes themselves, for chunks that are
    no whole conversation: those after another, and full ones."""
    def read(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for packed in range(len(batch)):
                row = batch.slice(packed, 1).to_pylist()[0]
                text = row["text"]
                for leaf, path in zip(row["leaves"], row["leaf_paths"]):
                    bounds = row["attend"][leaf]
                    nodes, node = [], leaf
                    while node >= 0:
                        nodes.append(node)
                        node = row["parents"][node]
                    formatted = "".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2]))
                    found = formatted.split(f"{END}\n")[:-1]
                    turns = []
                    for part in found:
                        role, _, body = part[len(START):].partition("\n")
                        turns.append(f"{unescape_role(role)}\n{unescape(body)}\n")
                    whole = "".join(turns).encode()
                    loss = "".join(unescape(text[row["loss_starts"][n]:row["loss_ends"][n]])
                                   for n in reversed(nodes) if row["loss_starts"][n] >= 0)
                    said, part = loss.encode(), row["before"] != "" or len(formatted) >= pack_chars
                    yield (path, len(found), hashlib.sha256(whole).hexdigest(), len(loss), hashlib.sha256(said).hexdigest(),
                           len(formatted), whole if part else None, said if part else None), 2 * len(formatted) if part else 0

    names = {"path": pa.string(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(),
             "loss_sha256": pa.string(), "formatted_chars": pa.int64(), "whole": pa.binary(), "loss": pa.binary()}
    return in_batches(packs, lambda batches: _batched(read(batches), names), f"path string, {RESULT}, whole binary, loss binary")


def joined(parts: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of every conversation of
    several chunks (conv_id, key, seq, last, and what read_back gives); streamed in the chunks' order."""
    kind = parts.schema["conv_id"].dataType.simpleString()
    ordered = parts.repartition("key").sortWithinPartitions("key", "seq")

    def join(batches: Iterator[pa.RecordBatch]):
        counts, digests = None, None
        for batch in batches:
            for at in range(len(batch)):
                row = {n: batch[n][at].as_py() for n in batch.schema.names}
                if row["seq"] == 0:
                    counts, digests = [0, 0, 0], (hashlib.sha256(), hashlib.sha256())
                counts = [n + row[c] for n, c in zip(counts, ("n_turns", "loss_chars", "formatted_chars"))]
                digests[0].update(row["whole"])
                digests[1].update(row["loss"])
                if row["last"]:
                    yield (row["conv_id"], counts[0], digests[0].hexdigest(), counts[1], digests[1].hexdigest(), counts[2]), 0

    types = {"conv_id": to_arrow_type(parts.schema["conv_id"].dataType), "n_turns": pa.int64(), "turns_sha256": pa.string(),
             "loss_chars": pa.int64(), "loss_sha256": pa.string(), "formatted_chars": pa.int64()}
    return in_batches(ordered, lambda batches: _batched(join(batches), types), f"conv_id {kind}, {RESULT}")


def chat(conversations: DataFrame, id_column: str = "conv_id", pack_chars: int = PACK_CHARS) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of every
    conversation, read back from its packs."""
    packs, members = format_conversations(conversations, id_column, pack_chars)
    parts = members.join(read_back(packs, pack_chars), "path")
    single = (F.col("seq") == 0) & F.col("last")
    columns = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    parts = stored(parts.withColumn("whole", F.when(~single, F.col("whole"))).withColumn("loss", F.when(~single, F.col("loss"))),
                   "chat_parts")
    short = parts.where(single).select(*columns)
    return short.unionByName(joined(parts.where(~single))).withColumnRenamed("conv_id", id_column)
