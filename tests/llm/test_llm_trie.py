"""The conversation trie against brute force over whole prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from docweave.llm import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_trie(rows, block=20, heads=4):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            said = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, said, (role, text)))
    own = {c: [t[3] for t in sorted(found)] for c, found in own.items()}
    nodes = defaultdict(list)
    ends = defaultdict(list)
    for conv in sorted(own):
        h = zlib.crc32(str(conv).encode()) % heads
        base = conv - (abs(conv) % block) * (1 if conv >= 0 else -1)
        whole = tuple(own.get(base, [])[:h] + own[conv][h:])
        ends[whole].append(conv)
        for d in range(len(whole) + 1):
            nodes[whole[:d]].append(conv)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    for path, convs in nodes.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(convs) - 1) * len(WORD.findall(path[-1][1])) if path else 0
    digest = lambda p: hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()
    return sorted((nodes[p][0], len(p), nodes[p[:-1]][0] if p else -1, len(nodes[p]), children[p], leaves[p],
                   saved[p], digest(p)) for p in nodes)


def found_trie(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA)
    found = conversation_trie.trie(frame)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                             "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in found.collect())


def talks(seed, n=120):
    """Few distinct turns, so that conversations share long beginnings; some are copies of one another."""
    rng = random.Random(seed)
    said = [("user", "hello there"), ("user", "one two\tthree"), ("assistant", "yes  no"), ("assistant", ""), (None, None)]
    rows = []
    for conv in rng.sample(range(-45, 6000 if seed else 140), n):
        length = rng.choice((1, 2, 2, 3, 5, 9))
        picks = [said[0]] * length if rng.random() < 0.4 else [rng.choice(said) for _ in range(length)]
        rows += [(conv, turn, role, text) for turn, (role, text) in enumerate(picks)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("bits", [conversation_trie.SEGMENT_BITS, 1])
def test_trie_equals_brute_force(spark, monkeypatch, bits):
    monkeypatch.setattr(conversation_trie, "SEGMENT_BITS", bits)
    monkeypatch.setattr(conversation_trie, "ENDS_BITS", bits)
    rows = talks(0) if bits > 1 else talks(3, 60)
    assert found_trie(spark, rows) == brute_trie(rows)


def test_trie_on_odd_rows(spark):
    rows = [(7, None, "user", "a b"), (7, None, "user", "a b"), (7, 3, None, None), (7, 3, "user", "zz"), (7, 3, "a", "b"),
            (None, 1, "user", "of nobody"), (2**62, -5, "user", "x" * 300_000), (2**62, -5, "", "1:x"), (0, 1, "", ""),
            (-7, 2, "user", "a b"), (21, 0, "", ""), (22, 0, "", ""), (23, 0, "", ""), (24, 0, "", ""), (25, 0, "", "")]
    expected = brute_trie(rows)
    assert found_trie(spark, rows) == expected
    assert any(n[1] == 0 and n[7] != hashlib.sha256(b"").hexdigest() for n in expected)  # turnless members
    assert found_trie(spark, []) == []
    assert [n[3] for n in found_trie(spark, [(None, 1, "user", "of nobody")])] == []


def test_a_third_of_all_rows_in_one_conversation(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "SEGMENT_BITS", 6)
    rows = [(40, t, "user", f"w{t % 3} w") for t in range(500)] + [(c, t, "user", "w0 w") for c in range(400, 900) for t in range(2)]
    assert found_trie(spark, rows) == brute_trie(rows)
    turns = conversation_trie.turns(spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA))
    assert [r.place for r in turns.where("conv_id = 40").orderBy("place").collect()] == list(range(500))
