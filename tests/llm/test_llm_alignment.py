"""Alignment of two tokenizers against the libraries and brute force over byte ranges."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from docweave.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute_alignment(rows):
    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    of = alignment.byte_characters()
    seen, counts = [], Counter()
    for doc, text in rows:
        whole = (" " + (text or "")).encode()
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        a_bytes = [bytes(of[c] for c in first.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i)
                   else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            a, b, a_bytes, b_bytes = [], [], [], []
        ranges = []
        for pieces in (a_bytes, b_bytes):
            ends = np.cumsum([len(p) for p in pieces]).astype(int).tolist()
            ranges.append(list(zip([0, *ends], ends)))
        links = [(a[i], b[j]) for i, x in enumerate(ranges[0]) for j, y in enumerate(ranges[1])
                 if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]})
        groups = ";".join("|".join(",".join(str(ids[n]) for n, (s, e) in enumerate(r) if low <= s and e <= high)
                                   for ids, r in ((a, ranges[0]), (b, ranges[1]))) for low, high in zip([0, *cuts], cuts))
        counts.update(links)
        seen.append((doc, len(a), len(b), len(cuts), links, hashlib.sha256(groups.encode()).hexdigest() if a else ""))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    rows = [(d if d is not None else -99, na, nb, ng, len(links), sum(counts[p] == most[p[1]] for p in links),
             sum(counts[p] for p in links), digest) for d, na, nb, ng, links, digest in seen]
    return sorted(rows), counts


def found_alignment(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "z", 2) for r in rows], "doc_id long, text string, n_a int, block string, a int")
    found = alignment.alignment(frame, A, B)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(tuple(-99 if v is None else v for v in r) for r in found.collect())


def texts(n=150, seed=2):
    rng = random.Random(seed)
    words = ["the", "Straße", "naïve", "x1y2", "don't", "résumé's", "hello,", "(world)", "日本語", "🙂ok", "a\nb", "tokenization", "zz"]
    return [(i, " ".join(rng.choice(words) + rng.choice(["", "", "s", "!"]) for _ in range(rng.randrange(1, 40)))) for i in range(n)]


def test_alignment_equals_brute_force(spark):
    rows = texts()
    assert found_alignment(spark, rows) == brute_alignment(rows)[0]


def test_alignment_on_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " "), (4, "  two  spaces "), (5, "tab\there x 　y"), (6, "▁ low▁line"), (7, "﻿ a\u0000b"),
            (8, "<s> </s> <unk> <|endoftext|> <0x41>"), (9, "ﬁ Ａ é é"), (None, "one text"), (None, "one text"), (1, "one text"),
            (10, "long " * 2_500 + "end"), (11, "x" * 3000), (12, "\n\n a \r\n b"), (13, "\U0001f9d1‍\U0001f680 \udbff".encode("utf8", "ignore").decode())]
    assert found_alignment(spark, rows) == brute_alignment(rows)[0]
    assert found_alignment(spark, []) == [] and found_alignment(spark, [(1, None)])[0][1:] == (0,) * 6 + ("",)


def test_pairs_and_small_blocks(spark, monkeypatch):
    rows = texts(60, 4) + [(900 + i, "the same text for a large group of copies") for i in range(300)]
    expected, counts = brute_alignment(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(3)
    merged = alignment.merge(alignment.encode(frame, A, B).where("plane IS NOT NULL"))
    pairs = {(r.a, r.b): (r.n_links, r.n_docs) for r in alignment.pair_counts(merged).collect()}
    assert {p: n for p, (n, _) in pairs.items()} == counts
    the = max(pairs, key=lambda p: pairs[p][0])
    assert pairs[the][0] >= pairs[the][1] >= 300
    monkeypatch.setattr(alignment, "TEXT_BYTES", 300)
    monkeypatch.setattr(alignment, "MEMO_ENTRIES", 5)
    assert found_alignment(spark, rows) == expected


@pytest.mark.parametrize("sizes", [[3, 0, 1], [5000, 2, 65536], [0], [4095, 4096, 4097]])
def test_bitmaps_round_trip(sizes):
    rng = np.random.default_rng(1)
    held = [np.sort(rng.permutation(65536)[:n]) for n in sizes]
    packed = alignment.pack(np.repeat(np.arange(len(sizes)), sizes), np.concatenate(held).astype(np.int64), len(sizes))
    assert max(map(len, packed.to_pylist())) <= alignment.BITMAP_BYTES
    row, offset = alignment.unpack(pa.chunked_array([packed]))
    for i, values in enumerate(held):
        assert np.array_equal(np.sort(offset[row == i]), values)
