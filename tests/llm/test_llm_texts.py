"""Token files, BPE, language, toxicity, quality, LM scoring: brute force and odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from tokenizers import Tokenizer

from docweave.llm import attention, bpe, chunks, language_id, lm_score, quality, token_files, toxicity
from docweave.sources.storage import new_location

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LIBRARY = public_tokenizers.path("byte_bpe_50k.json")
LONG = "lorem ipsum dolor " * 20_000

ODD = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "The cat sat. 12 ü日本"), (4, " \n\t "), (5, "x y  z\n\nq"),
       (6, "don't IT'S 'll\n"), (7, LONG), (8, "0" * 9000), (9, "\U0001F600 é \x00\x1c a"), (10, "!!! ???")]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts beside columns named like results."""
    return spark.createDataFrame(
        [(i, t, "x", 1.0, True, "s") for i, t in ODD],
        "doc_id long, text string, lang string, score double, kept boolean, spans string")


@pytest.fixture(scope="module")
def nothing(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})



def test_transducer_equals_merging(reference):
    transducer = bpe.Transducer(bpe.read_ranks(RANKS))
    rng = random.Random(3)
    tokens = list(transducer.ranks)
    for n in range(300):
        piece = (bytes(rng.randrange(256) for _ in range(rng.randrange(1, 9))) if n % 2
                 else b"".join(rng.choice(tokens) for _ in range(rng.randrange(1, 5))))
        assert transducer.encode(piece) == reference._encode_single_piece(piece)
    piece = bytes(rng.choice(b"abc -the") for _ in range(3 * bpe.WINDOW))
    assert transducer.encode(piece) == reference._encode_single_piece(piece)


def test_transducer_forgets_within_bounds(monkeypatch, reference):
    monkeypatch.setattr(bpe, "MAX_STATES", 20)
    monkeypatch.setattr(bpe, "MAX_JOINS", 20)
    transducer = bpe.Transducer(bpe.read_ranks(RANKS))
    assert transducer.max_states == transducer.max_joins == 20
    for word in (b" thandonner", b" reading", b" unbelievable"):
        assert transducer.encode(word) == reference._encode_single_piece(word)


def test_decoder_is_incremental():
    data = "aé日\U0001F600".encode() + b"\xff\xe6\x97" + "z".encode() + b"\xf0\x9f"
    for size in range(1, 8):
        decoder = bpe.Utf8Decoder()
        out = "".join(decoder.feed(data[i:i + size]) for i in range(0, len(data), size)) + decoder.finish()
        assert out == data.decode("utf-8", "replace")


def test_bpe_on_odd_texts(odd, nothing, reference):
    found = bpe.encode_and_decode(odd, RANKS, public_tokenizers.PATTERN).collect()
    expected = Counter()
    for i, text in ODD:
        ids = reference.encode_ordinary(text or "")
        expected[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                 hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found) == expected
    assert all(r.same_text for r in found)
    assert bpe.encode_and_decode(nothing, RANKS, public_tokenizers.PATTERN).count() == 0


def test_encode_then_decode(odd):
    ids = bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    texts = [r.text for r in bpe.decode(ids, RANKS).collect()]
    assert Counter(texts) == Counter(t or "" for _, t in ODD)


def test_chunk_memo_never_changes_ids(monkeypatch, reference):
    monkeypatch.setattr(chunks, "MEMO_ENTRIES", 3)
    encoder = chunks.ChunkEncoder(bpe.TextEncoder(bpe.read_ranks(RANKS), public_tokenizers.PATTERN).batch)
    texts = ["a b c d e f", "  lead", "b c  d", "f e d c b a", None]
    for _ in range(2):
        ids, starts = encoder(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [reference.encode_ordinary(t or "") for t in texts]


def test_signs_and_line_ends_part_words_from_pieces(reference):
    library, asked = token_files.LibraryEncoder(LIBRARY), []
    encoder = chunks.ChunkEncoder(lambda texts, joint: (asked.extend(texts), library(texts, joint))[1])
    texts = ["word, word.\nword word's élan, élan ", "word  word!\n\nword\n élan\u00a0 word", "×, \u3000word\u2028 x", "  ", None,
             "a" * 100 + " word"]
    for _ in range(2):
        ids, starts = encoder(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [reference.encode_ordinary(t or "") for t in texts]
    # words are encoded once, whatever signs follow them; only long pieces are encoded anew
    assert Counter(asked)[" word"] == 1 and " word's" not in asked and Counter(asked)["a" * 100] == 2
    names = encoder.table.names.to_pylist()
    assert {" word", "word", ",", ".\n", "'s", " élan"} <= set(names) and len(names) == len(set(names))


@pytest.mark.parametrize("seed", range(3))
def test_cuts_never_change_ids(reference, seed):
    rng = random.Random(seed)
    signs = [*" \n\t\r\x0b\x1c\x85\xa0\u1680\u2003\u2028\u3000\u200b", *"  \n\nabsÉé×÷ßыŋʼ中1½²,.'’_\u0301\u0375\u0482😀", "'s", "'re", "word", "<|endoftext|>"]
    texts = ["".join(rng.choices(signs, k=rng.choice([1, 2, 3, 9, 40]))) for _ in range(1500)]
    encoder = chunks.ChunkEncoder(token_files.LibraryEncoder(LIBRARY), 500)
    for at in range(0, len(texts), 300):
        part = texts[at:at + 300]
        ids, starts = encoder(pa.array(part))
        assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [reference.encode_ordinary(t) for t in part]


def test_token_files(spark, odd, nothing):
    library = Tokenizer.from_file(LIBRARY)
    location = new_location(spark, "test_tokens")
    token_files.write_tokens(odd, location, LIBRARY, end_id=2)
    rows = token_files.with_checksums(token_files.with_starts(token_files.read_tokens(spark, location))).collect()
    rows.sort(key=lambda r: r.start)
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    at, texts = 0, Counter()
    for row in rows:
        assert row.start == at
        at += row.n_tokens
        texts[row.doc_id, row.n_tokens, row.ids_crc32] += 1
    expected = Counter()
    for i, text in ODD:
        own = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        expected[i, len(own), zlib.crc32(np.array(own, "<u4").tobytes())] += 1
    assert texts == expected
    empty = new_location(spark, "test_tokens")
    token_files.write_tokens(nothing, empty, LIBRARY, end_id=2)
    assert token_files.with_checksums(token_files.with_starts(token_files.read_tokens(spark, empty))).count() == 0


def test_token_files_can_be_read_selectively(spark, odd):
    location = new_location(spark, "test_tokens")
    token_files.write_tokens(odd, location, LIBRARY, end_id=2)
    counts = token_files.read_tokens(spark, location).where("doc_id = 3").select("n_tokens")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,3)" in plan and "tokens:array" not in plan and counts.count() == 2
    path = spark.read.parquet(location).inputFiles()[0].removeprefix("file:")
    column = pq.ParquetFile(path).metadata.row_group(0).column(4)
    assert column.path_in_schema.startswith("tokens") and column.has_offset_index
    assert any("DICTIONARY" in e or "DELTA" in e for e in column.encodings)


def test_language_by_profiles(spark, odd, nothing):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([
        ("the cat and the dog went to the house with the man", "en"), ("the king and the queen of the land", "en"),
        ("der Hund und die Katze gehen nach dem Haus", "de"), ("das ist nicht der Mann und die Frau", "de"),
        ("anything at all", None), (None, "en")])]
    profiles = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = spark.createDataFrame([(1, "the dog and the queen"), (2, "der Mann und das Haus"), (3, "12 !?"), (4, None), (5, "")],
                                  "doc_id long, text string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(asked, profiles).collect()}
    assert [found[i][0] for i in range(1, 6)] == ["en", "de", "und", "und", "und"]
    assert all(0 <= s <= 1 for _, s in found.values()) and found[3][1] == 0
    assert language_id.predict(odd, profiles).count() == len(ODD)
    none = language_id.predict(odd, language_id.train(nothing)).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert language_id.predict(nothing, profiles).count() == 0


def test_grams_equal_a_plain_count():
    text = "Ab ba. Éa"
    keys, letters = language_id.grams(pa.array([text, None, "ab"]))
    _, counts = language_id.counted(keys)
    expected = Counter()
    for word in ("ab", "ba", "éa"):
        marked = f"_{word}_"
        expected.update(word)
        expected.update(marked[i:i + 2] for i in range(len(marked) - 2))
        expected.update(marked[i:i + 3] for i in range(len(marked) - 2))
    assert letters.tolist() == [6, 0, 2]
    assert sorted(counts[(language_id.counted(keys)[0] >> 31) == 0]) == sorted(expected.values())


def test_toxicity_learns_words_and_stems(spark, odd, nothing):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("bdfklmnprst") + rng.choice("aeiou") for _ in range(3))
    clean = [" ".join([word() for _ in range(12)] + ["house"]) for _ in range(30)]
    bad = [t.replace("house", w) for t, w in zip(clean, ["nastig", "grubelt", "grubesk", "nastig", "grubeno"] * 6)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(clean + bad)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= len(clean))) for i in range(len(clean + bad))] + [(1, None)], "doc_id long, toxic int")
    lexicon = toxicity.fit(docs, labels)
    assert "nastig$" in lexicon.weights and "grube" in lexicon.weights
    asked = spark.createDataFrame([(1, "the n4st1g stands near"), (2, "GRUBEXYZ"), (3, "the house stands near water"), (4, None),
                                   (5, "nаstig"), (6, "nastiger folk")], "doc_id long, text string")
    found = {r.doc_id: r.predicted for r in toxicity.score(asked, lexicon).collect()}
    assert found == {1: 1, 2: 1, 3: 0, 4: 0, 5: 1, 6: 0}
    assert toxicity.score(odd, lexicon).count() == len(ODD)
    assert toxicity.score(nothing, lexicon).count() == 0
    assert {r.predicted for r in toxicity.score(odd, toxicity.fit(nothing, labels)).collect()} == {0}


def test_exception_phrase_and_folding():
    lexicon = toxicity.Lexicon({"killer$": 5.0}, {"killer whale"}, (-2.0, 1.0, 1.0))
    matcher = toxicity.Matcher(lexicon)
    assert matcher.matches("a killer whale swims") == []
    assert matcher.matches("a killer swims") == [(2, 8, 5.0)] and matcher.matches("painkillers") == []
    assert toxicity.fold("K1ll3r KÍLLER kіllеr 2024 wow!!") == "killer killer killer 2024 wow!!"


def test_quality_counts_equal_brute_force(odd, nothing):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    for row in quality.quality(odd).collect():
        text = next(t or "" for i, t in ODD if i == row.doc_id)
        found = word.findall(text)
        runs = Counter(tuple(found[i:i + 8]) for i in range(len(found) - 7))
        hit = {k for i in range(len(found) - 7) if runs[tuple(found[i:i + 8])] > 1 for k in range(i, i + 8)}
        lines = [x for x in text.split("\n") if word.search(x)]
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (
            len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))
        assert row.base_failed == (len(found) < 20 or 100 * len(hit) > 30 * len(found))
        assert not (row.base_failed and row.kept)
    assert quality.quality(nothing).count() == 0


def test_repeats_with_colliding_hashes():
    ids = np.arange(40) % 20
    starts = np.array([0, 40])
    same = np.zeros(40, np.uint64)
    assert quality.repeated_words(same, starts, ids).tolist() == [40]
    assert quality.repeated_words(same, starts, np.arange(40)).tolist() == [0]


def test_em_finds_the_bad_rule():
    rng = np.random.default_rng(4)
    good = rng.random(4000) < 0.8
    votes = np.stack([np.where(rng.random(4000) < p, np.where(good, 1, -1), np.where(good, -1, 1)) for p in (0.95, 0.95, 0.9, 0.5)], axis=1)
    votes[rng.random(votes.shape) < 0.2] = 0
    each, counts = np.unique(votes, axis=0, return_counts=True)
    posterior, share, tables = quality.em(each, counts.astype(float))
    back = {tuple(v): p for v, p in zip(each, posterior)}
    assert np.mean([(back[tuple(v)] >= 0.5) == g for v, g in zip(votes, good)]) > 0.93 and abs(share - 0.8) < 0.05
    assert tables[0, 1] - tables[0, 0] > 0.7 > 0.3 > abs(tables[3, 1] - tables[3, 0])


def test_lm_base_equals_brute_force(spark, odd, nothing):
    from pyspark.sql import functions as F
    docs = odd.withColumn("training", F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True)))
    tokens = lambda t: (t or "").encode().lower().split() + [None]
    counts = Counter(w for i, t in ODD if i is None or i % 3 for w in tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    expected = Counter()
    for i, text in ODD:
        own = tokens(text)
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own)
        expected[i, i is not None and i % 3 == 0, len(own), sum(counts[w] > 0 for w in own), total, round(base, 4)] += 1
    rows = lm_score.score(docs, "training", LIBRARY, 50256).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows) == expected
    assert all(r.score < 0 for r in rows)
    assert lm_score.score(docs.where("false"), "training", LIBRARY, 50256).count() == 0
    none = lm_score.score(docs.withColumn("training", F.lit(False)), "training", LIBRARY, 50256).collect()
    assert {r.train_tokens for r in none} == {0} and {r.n_known for r in none} == {0}


def test_lm_trains_on_every_id_once(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "LINE_WINDOWS", 3)
    words = ["alpha", "beta", "Gamma", "d,", "\u00fcber", "zzzz9"]
    rng = random.Random(7)
    texts = [None, "", "alpha", *(" ".join(rng.choice(words) for _ in range(n)) for n in (5, 31, 32, 33, 400, 3000))]
    texts += ["beta alpha d, " * 200] * 5
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    library, end = Tokenizer.from_file(LIBRARY), 50256
    class_of = (np.arange(library.get_vocab_size()) % attention.CLASSES).astype(np.int16)
    rows = lm_score.training_lines(docs, LIBRARY, end, class_of).collect()
    assert len({r.number for r in rows}) == len(rows)
    before, after, wanted = lm_score._window_arrays([bytes(r.line) for r in rows])
    expected = Counter()
    for t in texts:
        ids = [i for w in (t or "").encode().lower().split()
               for i in library.encode(" " + w.decode(), add_special_tokens=False).ids]
        line = class_of[[end, *ids, end]].tolist()
        expected.update(zip(line, line[1:]))
    assert Counter(zip(before[wanted].tolist(), after[wanted].tolist())) == expected


def test_windows_score_each_id_once_and_sum_to_one():
    counts = np.array([5, 9, 1, 0, 3.0])
    class_of, in_class, log_share = attention.vocabulary(counts, 4)
    model = attention.Model(class_of, in_class, attention.start_weights(log_share))
    long = np.random.default_rng(0).integers(0, 4, 100)
    whole = attention.score(model, np.append(long, 4), np.array([0, 101]))
    # one id after another: probabilities of all next ids add up to one
    for n in (1, 20, 40):
        each = [attention.score(model, np.append(long[:n], x), np.array([0, n + 1])) for x in range(5)]
        before = attention.score(model, long[:n], np.array([0, n]))
        assert abs(sum(np.exp(e - before) for e in each) - 1) < 1e-3
    assert np.isfinite(whole).all()


def test_gradients_equal_differences():
    rng = np.random.default_rng(5)
    _, _, log_share = attention.vocabulary(rng.integers(1, 50, 400).astype(float), 3)
    weights = {n: w.astype(float) for n, w in attention.start_weights(log_share).items()}
    before, after = rng.integers(0, attention.CLASSES, (2, 3, attention.WINDOW))
    wanted = rng.random(before.shape) < 0.8
    _, found = attention.gradients(weights, before, after, wanted)
    for name in attention.SHAPES:
        at = np.unravel_index(np.argmax(np.abs(found[name])), found[name].shape)
        losses = []
        for step in (1e-4, -1e-4):
            moved = {n: w.copy() for n, w in weights.items()}
            moved[name][at] += step
            losses.append(attention.gradients(moved, before, after, wanted)[0])
        assert abs((losses[0] - losses[1]) / 2e-4 - found[name][at]) < 1e-3 + 0.02 * abs(found[name][at]), name


def test_training_lowers_the_loss():
    rng = np.random.default_rng(6)
    line = np.tile([1, 2, 3, 4], 50)
    _, _, log_share = attention.vocabulary(np.ones(400), 0)
    start = attention.start_weights(log_share)
    at = rng.integers(0, 100, 40)[:, None] + np.arange(attention.WINDOW)
    arrays = line[at], line[at + 1], np.ones(at.shape, bool)
    trained = attention.train(start, *arrays, least_steps=60)
    assert attention.gradients(trained, *arrays)[0] < 0.3 * attention.gradients(start, *arrays)[0]


def plain_class_score(w, classes):
    """Windows over one text's classes, position by position."""
    total, done, start = 0.0, 0, 0
    while done < len(classes):
        stop = min(start + attention.WINDOW, len(classes))
        before = [classes[i - 1] if i else 0 for i in range(start, stop)]
        for at in range(done - start, stop - start):
            looks = np.array([min(30, max(-30, float(w["query"][before[at]] @ w["key"][before[j]]))) + w["near"][at - j]
                              for j in range(at + 1)])
            share = np.exp(looks) / np.exp(looks).sum()
            context = sum(s * w["value"][before[j]] for j, s in enumerate(share))
            group, member = divmod(classes[start + at], attention.MEMBERS)
            for logits, place in ((context @ w["group"] + w["direct_group"][before[at]], group),
                                  (context @ w["member"][group] + w["direct"][before[at], group], member)):
                total += logits[place] - math.log(np.exp(logits).sum())
        done, start = stop, start + attention.STRIDE
    return total


def test_lm_lines_score_like_a_plain_pass_over_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "LINE_WINDOWS", 3)
    rng = random.Random(11)
    texts = [None, "", "a", *(" ".join(rng.choice(["alpha", "d,", "zzzz9"]) for _ in range(n)) for n in (8, 30, 33, 41, 60, 350))]
    docs = spark.createDataFrame([(i, t, i % 2 == 0) for i, t in enumerate(texts)], "doc_id long, text string, training boolean")
    library, end = Tokenizer.from_file(LIBRARY), 50256
    class_of = (np.arange(library.get_vocab_size()) % attention.CLASSES).astype(np.int16)
    class_of[end] = 0
    inside = np.random.default_rng(1).normal(size=len(class_of))
    _, _, log_share = attention.vocabulary(np.ones(400), 0)
    weights = attention.start_weights(log_share)
    weights["near"] = np.random.default_rng(2).normal(size=attention.WINDOW).astype(np.float32)
    parts = lm_score.encode(docs, "training", LIBRARY, end, class_of, inside, {})
    scored = {r.key: r.lm for r in lm_score.line_scores(parts, attention.packed(weights)).collect()}
    rows = {r.id: r for r in parts.where("key IS NOT NULL").collect()}
    assert len(rows) == len(scored) == len(texts)
    for i, t in enumerate(texts):
        ids = [x for word in (t or "").split() for x in library.encode(" " + word, add_special_tokens=False).ids] + [end]
        assert abs(rows[i].inside - inside[ids].sum()) < 1e-6
        assert abs(scored[rows[i].key] - plain_class_score(weights, class_of[ids].tolist())) < 1e-2, i


def test_language_distances_equal_a_plain_count():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcde  ") for _ in range(n)) + "a" for n in (3, 20, 90, 400)]
    length = 12

    def ranking(text):
        keys, _ = language_id.grams(pa.array([text]))
        found, counts = language_id.counted(keys)
        return [g for _, g in sorted((-c, g) for g, c in zip(found.tolist(), counts.tolist()))][:length]

    profiles = {f"l{n}": ranking("".join(rng.choice("abcdef ") for _ in range(200)) + "a") for n in range(3)}
    held = language_id.Profiles([{"lang": name, "gram": g, "rank": i + 1} for name, grams in profiles.items()
                                 for i, g in enumerate(grams)], length)
    keys, _ = language_id.grams(pa.array(texts))
    sums, counted = held.distances(keys, len(texts))
    for i, text in enumerate(texts):
        own = ranking(text)
        assert counted[i] == len(own)
        for name, total in zip(held.langs, sums[i]):
            profile = profiles[name]
            assert total == sum(abs(profile.index(g) - r) if g in profile else length for r, g in enumerate(own))


def test_held_out_languages_are_told(spark):
    """Accuracy on texts that no profile has seen, over the whole small table."""
    from docweave.llm import queries
    folder = "/root/testdata/sf0.001"
    lang = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = queries.op3_language_id(spark, folder).join(lang, "doc_id").where(
        "held_out AND lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert len(rows) > 20
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows)


def test_held_out_toxic_texts_are_found(spark):
    from docweave.llm import queries
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op5_toxicity(spark, folder).join(labels, "doc_id").where("held_out AND toxic IS NOT NULL").collect()
    toxic, clean = [r.predicted for r in rows if r.toxic], [r.predicted for r in rows if not r.toxic]
    assert len(toxic) > 5 and sum(toxic) >= 0.8 * len(toxic)
    assert sum(clean) <= 0.1 * len(clean)


def test_posteriors_equal_em_over_single_rows(spark):
    """The posterior of each row, against maximisation over rows instead of counted combinations of votes."""
    from pyspark.sql import functions as F
    rng = random.Random(6)
    rows = []
    for i in range(300):
        good = rng.random() < 0.7
        rows.append([i, *(0 if rng.random() < 0.25 else (1 if good else -1) * (1 if rng.random() < right else -1)
                          for right in (0.95, 0.85, 0.6))])
    docs = spark.createDataFrame(rows, "doc_id long, a int, b int, c int")
    found = {r.doc_id: (r.posterior, r.good) for r in quality.judge(docs, {n: F.col(n) for n in "abc"}).collect()}

    posterior = [0.1 if -1 in r[1:] else 0.9 if 1 in r[1:] else 0.5 for r in rows]
    for _ in range(500):
        share = (sum(posterior) + 1) / (len(rows) + 2)
        right = {}
        for rule in (1, 2, 3):
            for kind in (0, 1):
                weight = [p if kind else 1 - p for p in posterior]
                ups = sum(w for w, r in zip(weight, rows) if r[rule] == 1)
                right[rule, kind] = (ups + 1) / (sum(w for w, r in zip(weight, rows) if r[rule]) + 2)
        after = []
        for r in rows:
            chance = [1 - share, share]
            for rule in (1, 2, 3):
                for kind in (0, 1):
                    chance[kind] *= {1: right[rule, kind], -1: 1 - right[rule, kind], 0: 1}[r[rule]]
            after.append(chance[1] / sum(chance))
        moved, posterior = max(abs(x - y) for x, y in zip(after, posterior)), after
        if moved < 1e-9:
            break
    assert len(found) == len(rows)
    for r, p in zip(rows, posterior):
        assert abs(found[r[0]][0] - p) < 1e-6
        assert found[r[0]][1] == (found[r[0]][0] >= quality.GOOD_LIMIT)


def test_words_are_encoded_once_whatever_signs_follow(reference):
    found = ["word", "word,", "word.%%", "\u00a0word", "élan", "élan,", "word"[::-1] * 30]
    word_ids = lm_score.WordIds(LIBRARY)
    ids, starts = word_ids(pa.array(found))
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [reference.encode_ordinary(" " + w) for w in found]
    assert {" word", ",", ".%%", " élan"} <= set(word_ids.encoder.table.names.to_pylist())


def test_attention_by_table_equals_attention_by_vectors():
    rng = np.random.default_rng(4)
    w = {n: rng.normal(size=s) for n, s in attention.SHAPES.items()}
    before = rng.integers(0, attention.CLASSES, (5, attention.WINDOW))
    back = np.arange(attention.WINDOW)[:, None] - np.arange(attention.WINDOW)
    scores = np.clip(w["query"][before] @ w["key"][before].transpose(0, 2, 1), -30, 30) + np.where(back >= 0, w["near"][back], -np.inf)
    share = np.exp(scores) / np.exp(scores).sum(axis=2, keepdims=True)
    for first in (0, attention.WINDOW - attention.STRIDE):
        assert np.allclose(attention.attend(w, before, first)[0], (share @ w["value"][before])[:, first:])


def test_extreme_logits_stay_finite():
    w = attention.start_weights(np.log(np.full(attention.CLASSES, 1 / attention.CLASSES)))
    w["direct"][:], w["direct_group"][:] = -500, 500
    before, after = np.random.default_rng(1).integers(0, attention.CLASSES, (2, 3, attention.WINDOW))
    wanted = np.ones(before.shape, bool)
    loss, g = attention.gradients(w, before, after, wanted)
    found = attention.log_probabilities(w, before, after, wanted)
    assert np.allclose(found, -np.log(attention.CLASSES), atol=1e-4) and np.isclose(loss, np.log(attention.CLASSES))
    assert all(np.isfinite(x).all() for x in g.values())


def test_attention_by_parts_equals_whole_windows():
    rng = np.random.default_rng(8)
    w = {n: rng.normal(size=s) for n, s in attention.SHAPES.items()}
    before = rng.integers(0, attention.CLASSES, (attention.BLOCK + 3, attention.WINDOW))
    whole = attention.attend(w, before)[0]
    for first in (0, attention.WINDOW - attention.STRIDE):
        parts = attention.blocks(len(before), first)
        seen = Counter((i, p) for some, a, b in parts for i in range(len(before))[some] for p in range(a, b))
        assert seen == Counter((i, p) for i in range(len(before)) for p in range(first, attention.WINDOW))
        assert any(attention.attend(w, before[some], a, b)[1].shape[2] < attention.WINDOW for some, a, b in parts)
        assert np.allclose(attention.contexts(w, attention.tables(w), before, first), whole[:, first:])


def test_bounds_hold_and_extreme_products_are_limited():
    rng = np.random.default_rng(9)
    before, after = rng.integers(0, attention.CLASSES, (2, 4, attention.WINDOW))
    for size in (0.1, 1, 30):
        w = {n: (size * rng.normal(size=s)).astype(np.float32) for n, s in attention.SHAPES.items()}
        w["near"][:] = 0
        held = attention.tables(w)
        assert np.abs(w["query"] @ w["key"].T).max() <= held.bound
        context = attention.contexts(w, held, before).reshape(-1, attention.HEAD)
        own, group = before.ravel(), after.ravel() // attention.MEMBERS
        assert np.abs(context @ w["group"] + w["direct_group"][own]).max() <= held.most_group
        assert np.abs(np.einsum("nh,nhm->nm", context, w["member"][group]) + w["direct"][own, group]).max() <= held.most_member
        assert np.isfinite(attention.log_probabilities(w, before, after, np.ones(before.shape, bool))).all()


def test_sums_by_ascending_keys():
    rng = np.random.default_rng(10)
    for n in (0, 1, 500):
        keys, rows = np.sort(rng.integers(0, 50, n)), rng.normal(size=(n, 3))
        plain = np.zeros((50, 3))
        np.add.at(plain, keys, rows)
        assert np.allclose(attention.sums_by(keys, rows, 50), plain)


def test_small_batches_of_words_are_joined_before_they_are_looked_up():
    from docweave.llm.common import joined
    batches = [pa.RecordBatch.from_pydict({"word": [f"w{i}", None], "n": [i, 1]}) for i in range(10)]
    batches.insert(3, batches[0].slice(0, 0))
    found = list(joined(iter(batches), "word", 6))
    assert [len(b) for b in found] == [6, 6, 6, 2]
    assert pa.concat_batches(found).to_pylist() == pa.concat_batches(batches).to_pylist()
    assert list(joined(iter([]), "word", 6)) == []
