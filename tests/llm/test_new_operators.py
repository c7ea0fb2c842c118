"""BPE codec, hard negatives and the prefix trie against the library and plain Python."""

from __future__ import annotations

import random

import brute_llm
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablesync.llm import bpe_codec, conversation_trie
from tablesync.llm.hard_negatives import Codes, Settings, half_bounds, hard_negatives, multi_sequence, products

PIECES = ["a", "the", "'s", "'re", "'", "''", "1", "²", " ", "\t", "\n", "\x1c", "\x85", "\xa0", " ", "É", "ß", "İ", "Σ", "中",
          "🙂", "<|endoftext|>", "<|startoftext|>", "<|x", "!", "...", "don't", "I'LL", "\x00", "é", "①", "therefore", "ΑΣ ",
          "한글", "ไทย", "​"]


def odd_texts(n: int, seed: int = 11) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(n)]


# --- BPE codec -------------------------------------------------------------------


@pytest.mark.parametrize("file", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_codec_agrees_with_the_library(file):
    path = public_tokenizers.path(file)
    library, encoder, decoder = Tokenizer.from_file(path), bpe_codec.Encoder(path), bpe_codec.Decoder(path)
    long = ["ab" * 200_000, "x" * 70_000 + " " + "it's " * 30_000, "한글 " * 40_000 + "ไทย1" * 20_000, "aaaa" * 999]
    for text in [*odd_texts(3000), *long]:
        ids = library.encode(text, add_special_tokens=False).ids
        own = np.frombuffer(encoder.encode(text), np.int32)
        assert own.tolist() == ids, repr(text)[:80]
        assert decoder.decode(own).decode() == library.decode(ids, skip_special_tokens=False), repr(text)[:80]


def test_tables_may_be_forgotten(monkeypatch):
    monkeypatch.setattr(bpe_codec, "MAX_PAIRS", 20)
    monkeypatch.setattr(bpe_codec, "MAX_WORDS", 20)
    path = public_tokenizers.path(bpe_codec.VOCABULARY)
    library, encoder = Tokenizer.from_file(path), bpe_codec.Encoder(path)
    for text in odd_texts(300, seed=12):
        assert np.frombuffer(encoder.encode(text), np.int32).tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(encoder.pairs) <= 20 and len(encoder.by_word) <= 20


def test_backtracking_gives_a_token_back():
    """Longest matches first would be another encoding; the merges decide."""
    path = public_tokenizers.path(bpe_codec.VOCABULARY)
    library, encoder = Tokenizer.from_file(path), bpe_codec.Encoder(path)
    rng = random.Random(2)
    given_back = 0
    for _ in range(4000):
        word = "".join(rng.choices("aeinrstlo", k=rng.randint(3, 14)))
        greedy, at = [], 0
        marked = word[:-1] + chr(ord(word[-1]) + 0x400)
        while at < len(marked):
            size = max(k for k in range(1, len(marked) - at + 1) if marked[at : at + k] in encoder.ids)
            greedy.append(encoder.ids[marked[at : at + size]])
            at += size
        own = np.frombuffer(encoder.encode(word), np.int32).tolist()
        assert own == library.encode(word, add_special_tokens=False).ids
        given_back += own != greedy
    assert given_back


def test_codec_on_frames(spark):
    texts = [None, "", "  ", "again", "again", "it's <|endoftext|> 12", *odd_texts(50, seed=13)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    encoded = bpe_codec.encode_texts(docs)
    rows = bpe_codec.decode_ids(encoded).collect()
    library = Tokenizer.from_file(public_tokenizers.path(bpe_codec.VOCABULARY))
    assert len(rows) == len(texts)
    for r in rows:
        expected = library.encode(texts[r["row"]["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == expected and r["row"]["ids"] == "x"
        assert r["decoded"] == library.decode(expected, skip_special_tokens=False)
    assert bpe_codec.decode_ids(bpe_codec.encode_texts(docs.limit(0))).collect() == []
    odd = spark.createDataFrame([(None,), ([],), ([49407, None, 10**8, -1],)], "ids array<int>")
    assert [r["decoded"] for r in bpe_codec.decode_ids(odd).collect()] == [None, "", "<|endoftext|>"]
    with pytest.raises(ValueError, match="decoded"):
        bpe_codec.decode_ids(odd.withColumn("Decoded", F.lit(1)))


def test_other_vocabularies_are_refused(tmp_path):
    path = tmp_path / "unigram.json"
    path.write_text('{"model": {"type": "Unigram"}}')
    with pytest.raises(ValueError, match="BPE"):
        bpe_codec.Encoder(str(path))


# --- prefix trie -----------------------------------------------------------------

TALK = "conv_id long, turn long, role string, text string, depth string, k1 int"


def talks(seed: int, n: int, longest: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        size = rng.choice([1, 2, 3, 5, 9, longest])
        same = rng.random() < 0.5
        for turn in range(size):
            text = f"common {turn}" if same and turn < 6 else rng.choice(["x", "ü🙂", "", None, f"t{rng.randint(0, 3)}"])
            rows.append((c * 2 + seed % 2, turn, rng.choice(["user", None]) if not same else "user", text))
    rows += [(4001, None, "user", "first"), (4001, 0, "user", "second"), (4001, 0, "user", "second"), (4001, 0, None, "tie")]
    rows += [(None, 0, "user", "lost"), (-3, 0, "user", "x"), (-7, 1, "system", "y"), (5004, 0, "user", "alone")]
    rows += [(6000 + k, t, "user", f"copy {t}") for k in range(40) for t in range(12)]
    rng.shuffle(rows)
    return rows


def found_trie(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "d", 1) for r in rows], TALK)
    return [tuple(r) for r in conversation_trie.prefix_trie(frame, **options).collect()]


@pytest.mark.parametrize("group_steps", [1, 40, 250_000])
def test_trie(spark, monkeypatch, group_steps):
    """Groups peeled by workers and by Spark, and both; bands narrower than the conversations."""
    monkeypatch.setattr(conversation_trie, "BAND", 5)
    monkeypatch.setattr(conversation_trie, "PACKED_IDS", 7)
    rows = talks(4, 60, 14)
    got = found_trie(spark, rows, group_steps=group_steps)
    assert len(got) == len(set(got))
    assert set(got) == brute_llm.prefix_trie(rows)


def test_trie_of_one_band(spark):
    rows = talks(5, 80, 30)
    assert set(found_trie(spark, rows)) == brute_llm.prefix_trie(rows)


def test_trie_of_little(spark):
    assert found_trie(spark, []) == []
    assert found_trie(spark, [(None, 0, "user", "x")]) == []
    turnless = [(4, 0, "user", "x")]  # crc32("4") % 9 is not 0, and there is no conversation 0
    assert set(found_trie(spark, turnless)) == brute_llm.prefix_trie(turnless)


# --- hard negatives --------------------------------------------------------------

VECTOR = "vec_id long, label int, embedding array<float>, cell string, dims int"


def vectors(seed: int, n: int, dims: int = 6) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(4, dims))
    rows = []
    for i in range(n):
        x = np.round(centers[i % 4] + 0.4 * rng.normal(size=dims), 1 if i % 3 else 4)
        rows.append((i, int(rng.integers(0, 4)) if i % 11 else 9, [float(np.float32(v)) for v in x]))
    rows += [(n + k, k % 3, rows[5][2]) for k in range(40)]  # a large group of copies with different labels
    rows += [rows[0], rows[0], (0, 3, rows[1][2]), (None, 1, rows[2][2]), (2000, None, rows[2][2]), (2001, 1, None)]
    rows += [(2002, 1, [1.0] * (dims - 1) + [None]), (2003, 1, [float("nan")] * dims), (2004, 1, [float("inf")] * dims)]
    rows += [(2005, 1, [0.0] * dims), (2010, 1, [1.0, 2.0, 3.0]), (2011, 1, [1.0, 2.0, 2.5]), (2012, 2, [1.0, 2.0, 2.0])]
    rows += [(2020, 1, []), (2021, 1, []), (2022, 2, []), (2030, 77, rows[3][2])]
    return rows


@pytest.mark.parametrize("settings", [
    Settings(cell_rows=4, first_rows=6, block=5, pack=3), Settings(cell_rows=10**6), Settings(cell_rows=2, first_rows=1, codes=40),
])
def test_hard_negatives(spark, settings):
    rows = vectors(3, 150)
    anchors = {i for i in range(0, 2031) if i % 5 == 0}
    frame = spark.createDataFrame([(*r, "c", 1) for r in rows], VECTOR)
    got = hard_negatives(frame, is_anchor=F.col("vec_id") % 5 == 0, n_positives=4, n_negatives=3, settings=settings).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == brute_llm.hard_negatives(rows, anchors, 4, 3, (80, 100), 256.0)


def test_hard_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], VECTOR)
    assert hard_negatives(empty).collect() == []
    lonely = spark.createDataFrame([(0, 1, [1.0, 0.0], "c", 1)], VECTOR)
    assert hard_negatives(lonely).collect() == []
    huge = spark.createDataFrame([(0, 1, [1e9, 0.0], "c", 1)], VECTOR)
    with pytest.raises(Exception, match="too large"):
        hard_negatives(huge).collect()


def test_bounds_hold_and_the_heap_stops_at_them():
    rng = np.random.default_rng(1)
    x = rng.integers(-200, 200, (500, 7))
    from tablesync.llm.hard_negatives import _halves, _root, fit_codes, nearest

    halves = tuple(fit_codes(h, 6, 4) for h in _halves(x))
    found = [nearest(h, c) for h, c in zip(_halves(x), halves)]
    radii = tuple(np.array([_root(np.array([far[best == k].max(initial=0)]))[0] for k in range(6)]) for best, far in found)
    counts = np.zeros((6, 6), np.int64)
    np.add.at(counts, (found[0][0], found[1][0]), 1)
    codes = Codes(halves, radii, counts)
    for a in x[:40]:
        one, two = half_bounds(a, codes)
        bound = one[:, None] + two[None]
        assert (products(a[None], x)[0] <= bound[found[0][0], found[1][0]]).all()
        until = multi_sequence(one, two, counts, 60)
        assert counts[bound >= until].sum() >= 60 > counts[bound > until].sum()
        assert multi_sequence(one, two, counts, 10**9) == bound.min()
