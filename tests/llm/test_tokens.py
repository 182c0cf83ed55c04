"""Token ids, token files and packing against the tokenizer itself and brute force."""

import random
import struct
import sys
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer, models

from helpers import AWKWARD, documents, with_clashes
from llm import packing, token_ids, token_store
from llm.token_ids import default_vocabulary, encoder

WHOLE = Tokenizer.from_file(default_vocabulary())


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "Word", "é", " ", "  ", "\n", "\t", "'s", "'", ".", ",", "!?", "12", " ", "\x1c", "᠎", "​",
                                 "\x85", "<|endoftext|>", "ǅ", "中文", "\r\n", "ⅷ", "́", "\U0001f600"]), max_size=20).map("".join))
def test_cut_encoding_equals_whole_encoding(text):
    assert np.frombuffer(encoder(default_vocabulary())(text), "<u4").tolist() == ids_of(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert np.frombuffer(encoder(default_vocabulary())(text), "<u4").tolist() == ids_of(text)


def test_generations_of_words(monkeypatch):
    monkeypatch.setattr(token_ids, "WORDS_KEPT", 3)
    encode = token_ids._encoder(default_vocabulary())
    words = "one two three, four. five six seven one two three eight nine\nten one".split(" ")
    for n in range(len(words)):
        text = " ".join(words[n:] + words[:n])
        assert np.frombuffer(encode(text), "<u4").tolist() == ids_of(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["word", "Straße", "ÿ", "the", "'ll", "'", "&&&", "|", "[", "\\", "]", "^_`", "{~}", "<|", "endoftext", "|>", "7",
                                 "\n", " ", "\n\n", " \n", "\n ", "\r", "×", "\x1f", "\u200b"]), max_size=30).map("".join))
def test_lines_and_marks(text):
    assert np.frombuffer(encoder(default_vocabulary())(text), "<u4").tolist() == ids_of(text)


def test_new_words_share_a_call(monkeypatch):
    monkeypatch.setattr(token_ids, "WORDS_A_CALL", 400, raising=False)
    encode = token_ids._encoder(default_vocabulary())
    letters, calls = random.Random(3), []
    words = ["".join(letters.choices("abcdeèXYZ", k=9)) + letters.choice(["", "", ".", "&&&"]) for _ in range(1000)]
    text = "".join(w + letters.choice([" ", " ", "\n"]) for w in words) + "end"

    def count(frame, event, called):
        if event == "c_call" and type(getattr(called, "__self__", None)).__module__.startswith("tokenizers"):
            calls.append(called.__name__)

    sys.setprofile(count)
    try:
        ids = encode(text)
    finally:
        sys.setprofile(None)
    assert np.frombuffer(ids, "<u4").tolist() == ids_of(text)
    assert 3 <= len(calls) <= 3 + 2  # three runs of at most 400 words, and two kinds of marks


@pytest.mark.parametrize("token", ["aĠ", "Ċa", "ĠaĊb"])
def test_vocabulary_whose_tokens_reach_over_words(token):
    characters = ["a", "b", "Ġ", "Ċ"]
    vocabulary = {t: i for i, t in enumerate([*characters, *dict.fromkeys(token[:i] for i in range(2, len(token) + 1))])}
    steps = [(token[:i], token[i]) for i in range(1, len(token))]
    with pytest.raises(ValueError, match="reaches over"):
        token_ids._plain_words(Tokenizer(models.BPE(vocabulary, steps)))


def test_token_files_round_trip(spark, tmp_path):
    rows = AWKWARD + [(100 + i, f"filler text number {i} " * (i % 7)) for i in range(300)]
    path = str(tmp_path / "files")
    token_store.write_token_files(with_clashes(documents(spark, rows)).repartition(5), path)
    got = token_store.read_token_files(spark, path).collect()
    want = sorted((i is not None, i or 0, packed(ids_of(t) + [2])) for i, t, *_ in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.ids)) for r in got) == want
    assert all(r.n_tokens == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids) for r in got)
    in_order, at = sorted(got, key=lambda r: r.start), 0
    for r in in_order:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in in_order]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    few = token_store.read_token_files(spark, path, doc_ids=[7, 150, 4]).collect()
    assert sorted(r.doc_id for r in few) == [4, 7, 7, 150]
    by_start = {r.start: r for r in got}
    assert all(by_start[r.start] == r for r in few)


def test_segments_close(spark, tmp_path):
    path = str(tmp_path / "files")
    rows = [(i, f"some words for number {i} " * 20) for i in range(60)]
    token_store.write_token_files(documents(spark, rows), path, segment_bytes=200)
    assert spark.read.parquet(f"{path}/segments").count() > 5
    got = {r.doc_id: bytes(r.ids) for r in token_store.read_token_files(spark, path).collect()}
    assert got == {i: packed(ids_of(t) + [2]) for i, t in rows}


def test_empty_token_files(spark, tmp_path):
    path = str(tmp_path / "files")
    token_store.write_token_files(documents(spark, []), path)
    assert token_store.read_token_files(spark, path).count() == 0


def test_another_dictionary_is_refused(spark, tmp_path):
    path = str(tmp_path / "files")
    token_store.write_token_files(documents(spark, [(1, "a b")]), path)
    spark.createDataFrame([("0", bytearray(b"1"), 2)], "hash string, bytes binary, width int").write.mode("overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(ValueError):
        token_store.read_token_files(spark, path)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60), st.integers(1, 6))
def test_best_fit_is_best_fit(lengths, most):
    packer, open_, closed = packing.BestFit(20, most), [], 0
    for n in lengths:
        sequence, offset = packer.place(n)
        fitting = [b for b in open_ if b[1] >= n]
        if fitting:
            least = min(b[1] for b in fitting)
            mine = next(b for b in fitting if b[0] == sequence)
            assert mine[1] == least
        else:
            if len(open_) == most:
                least = min(b[1] for b in open_)
                gone = next(b for b in open_ if b[1] == least and b[0] not in {s for v in packer.by_space for s in v})
                open_.remove(gone)
            mine = [sequence, 20]
            open_.append(mine)
        assert offset == 20 - mine[1]
        mine[1] -= n
        if not mine[1]:
            open_.remove(mine)
    assert packer.now == len(open_) <= most


def test_cut():
    assert list(packing.cut(5, 8)) == [(0, 5)] and list(packing.cut(8, 8)) == [(0, 8)]
    assert list(packing.cut(19, 8)) == [(0, 3), (3, 8), (11, 8)] and list(packing.cut(16, 8)) == [(0, 8), (8, 8)]


def check_packing(rows, texts, capacity):
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset) against documents; returns the number of sequences."""
    want = []
    for doc_id, text in texts:
        ids = ids_of(text) + [0]
        want += [(doc_id, k, s, n, zlib.crc32(packed(ids[s:s + n]))) for k, (s, n) in enumerate(packing.cut(len(ids), capacity))]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_pack_documents(spark):
    rows = AWKWARD + [(1000 + i, "packing words " * random.Random(i).randrange(400)) for i in range(200)]
    df = packing.pack_documents(with_clashes(documents(spark, rows)), keep_ids=True)
    got = df.collect()
    n = check_packing(got, [(i, t) for i, t, *_ in rows], 2048)
    total = sum(r.length for r in got)
    assert n <= -(-total // 2048) + 2
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    few = packing.pack_documents(documents(spark, rows), capacity=64, open_sequences=4)
    check_packing(few.collect(), [(i, t) for i, t, *_ in rows], 64)
    assert packing.pack_documents(documents(spark, [])).count() == 0


def test_dictionary_is_trained_or_told_not_to_be(spark, tmp_path, monkeypatch):
    def described(rows, name):
        token_store.write_token_files(documents(spark, rows), str(tmp_path / name))
        return spark.read.parquet(f"{tmp_path / name}/dictionary").first()

    words = [(i, " ".join(f"w{(i * j) % 97}" for j in range(200))) for i in range(40)]
    trained = described(words, "trained")
    assert trained.samples == 40 and len(trained.bytes) >= token_store.LEAST_BYTES
    few = described(words[:3], "few")
    assert few.samples == 0 and len(few.bytes) == 0
    assert {r.doc_id: bytes(r.ids) for r in token_store.read_token_files(spark, str(tmp_path / "few")).collect()} == {
        i: packed(ids_of(t) + [2]) for i, t in words[:3]}
    monkeypatch.setattr(token_store, "LEAST_SAMPLES", 1)  # then the library's own error comes through
    with pytest.raises(Exception, match="cannot train"):
        described([(1, " ".join(["w1"] * 900))], "failing")


@pytest.mark.parametrize("text", ["", "a", "the same text " * 300])
def test_dictionary_of_equal_texts(spark, tmp_path, text):
    path = str(tmp_path / "files")
    token_store.write_token_files(documents(spark, [(i, text) for i in range(1000)]), path)
    got = token_store.read_token_files(spark, path).collect()
    assert sorted(r.doc_id for r in got) == list(range(1000)) and {bytes(r.ids) for r in got} == {packed(ids_of(text) + [2])}
