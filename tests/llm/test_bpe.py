import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from emolens.llm import bpe
from tests.llm.data import awkward, awkward_rows, empty

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def expected(t):
    return LIBRARY.encode(t or "", add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs", "Cn", "Co"], max_codepoint=0xFFFF), max_size=60))
def test_same_ids_as_the_library(t):
    ids = bpe.load(PATH).encode(t)
    assert np.frombuffer(ids, "<u4").tolist() == expected(t)
    assert bpe.load(PATH).decode(ids) == LIBRARY.decode(expected(t), skip_special_tokens=False)


@pytest.mark.parametrize("t", ["<|startoftext|>a<|endoftext|>", "don't WE'LL 12", "ΑΣ ΣΑΣ İ ß ﬁ", "a\x1cb\x1d \x1f", "x" * 400, "é" * 99])
def test_odd_texts(t):
    assert np.frombuffer(bpe.load(PATH).encode(t), "<u4").tolist() == expected(t)


def test_cuts_are_forced_and_lossless():
    enc = bpe.load(PATH)
    for piece in ("therefore", "?!?!", "日本語", "naïveté"):
        parts = enc.fragments(piece)
        whole = "".join(parts)
        assert len(whole) == len(piece.encode())
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        assert all((whole[c - 1], whole[c]) not in enc.joined for c in cuts)


def test_small_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 3)
    enc = bpe.BoundaryEncoder(PATH)
    for _, t, *_ in awkward_rows():
        assert np.frombuffer(enc.encode(t or ""), "<u4").tolist() == expected(t)


def test_digests(spark):
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip_digests(awkward(spark), PATH).collect())
    want = []
    for i, t, *_ in awkward_rows():
        ids = expected(t)
        want.append((i or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want)


def test_columns_and_empty_table(spark):
    rows = bpe.encode_column(awkward(spark), PATH, ["doc_id", "source"]).collect()
    assert sorted((r.doc_id or 0, len(r.ids)) for r in rows) == sorted((i or 0, 4 * len(expected(t))) for i, t, *_ in awkward_rows())
    assert bpe.round_trip_digests(empty(spark), PATH).count() == 0


def test_three_hundred_thousand_words_are_encoded_once(monkeypatch):
    enc = bpe.BoundaryEncoder(PATH)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(letters[n // 26 ** i % 26] for i in range(4)) for n in range(300_000)]
    texts = [" ".join(words[i:i + 10_000]) for i in range(0, len(words), 10_000)]
    first = [enc.encode(t) for t in texts]
    encoded = []
    merged = enc._merged
    monkeypatch.setattr(enc, "_merged", lambda pieces: encoded.extend(pieces) or merged(pieces))
    assert [enc.encode(t) for t in texts] == first
    assert not encoded


@pytest.mark.parametrize("room", [1, 5, 40, 10_000])
@pytest.mark.parametrize("block", [1, 7, 1000])
def test_words_of_all_lengths_and_neighbours(monkeypatch, room, block):
    monkeypatch.setattr(bpe, "CACHE", room * bpe.ENTRY)
    monkeypatch.setattr(bpe, "BLOCK", block)
    enc = bpe.BoundaryEncoder(PATH)
    white = " \t\n\x0b\x0c\r\x85\xa0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000"
    odd = ["a", "ß", "é", "7", "½", "'", "'s", "'re", "’", ".", ",", "»", "\x00", "\x1c", "\u200b", "日", "\U0001f600"]
    texts = ["", " ".join("x" * n + c for n in range(7, 18) for c in ("", "\x00", ".", "é")), white.join("ab"),
             *("b".join(["", *white, ""]), " ".join(a + b + c for a in odd for b in odd for c in ("", "z"))),
             "<|endoftext|>ab<|startoftext|> <|endoftext|><|endoftext|>", "abcdefghijklmnopqrstuvw " * 3]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in enc.encode_all(texts)] == [expected(t) for t in texts]
    assert enc.encode_all([]) == []
    assert enc._words._held <= room and enc._words._used <= 15 * room
