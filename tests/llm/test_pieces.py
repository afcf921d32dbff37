"""Pieces of the encoder: cut before they are looked up, a bounded part of the texts at a time."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strata.llm import tokens
from strata.llm.token_store import pack_ids, unpack_ids

BYTE_BPE, WORD_BPE = map(public_tokenizers.path, ("byte_bpe_50k.json", "word_bpe_49k.json"))


def test_pieces_end_at_punctuation_and_newlines():
    pieces, sizes = tokens.split_texts(["the end.\nThe next, straße! 3.14 a.b", "x  y.", ""])
    assert pieces.to_pylist() == ["the", " end", ".", "\n", "The", " next", ",", " straße", "!", " 3.14", " a", ".b", "x  y."]
    assert sizes == [12, 1, 0]


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_odd_texts_equal_the_library(path):
    rng, whole = random.Random(7), Tokenizer.from_file(path)
    signs = ["a", "The", "straße", "É", "z", " ", " ", "  ", "\n", "\n", " ", "\x0b", "\x85", " ", ".", ",", "...", "!", "3.14", "Ġ", "Ãł",
             "é", "́", "İ", "ſ", "ß", "'s", "<|endoftext|>", "\0", "日本", "ﬁ", "</w>", "\r\n"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(1500)]
    got = tokens.Encoder(path, known=50).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_lots_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "GROUP", 10)
    texts = pa.array(["aaaa", None, "bbbbbb", "c", "é" * 20, "", "d"])
    got = list(tokens.lots(texts))
    assert got == [(0, 3), (3, 1), (4, 1), (5, 2)]
    assert list(tokens.lots(pa.array([], pa.string()))) == []
    assert list(tokens.lots(texts.slice(2, 3))) == [(0, 2), (2, 1)]


def test_ids_come_back_from_the_shuffle():
    for ids in ([], [0], [65535, 1], [65536, 7]):
        raw = np.array(ids, "<u4").tobytes()
        assert all(unpack_ids(pack_ids(raw, squeeze)).tobytes() == raw for squeeze in (True, False))
