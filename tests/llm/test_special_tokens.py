"""Strings of special tokens in a text, against the tokenizer as it is loaded."""

from __future__ import annotations

import random

import numpy as np
import pytest
from test_operators import BYTE_BPE, WORD_BPE, prose
from tokenizers import Tokenizer

from strata.llm.packing import pack_sequences
from strata.llm.token_store import read_tokens, write_tokens
from strata.llm.tokens import Encoder

LITERALS = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "<|end oftext|>"]


def texts():
    rng = random.Random(31)
    glue = ["", " ", "  ", "\n", "\n\n", " \n", "\t", ".", ", ", "a", "Z ", "é", "́", "'s", "3", "\0", "\x85"]
    out = ["a <|endoftext|> b"] + LITERALS
    for _ in range(400):
        out.append("".join(rng.choice(glue) + rng.choice([*LITERALS, prose(rng, 2)]) + rng.choice(glue) for _ in range(rng.randint(1, 6))))
    return out


def plain(path, rows, end=()):
    t = Tokenizer.from_file(path)
    return [np.array([*t.encode(x, add_special_tokens=False).ids, *end], "<u4").tobytes() for x in rows]


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_encoder(path):
    assert Encoder(path, known=50).encode(texts()) == plain(path, texts())


def test_known_ids():
    ids = [np.frombuffer(Encoder(p).encode(["a <|endoftext|> b"])[0], "<u4").tolist() for p in (BYTE_BPE, WORD_BPE)]
    assert ids == [[64, 220, 50256, 275], [320, 49407, 321]]


def test_op4_op5(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string").repartition(3)
    path = str(tmp_path / "store")
    write_tokens(docs, path, BYTE_BPE, 0)
    want, at = plain(BYTE_BPE, texts(), [0]), 0
    for r, x in zip(sorted(read_tokens(spark, path).collect(), key=lambda r: r["doc_id"]), want, strict=True):
        assert (r["start"], bytes(r["ids"])) == (at, x)
        at += len(x) // 4
    whole = {}
    for r in sorted(pack_sequences(docs, WORD_BPE, 1, length=64).collect(), key=lambda r: (r["doc_id"], r["start"])):
        whole[r["doc_id"]] = whole.get(r["doc_id"], b"") + bytes(r["ids"])
    assert [whole[i] for i in range(len(whole))] == plain(WORD_BPE, texts(), [1])
