"""Forced-boundary coding next to the library's own, whole texts at once."""

import hashlib

import numpy as np
import pytest
import tokenizers

from pulsegrid.llm import bpe
from pulsegrid.llm.queries import QUERIES, tokenizer_path

TEXTS = [None, "", " ", "a", "Hello world  \n\t x", "it's we'LL they've", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>",
         "naïve ÉCOLE 漢字 🙂‍↔️ ३½²", "x" * 30_000, "   　\x1c\x1f y\r\n", "\x00\x01é​", "a b " * 5000, "a b " * 5000]


def theirs(text):
    lib = tokenizers.Tokenizer.from_file(tokenizer_path())
    ids = lib.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), lib.decode(ids, skip_special_tokens=False)


def test_coding(spark):
    docs = spark.createDataFrame([(i if i else None, t, b"") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids binary")
    got = bpe.decode(bpe.encode(docs, tokenizer_path()), tokenizer_path()).collect()
    assert sorted((r.doc_id or 0, bytes(r.ids), r.text) for r in got) == [(i, *theirs(t)) for i, t in enumerate(TEXTS)]
    assert bpe.encode(docs.limit(0), tokenizer_path()).count() == 0


def test_random_texts():
    own, rng = bpe.coder(tokenizer_path()), np.random.default_rng(3)
    lib = tokenizers.Tokenizer.from_file(tokenizer_path())
    letters = list("abz '.,!\n\t\r\x1c\x85  éÉ漢🙂٣½﻿ᲊ") + ["<|endoftext|>", "'s", "th", "ing"]
    for _ in range(4000):
        text = "".join(rng.choice(letters, rng.integers(0, 12)))
        ids = lib.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == np.array(ids, "<u4").tobytes(), text
    for _ in range(1000):
        ids = rng.integers(0, 50257, 4).tolist()
        assert own.decode(np.array(ids, "<u4").tobytes()) == lib.decode(ids, skip_special_tokens=False)


def test_cuts_are_certain():
    own = bpe.coder(tokenizer_path())
    tokens = {b for b in own.bytes_of}
    raw = "übermäßig,qzx".encode()
    cuts = own.cuts(raw)
    assert cuts and all(not any(raw[c - 1:c + 1] in t for t in tokens) for c in cuts)


@pytest.mark.parametrize("name", ["op6_bpe"])
def test_query(spark, sf_dir, name):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES[name](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids, text = theirs(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
