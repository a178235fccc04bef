"""Token counts next to the libraries' own, over whole texts."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pulsegrid.llm import tokencounts as t
from pulsegrid.llm.queries import QUERIES, tokenizer_path

HARD = [
    "", " ", "\n\n", "a", "  two  blanks  ", "line\r\nend\n\n  next", "it's we'll 'tis ' s", "<|endoftext|>", "x <|endoftext|> y<|endoftext|>\n",
    "<|endof text|>", " 　wide blank \u0085 next\x1c line", "a​b c", "漢字かな 交じり文。次", "é é ́ x", "🙂🙂 🙂", "tab\tand \t mix\t",
    "12 345  6,7", "a" * 500, " " * 300, "▁ sign ▁▁x", "ABC def " * 50, "</s> <s> x", "\x00 null \x00",
]


def plain(path):
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        coder = SentencePieceProcessor(model_file=path)
        return lambda text: len(coder.encode(text))
    coder = Tokenizer.from_file(path)
    coder.no_truncation()
    coder.no_padding()
    return lambda text: len(coder.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_parts_add_up(name, rng):
    path = public_tokenizers.path(name)
    coder, want = t.library(path), plain(path)
    alphabet = list("ab1.,'") + [" ", "  ", "\n", "\t", "\r\n", "'s", " the", " ", "　", "\u0085", "\x1c", "▁", "漢", "é", "🙂", "<|endoftext|>", "</s>"]
    texts = HARD + ["".join(rng.choice(alphabet, 60)) for _ in range(400)] + [" ".join(HARD) * 3]
    # Parts of a few characters cut at every safe place there is.
    for part in (1, 7, t.PART_CHARS):
        assert t.lengths(coder, texts, part, 200) == [want(x) for x in texts]
    assert (coder.cut is None) == (name == "word_bpe_49k.json")


def test_long_texts_are_cut():
    coder = t.library(tokenizer_path())
    parts = list(coder.parts("some words and more " * 10_000))
    assert len(parts) > 5 and max(map(len, parts)) < t.PART_CHARS + 20
    assert list(coder.parts("x" * 100_000)) == ["x" * 100_000]


def test_batches_are_balanced():
    sizes = [900, 10, 10, 500, 400, 30, 0, 100]
    found = t.balanced(sizes, 500)
    assert sorted(i for b in found for i in b) == list(range(len(sizes)))
    assert sorted(sum(sizes[i] for i in b) for b in found) == [150, 400, 500, 900]
    assert t.balanced([]) == [] and t.balanced([0, 0]) == [[0, 1]]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_words_are_encoded_once(name, rng, monkeypatch):
    path = public_tokenizers.path(name)
    coder, want = t.library(path), plain(path)
    given, count = [], coder.count
    monkeypatch.setattr(coder, "count", lambda texts: given.extend(texts) or count(texts))
    some = [f"word{i}" for i in range(50)] + ["L" * 100, "漢字かな", "it's", "x\ty"]
    texts = [" ".join(rng.choice(some, 300)) for _ in range(40)]
    assert t.lengths(coder, texts) == [want(x) for x in texts]
    assert len(given) < 300
    # Only long words are not kept.
    given.clear()
    assert t.lengths(coder, texts) == [want(x) for x in texts]
    assert all("L" * 100 in x for x in given) and len(given) < 40
    # What is kept is bounded, and texts of new words are encoded as they are.
    monkeypatch.setattr(t, "WORDS", 20)
    monkeypatch.setattr(t, "RUN_CHARS", 3000)
    assert t.lengths(coder, texts) == [want(x) for x in texts]
    given.clear()
    fresh = " ".join(f"{i}new" for i in range(1000))
    assert t.lengths(coder, [fresh, "", texts[0]]) == [want(fresh), 0, want(texts[0])] and fresh in given


def test_hostile_rows(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, "c", None), (2, None, "y"), (3, "", "z"), (4, "word " * 200_000, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    want = plain(tokenizer_path())
    got = t.count(docs, tokenizer_path(), limit=1024).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (k or -1, len(x or ""), want(x or ""), want(x or "") > 1024) for k, x, _ in rows)
    assert t.count(docs.limit(0), tokenizer_path()).count() == 0


def test_query(spark, sf_dir):
    want = plain(tokenizer_path())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op13_tokencounts"](spark, sf_dir)
    assert got.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    assert sorted(map(tuple, got.collect())) == sorted(
        (r.doc_id, len((r.text or "").encode()), n := want(r.text or ""), n > 1024) for r in docs)
