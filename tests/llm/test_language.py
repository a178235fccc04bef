"""Language identification: the automaton and the parser by brute force, predictions by held-out labels."""

import math
import zlib

import numpy as np

from pulsegrid.llm import language
from pulsegrid.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, bits string"


def plain_phrases(raw, text):
    """Left to right, the longest phrases of ``raw`` that occur in ``text``; an unknown byte is a phrase."""
    n, at = 0, 0
    while at < len(raw):
        size = 1
        while at + size < len(raw) and raw[at:at + size + 1] in text:
            size += 1
        at, n = at + size, n + 1
    return n


def test_phrases(rng):
    text = bytes(rng.choice(list(b"abc "), 400).tolist())
    docs = [bytes(rng.choice(list(b"abcd "), n).tolist()) for n in (0, 1, 5, 200, 700, 1300)]
    got = language.bits(docs, (("x", text),))[:, 0]
    for raw, cost in zip(docs, got):
        pieces = [raw[k:k + language.PIECE] for k in range(0, len(raw), language.PIECE)]
        want = sum(plain_phrases(p, text) for p in pieces) * math.log2(len(text)) / max(1, len(raw))
        assert math.isclose(cost, want, abs_tol=1e-9)


def test_cases(spark):
    learned = {"aa": b"lorem ipsum dolor sit amet", "bb": b"quick brown foxes jump over"}
    rows = [(1, "Lorem ipsum!", None, "x"), (2, "brown foxes", "aa", "x"), (3, None, "aa", "x"), (4, "123 ?!", "aa", "x"), (5, "", "aa", "x"),
            (None, "dolor " * 30_000, "bb", "x"), (2, "brown foxes", "aa", "x"), (6, "漢字", None, "x")]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in language.predict(docs, learned).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3, 4, 5, None, 6)] == ["aa", "bb", "und", "und", "und", "aa", "aa"]
    assert all(0 <= r.score <= 1 for r in got.values()) and got[3].score == 0
    assert language.predict(docs, learned).count() == len(rows)
    assert {r.lang_pred for r in language.predict(docs, {}).collect()} == {"und"}
    assert language.judged(docs, learned).columns == ["doc_id", "text", "lang", "lang_pred", "score", "bits"]
    assert language.learn(docs.limit(0)) == {} and language.predict(docs.limit(0), learned).count() == 0


def test_learns_only_from_kept_labels(spark):
    rows = [(i, f"word{'x' * (i % 7)} number", "aa") for i in range(40)] + [(i, "never seen zzz", None) for i in range(40, 60)]
    rows += [(i, "qqq qqq", "held") for i in range(60, 200) if zlib.crc32(str(i).encode()) % 5 == 0]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(model) == {"aa"} and b"zzz" not in model["aa"]


def test_columns_of_the_same_names(spark):
    learned = {"aa": b"lorem ipsum dolor sit amet", "bb": b"quick brown foxes jump over"}
    rows = [(1, "Lorem ipsum!", 7, "own", True), (2, None, 8, "own", None), (3, "123", None, None, None), (4, "\u6f22" * 300, 9, None, False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int, LANG_PRED string, bits boolean")
    kept = language.accepted(docs, learned)
    # A long text that no language explains is in the nearest one like any other.
    assert kept.schema == docs.schema and sorted(map(tuple, kept.collect())) == [rows[0], rows[3]]
    # Without a labelled row texts without a letter go all the same.
    assert sorted(map(tuple, language.accepted(docs, {}).collect())) == [rows[0], rows[3]]


def test_every_language_is_in_the_sample(spark):
    rows = [(i, f"long{i} " * 15_000, "long") for i in range(1, 9)] + [(i, f"short text number {i} " * 30, "short") for i in range(20, 2000)]
    rows += [(i, f"only {i}", f"dirty{i:03d}") for i in range(3000, 3300)]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {"long", "short"} <= set(model) and len(model) == language.LANGUAGES
    assert sum(map(len, model.values())) <= language.MODEL_BYTES


def test_held_out_accuracy(spark, sf_dir):
    sf = sf_dir.replace("0.001", "0.01")
    labels = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op9_language"](spark, sf).collect()]
    assert len(rows) == len(labels) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([labels[r.doc_id] == r.lang_pred for r in rows if r.held_out]) >= 0.98
