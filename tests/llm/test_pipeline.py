"""The pipeline next to a plain version of its stages, and on hostile tables."""

import hashlib

import corpus_pipeline
import tokenizers
import numpy as np
import pytest

from pulsegrid.llm import language, pii
from pulsegrid.llm.queries import tokenizer_path

from .test_decontaminate import plain as plain_matches
from .test_nearcopies import plain_kept

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_run(spark, docs, items):
    texts = {k: t for k, (t, _) in docs.items() if t and language.LETTER.search(t)}
    kept = plain_kept(texts)
    texts = {k: t for k, t in texts.items() if k in kept}
    hit = {k for k, _, _ in plain_matches(list(texts.items()), items)}
    texts = {k: t for k, t in texts.items() if k not in hit}
    model = pii.learn(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    lib, out = tokenizers.Tokenizer.from_file(tokenizer_path()), {}
    for k, t in texts.items():
        base = pii.base_spans(t)
        t = pii.redact(t, base + pii.added_spans(t, base, model, dict(model.weights)))
        ids = np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        out[k] = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    return out


def test_against_plain_version(spark, sf_dir):
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()
    docs = {r.doc_id: (r.text, r.lang) for r in read("documents")}
    want = plain_run(spark, docs, [(r.item_id, r.text) for r in read("benchmark")])
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want
    assert len(rows) == len(want) and 0 < len(want) < len(docs)


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.dtypes == docs.dtypes
        docs = out.limit(20)


@pytest.fixture
def folder(spark, tmp_path):
    def make(rows, items, schema=DOCUMENTS):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)
    return make


def test_hostile_rows(spark, folder):
    words = " ".join(f"word{'abcdefgh'[i % 8]}{i}x" for i in range(300))
    rows = [(1, words, "en", "a", 1), (2, words, "en", None, None), (3, None, "en", "a", 0), (4, "", None, "a", 0), (5, "12 34", "en", "a", 5),
            (None, "a text of its own without id", None, None, None), (6, "short text", "en", "a", 1), (6, "short text", "en", "a", 1),
            (7, "long " * 60_000, "de", "a", 1), (8, "mail me at a.b@example.org now", "de", "a", 1)]
    got = corpus_pipeline.run(spark, folder([(*r, "x", "y") for r in rows], [(1, None)], DOCUMENTS + ", _row string, score string")).collect()
    assert sorted(r.doc_id or -1 for r in got) == [-1, 1, 6, 7, 8]
    hidden = next(r for r in got if r.doc_id == 8)
    assert hidden.decoded_sha256 == hashlib.sha256(b"mail me at [EMAIL] now").hexdigest()


def test_long_runs_of_names_and_numbers(spark, folder):
    """The third stage takes lists of many thousand names or numbers."""
    texts = ["it was written by " + "Anna Bob Tom " * 10_000, "the numbers are " + ",".join(map(str, range(30_000))), "the early bus leaves the old town hall"]
    path = folder([(k, t, "en", "web", len(t)) for k, t in enumerate(texts)], [(1, "a slow train runs through long valleys to the river")])
    assert {r.doc_id for r in corpus_pipeline.run(spark, path).collect()} == {0, 1, 2}


def test_twice_in_one_session(spark, sf_dir):
    """A second run in the same workers gives the same rows."""
    first, second = (sorted((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, sf_dir).collect()) for _ in range(2))
    assert first == second


def test_empty_tables(spark, folder):
    assert corpus_pipeline.run(spark, folder([], [])).count() == 0
