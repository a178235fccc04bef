"""Repeated passages next to a plain version that looks at every string."""

import hashlib
from collections import Counter

import pytest

from pulsegrid.llm import suffixes
from pulsegrid.llm.queries import QUERIES

DOCS = "doc_id long, text string, spans string, row string"


def plain(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(r, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def got(spark, texts, length, spread):
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], DOCS).repartition(3)
    rows = suffixes.digests(suffixes.without_repeats(frame, length=length, spread=spread)).collect()
    return [tuple(r)[1:] for r in sorted(rows, key=lambda r: r.doc_id)]


def mixed(rng, n, unit):
    """Texts pieced together of shared passages, own text, periodic text and long runs of a letter."""
    letters = list("abcdefgh ü")
    make = lambda k: "".join(rng.choice(letters, k))
    passages = [make(int(k)) for k in rng.integers(unit // 2, unit * 4, 6)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.integers(0, 6)):
            kind = rng.integers(0, 5)
            p = passages[rng.integers(0, 6)]
            parts.append([make(int(rng.integers(1, unit * 2))), p, p[3:-2], "ab" * int(rng.integers(1, unit)), "a" * int(rng.integers(1, unit * 2))][kind])
        texts.append("".join(parts))
    return texts + [None, "", "x", texts[0], texts[0], texts[1] + "z"]


@pytest.mark.parametrize(("length", "spread"), [(40, 10), (60, 24)])
def test_against_all_strings(spark, rng, length, spread):
    texts = mixed(rng, 24, length)
    assert got(spark, texts, length, spread) == plain(texts, length)


def test_production_length(spark, rng):
    texts = mixed(rng, 12, 400)
    assert got(spark, texts, 400, 100) == plain(texts, 400)


def test_long_text_in_segments(spark, rng, monkeypatch):
    raw = bytes(rng.choice(list(b"abcd"), 5000).tolist()) + b"a" * 900
    whole = list(suffixes.batch_runs([raw]))
    monkeypatch.setattr(suffixes, "SEGMENT", 700)
    assert list(suffixes.batch_runs([raw])) == whole
    several = [raw[:450], raw[100:800], b"", raw[5:405]]
    assert list(suffixes.batch_runs(several)) == [(k, *r[1:]) for k, x in enumerate(several) for r in suffixes.batch_runs([x])]


def test_null_ids_and_empty_table(spark, rng):
    one = "".join(rng.choice(list("abcdef"), 500))
    frame = spark.createDataFrame([(None, one, "", ""), (None, one, "", ""), (1, one[:450], "", ""), (2, None, "", "")], DOCS)
    rows = suffixes.digests(suffixes.without_repeats(frame)).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in rows) == [(0, 0), (450, 450), (500, 500), (500, 500)]
    assert suffixes.without_repeats(frame.limit(0)).count() == 0


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = dict(zip([k for k, _ in docs], plain([t for _, t in docs], 400)))
    rows = QUERIES["op8_suffixes"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want and len(rows) == len(docs)
