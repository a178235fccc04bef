"""Exact top-k next to all inner products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import mtree
from pulsegrid.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, score string, rank int"


def plain(rows, every, k):
    kept = {(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for i, q in kept:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in kept if j != i)
            out |= {(i, r, j, -s) for r, (s, j) in enumerate(scored[:k], 1)}
    return out


def got(spark, rows, every=5, k=5):
    frame = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", 9) for i, v in rows], VECTORS)
    out = mtree.top_k(frame, F.col("vec_id") % every == 0, k=k).collect()
    assert len(out) == len(set(out))
    return {tuple(r) for r in out}


@pytest.mark.parametrize(("n", "dims", "blocks"), [(600, 8, 40), (300, 64, 1 << 15)])
def test_against_all_pairs(spark, rng, monkeypatch, n, dims, blocks):
    monkeypatch.setattr(mtree, "BLOCK", blocks)
    monkeypatch.setattr(mtree, "QUERIES", 50)
    monkeypatch.setattr(mtree, "PIVOTS", 6)
    centres = rng.normal(0, 1, (5, dims))
    vectors = centres[rng.integers(0, 5, n)] * rng.uniform(0.1, 1.5, (n, 1)) + rng.normal(0, 0.05, (n, dims))
    vectors[100:160] = vectors[100]
    vectors[200] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    assert got(spark, rows) == plain(rows, 5, 5)


def test_cases(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (5, None), (10, [None, 1.0]), (15, [float("nan"), 0]), (20, [float("inf"), 0]), (None, [1.0, 1.0]),
            (25, [0.5]), (-5, [-1.0, -1.0, 2.0]), (1, []), (2, [0.999, -0.001])]
    padded = [(i, None if v is None else v + [0.0] * (3 - len(v))) for i, v in rows]
    assert got(spark, rows) == plain(padded, 5, 5)
    assert got(spark, []) == set()
    assert got(spark, [(0, [1.0])]) == set()
    assert got(spark, [(0, []), (5, []), (7, [])], k=2) == {(0, 1, 5, 0), (0, 2, 7, 0), (5, 1, 0, 0), (5, 2, 7, 0)}


def test_large_components_stay_exact(spark):
    rows = [(i, [float(np.float32(3e5 + i * 37)), float(np.float32(2e5 - i * 11))]) for i in range(40)]
    assert got(spark, rows) == plain(rows, 5, 5)


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert {tuple(r) for r in QUERIES["op2_mtree"](spark, sf_dir).collect()} == plain(rows, 50, 5)
