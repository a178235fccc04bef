"""Hard negatives next to all pairs, and the intervals next to the products they hold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import hardnegatives as h
from pulsegrid.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string, score string"


def plain(rows, anchors, k=5, n=10, lower=30, upper=90):
    """All pairs. ``rows`` are (id, vector, label)."""
    taken = {}
    for id, vector, label in rows:
        if id is not None and label is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            mine = (label, [int(np.floor(256 * np.float64(np.float32(x)))) for x in vector])
            taken[id] = min(taken.get(id, mine), mine)
    width = max((len(v) for _, v in taken.values()), default=0)
    full = {id: np.array(v + [0] * (width - len(v)), np.int64) for id, (_, v) in taken.items()}
    out = set()
    for a in filter(anchors, taken):
        score = {id: int(full[a] @ full[id]) for id in taken if id != a}
        order = sorted(score, key=lambda id: (-score[id], id))
        for p in [id for id in order if taken[id][0] == taken[a][0]][:k]:
            good = [id for id in order if taken[id][0] != taken[a][0] and lower * score[p] <= 100 * score[id] <= upper * score[p]]
            out |= {(a, p, r, id, score[p], score[id]) for r, id in enumerate(good[:n], 1)}
    return out


@pytest.mark.parametrize("width, spread", [(64, 1.0), (70, 40.0), (3, 0.2), (200, 1e4)])
def test_intervals_hold_the_product(rng, width, spread):
    full = -(-width // 64) * 64
    x = h.padded((rng.normal(size=(300, width)) * spread * 256).astype(np.int64), full)
    x[:5] = 0
    q = np.concatenate([x[::10], x[:3] * 2, np.zeros((1, full), np.int64), np.ones((1, full), np.int64)])
    turn = h.rotation(full)
    assert np.allclose(turn @ turn.T, np.eye(full))
    for levels in (1, 3):
        codes, parts = h.encode(x, turn, levels)
        low, high = h.Anchors(q, turn).interval(slice(0, len(q)), codes, parts)
        truth = (x @ q.T).astype(float)
        assert (low <= truth).all() and (truth <= high).all()
        # Each level narrows the interval: after three it is far shorter than what lengths alone would say.
        lengths = np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(q, axis=1)
        assert ((high - low) / 2 <= lengths + 1).all() or levels == 1
        if levels == 3:
            assert np.median(((high - low) / 2)[lengths > 0] / lengths[lengths > 0]) < 0.35


def test_best_keeps_the_best(rng):
    best, all_ = h.Best(7, 4), []
    for _ in range(20):
        n = rng.integers(0, 30)
        slot, score, id = rng.integers(0, 7, n), rng.integers(-5, 5, n), rng.permutation(10_000)[:n]
        id = id + 10_000 * len(all_)
        best.add(slot, score, id)
        all_ += list(zip(slot.tolist(), score.tolist(), id.tolist()))
    want = [t for s in range(7) for t in sorted((x for x in all_ if x[0] == s), key=lambda t: (-t[1], t[2]))[:4]]
    assert [(a, c, b) for a, b, c in zip(*(x.tolist() for x in best.rows()))] == want


def test_against_all_pairs(spark, rng, monkeypatch):
    centres = rng.normal(size=(4, 20))
    rows = []
    for i in range(900):
        c = rng.integers(0, 4)
        rows.append((i, (centres[c] + rng.normal(size=20) * 0.7).astype(np.float32).tolist(), int(c if rng.random() < 0.8 else rng.integers(0, 4))))
    rows += [(2000 + i, rows[i][1], rows[i][2] + i % 2) for i in range(300)]  # equal vectors: ties
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    want = plain(rows, lambda id: id % 20 == 0)
    assert want
    for blocks in (1 << 24, 576 * 10):
        got = h.mine(frame, F.col("vec_id") % 20 == 0, anchor_bytes=blocks)
        found = [tuple(r) for r in got.collect()]
        assert set(found) == want and len(found) == len(want)


def test_most_pairs_are_not_scored(rng, monkeypatch):
    """In clusters, a part of the pairs is scored; counts what the interval leaves."""
    centres = rng.normal(size=(20, 64))
    x = h.padded((256 * (centres[np.arange(2000) % 20] + 0.2 * rng.normal(size=(2000, 64)))).astype(np.int64), 64)
    rows = {"id": np.arange(2000), "label": np.arange(2000) // 20 % 2, "x": x}
    rows["codes"], rows["parts"] = h.encode(x, h.rotation(64))
    block = {k: rows[k][::50] for k in ("id", "label", "x")}
    scored, score = [], h.scores
    monkeypatch.setattr(h, "scores", lambda x, i, q, j: scored.append(len(i)) or score(x, i, q, j))
    best = h.Best(40, 5)
    h.positives(block, rows, h.Anchors(block["x"], h.rotation(64)), best)
    assert sum(scored) < 0.04 * 40 * 2000  # half of the rows have the label, a twentieth is of the cluster
    truth = rows["x"] @ block["x"].T
    for a in range(40):
        mine = [i for i in range(2000) if i // 20 % 2 == block["label"][a] and i != block["id"][a]]
        assert best.id[a].tolist() == sorted(mine, key=lambda i: (-truth[i, a], i))[:5]


def test_hostile_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [9.0, 9.0], 2), (1, [1.0, 1.0], 1), (2, [1.0], 2), (3, [], 3), (4, None, 1), (5, [1.0, None], 2),
            (6, [nan, 1.0], 2), (7, [inf, 1.0], 2), (8, [0.5, 0.25], None), (None, [0.5, 0.5], 2), (9, [0.5, 0.5], 2), (10, [-1.0, -2.0], 1),
            (20, [0.0, 0.0], 1), (30, [5.0, 0.0], 9), (11, [1.0, 0.2], 2), (12, [0.4, 0.6], 3)]
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    got = h.mine(frame, F.col("vec_id") % 10 == 0).collect()
    assert {tuple(r) for r in got} == plain(rows, lambda id: id % 10 == 0) and got
    for empty in (frame.limit(0), frame.filter("vec_id in (4, 5)"), frame.filter("vec_id = 1")):
        assert h.mine(empty, F.col("vec_id") % 10 == 0).count() == 0


def test_query(spark, sf_dir):
    sf = sf_dir.replace("0.001", "0.01")
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    moved = [(i, v, (l + 1) % 10 if l is not None and i is not None and i % 7 == 0 else l) for i, v, l in rows]
    got = QUERIES["op12_hardnegatives"](spark, sf)
    assert {tuple(r) for r in got.collect()} == plain(moved, lambda id: id % 100 == 0)
    assert dict(got.dtypes) == dict(anchor_id="bigint", positive_id="bigint", rank="int", negative_id="bigint", positive_score="bigint", negative_score="bigint")
