"""SimHash near-duplicates next to a brute-force version."""

import importlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pulsegrid.llm import simhash
from pulsegrid.llm.components import components
from pulsegrid.llm.queries import QUERIES

DOCS = "doc_id long, text string, component_id string, fp int"


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(fps):
    """The smallest key of each key's component, all pairs compared."""
    root = {k: k for k in fps}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    keys = sorted(fps)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def test_fingerprint():
    for text in ["", " \t\n", "One", "A b  C", "a b c d", "Ä ß a b c d e f\x0bg h   i", "x y z w " * 50]:
        assert simhash.fingerprint(text.encode())[0] & (1 << 64) - 1 == plain_fingerprint(text), text


def test_documents(spark):
    words = [f"w{i}" for i in range(200)]
    base = " ".join(words)
    rows = [(7, None, "x", 1), (3, "", "x", 1), (5, "  ", "x", 1), (10, base, None, None), (12, base, None, None), (12, base, None, None),
            (11, base.replace("w100 ", "other "), None, None), (20, "quite another text", None, None), (None, base, None, None),
            (30, "a" * 200_000, None, None)]
    out = simhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.component_id) for r in out)
    fps = {k: plain_fingerprint(next(t for d, t, *_ in rows if d == k)) for k in {d for d, *_ in rows if d is not None}}
    want = brute(fps)
    assert got == sorted([(d if d is not None else -1, want[d] if d is not None else want[10]) for d, *_ in rows])
    assert {r.fingerprint for r in out if r.doc_id == 10} == {f"{fps[10]:016x}"}


def test_no_documents(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("block", [3, 1024])
def test_links_against_all_pairs(spark, rng, block):
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    found = set()
    for c in centres.tolist():
        for _ in range(25):
            x = c
            for b in rng.choice(64, rng.integers(0, 7), replace=False).tolist():
                x ^= 1 << b
            found.add(x)
    fps = {int(np.uint64(x).view(np.int64)): x for x in found}
    want = brute(fps)
    edges = simhash.links(spark.createDataFrame([(k, [k]) for k in fps], "node long, fps array<bigint>"), block=block)
    assert all((fps[a] ^ fps[b]).bit_count() <= 4 for a, b in edges.collect())
    got = {r.node: r.root for r in components(edges).collect()}
    assert {k: got.get(k, k) for k in fps} == want


@pytest.mark.parametrize("tables", [3, 12])
def test_tables_against_all_pairs(spark, rng, tables):
    sigs = []
    for _ in range(10):
        centre = rng.integers(0, 1 << 63, tables, dtype=np.uint64)
        for _ in range(20):
            flips = rng.random((tables, 64)) < 0.07
            # In most signatures only the last tables come close, so each table is seen to work.
            flips[:rng.integers(0, tables)] |= rng.random(64) < 0.3
            flips = np.packbits(flips, axis=1, bitorder="little").view(np.uint64).ravel()
            sigs.append((centre ^ flips).tolist())
    most = 8 * tables
    nodes = [(i, np.array(x, np.uint64).view(np.int64).tolist()) for i, x in enumerate(sigs)]
    edges = simhash.links(spark.createDataFrame(nodes, "node long, fps array<bigint>"), most=most, block=8)
    got = {r.node: r.root for r in components(edges).collect()}
    root = list(range(len(sigs)))
    changed = True
    while changed:
        changed = False
        for i, x in enumerate(sigs):
            for j, y in enumerate(sigs[:i]):
                d = [(a ^ b).bit_count() for a, b in zip(x, y)]
                if min(d) <= 4 and sum(d) <= most and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    assert [got.get(i, i) for i in range(len(sigs))] == root and len(set(root)) < len(sigs)


def test_one_of_each(spark):
    base = " ".join(f"word{i}" for i in range(120))
    rows = [(5, base), (3, base), (3, base), (None, base), (None, "alone"), (None, "alone"), (9, base + " end"), (7, "quite other words"), (8, None)]
    frame = spark.createDataFrame([(d, t, "x", i) for i, (d, t) in enumerate(rows)], DOCS)
    kept = simhash.one_of_each(frame, shingle=5, tables=6, most=72)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or -1, r.text or "") for r in kept.collect()) == [(-1, "alone"), (3, base), (7, "quite other words"), (8, "")]


def test_same_without_broadcast(spark, monkeypatch):
    base = " ".join(f"word{i}" for i in range(120))
    rows = [(i, base if i % 3 else f"{base} {i}", None, None) for i in range(30)] + [(100 + i, f"text {i} of its own " * 9, None, None) for i in range(20)]
    frame = spark.createDataFrame(rows, DOCS)
    got = lambda: (sorted(map(tuple, simhash.near_duplicates(frame).collect())), sorted(r.doc_id for r in simhash.one_of_each(frame).collect()))
    with_broadcast = got()
    monkeypatch.setattr(simhash, "sized", lambda table, row_bytes: table.hint("merge"))
    assert got() == with_broadcast


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    fps = {k: plain_fingerprint(t) for k, t in docs.items()}
    rows = QUERIES["op1_simhash"](spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {k: (f"{fps[k]:016x}", c) for k, c in brute(fps).items()}
    assert len(rows) == len(docs)


def test_components(spark, rng):
    pairs = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(5, 5), (200, 201), (201, 200)]
    edges = spark.createDataFrame(pairs, "a long, b long").repartition(4, F.rand(1))
    got = {r.node: r.root for r in components(edges).collect()}
    want = {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert got == want
    assert components(edges.limit(0)).count() == 0


def test_few_edges_take_few_files(spark, monkeypatch):
    """Tables of a few edges have one file, whatever the number of shuffle partitions; a round writes four."""
    module, files = importlib.import_module("pulsegrid.llm.components"), []
    stored = module.stored

    def counted(df, purpose):
        out = stored(df, purpose)
        files.append(len(out.inputFiles()))
        return out
    monkeypatch.setattr(module, "stored", counted)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.node: r.root for r in components(spark.range(200).selectExpr("id AS a", "id + 1 AS b")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == dict.fromkeys(range(201), 0)
    assert len(files) > 4 and len(files) % 4 == 1 and set(files[1:]) == {1}
