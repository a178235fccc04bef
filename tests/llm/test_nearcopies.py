"""Near copies next to brute-force Jaccard similarities."""

import corpus_pipeline
import pytest

from pulsegrid.llm import nearcopies

DOCS = "doc_id long, text string, _row string, n int"


def plain_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain_kept(docs):
    """The smallest id of each component, all pairs compared."""
    ids, sets = sorted(docs), {k: plain_set(t) for k, t in docs.items()}
    root = dict(zip(ids, ids))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for i, a in enumerate(ids):
        for b in ids[:i]:
            union = len(sets[a] | sets[b])
            if not union or len(sets[a] & sets[b]) / union >= 0.8:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k for k in ids if find(k) == k}


@pytest.mark.parametrize("block", [3, 512])
def test_against_all_pairs(spark, rng, block):
    docs = {}
    for g in range(25):
        words = [f"w{g}x{i}" for i in range(int(rng.integers(40, 400)))]
        for _ in range(8):
            some = list(words)
            for at in rng.choice(len(words), int(rng.integers(0, max(2, len(words) // 35))), replace=False).tolist():
                some[at] = f"n{rng.integers(1 << 40)}"
            docs[len(docs)] = " ".join(some)
    docs |= {1000: "One two", 1001: "one  TWO", 1002: "", 1003: None, 1004: "a b c d e f g h", 1005: "a b c d e f g h i", 1006: "three"}
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in docs.items()], DOCS)
    kept = nearcopies.one_of_each(frame, block=block)
    assert kept.columns == frame.columns
    want = plain_kept(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want) and 30 < len(want) < 150


def test_stage_against_all_pairs(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = plain_kept({r.doc_id: r.text for r in frame.collect()})
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, frame, sf_dir).collect()) == sorted(want)


def test_rows_and_ids(spark):
    base = " ".join(f"word{i}" for i in range(120))
    rows = [(5, base), (3, base), (3, base), (None, base), (None, "alone"), (None, "alone"), (9, base + " end"), (7, "quite other words"), (8, None)]
    frame = spark.createDataFrame([(d, t, "x", i) for i, (d, t) in enumerate(rows)], DOCS)
    kept = nearcopies.one_of_each(frame).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in kept) == [(-1, "alone"), (3, base), (7, "quite other words"), (8, "")]
    assert nearcopies.one_of_each(frame.limit(0)).count() == 0


def test_one_id_with_two_texts(spark, sf_dir):
    base = " ".join(f"word{i}" for i in range(120))
    rows = [(1, base), (6, base + " end"), (6, "a clean text of its own"), (7, "first of two"), (7, "another one entirely")]
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], DOCS)
    kept = sorted((r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, frame, sf_dir).collect())
    assert kept == sorted([(1, base), (6, "a clean text of its own"), (7, "first of two"), (7, "another one entirely")])


def test_hot_key_takes_linear_rows(spark, monkeypatch):
    """Pages of one template: a comparison or two for each, whatever their number, and none left for pairs of blocks."""
    rows, stored = {}, nearcopies.stored

    def counted(df, purpose):
        out = stored(df, purpose)
        rows.setdefault(purpose, []).append(out.count())
        return out
    monkeypatch.setattr(nearcopies, "stored", counted)
    n, template = 20_000, " ".join(f"word{i}" for i in range(120))
    docs = spark.range(n).selectExpr("id AS doc_id", f"concat('page ', id, ' {template} by author ', id * 7, ' ') AS text")
    docs = docs.unionByName(spark.createDataFrame([(n + i, f"some{i} " * 30) for i in range(5)], "doc_id long, text string"))
    assert sorted(r.doc_id for r in nearcopies.one_of_each(docs).collect()) == [0, *range(n, n + 5)]
    assert rows["nodes"] == [n + 5] and sum(rows["pairs"]) <= 2 * n and rows["open"] == [0]


def test_chains_are_followed_to_the_end(spark, rng):
    """Texts that drift: neighbours are alike, both ends are not."""
    words = [f"w{i}" for i in range(100)]
    docs = {}
    for i in range(60):
        words[(7 * i) % 100] = f"n{i}"
        docs[i] = " ".join(words)
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in docs.items()], DOCS)
    assert sorted(r.doc_id for r in nearcopies.one_of_each(frame, block=4).collect()) == sorted(plain_kept(docs))


def test_pigeonring_pairs_are_compared(spark, monkeypatch):
    """Close copies come from the fingerprints; the filter's pairs that are no near copies give no link."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join([*words, "end"]), " ".join([*words, "more"]), " ".join(f"x{i}" for i in range(400)), "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # Without any key in common only the ring is left.
    monkeypatch.setattr(nearcopies, "_members", lambda nodes: nodes.selectExpr("CAST(0 AS BIGINT) AS key", "0 AS band", "node", "size").limit(0))
    assert sorted(r.doc_id for r in nearcopies.one_of_each(docs).collect()) == [0, 3, 4]


def test_later_turns_work_on_roots(spark, rng, monkeypatch):
    """Once all is linked no components are formed again, and later links are between roots."""
    asked, components = [], nearcopies.components

    def counted(edges):
        asked.append([tuple(r) for r in edges.collect()])
        return components(edges)
    monkeypatch.setattr(nearcopies, "components", counted)
    words = [f"w{i}" for i in range(400)]
    docs = {0: " ".join(words), 1: " ".join([*words, "end"]), 2: " ".join([*words, "more"])}
    kept = nearcopies.one_of_each(spark.createDataFrame(list(docs.items()), "doc_id long, text string"))
    assert [r.doc_id for r in kept.collect()] == [0] and len(asked) == 1
    # Families of close copies whose heads are looser ones: the families are joined by few links.
    asked.clear()
    docs = {}
    for k in range(6):
        own = [f"n{k}x{i}" if i % 60 == k else w for i, w in enumerate(words)]
        docs |= {100 * k + i: " ".join([*own, f"e{k}x{i}"]) for i in range(10)}
    kept = nearcopies.one_of_each(spark.createDataFrame(list(docs.items()), "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(plain_kept(docs))
    first, later = asked[0], [e for links in asked[1:] for e in links]
    assert len(first) >= 50 and later and len(set(later)) < 20
