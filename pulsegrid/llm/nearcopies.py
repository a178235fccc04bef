"""Near copies by the Jaccard similarity of their sets of word shingles.

Two documents link if their sets of five-word shingles have a similarity of at least
``ALIKE``. Links are decided on the whole sets; signatures only say which pairs to look
at. A signature has ``BANDS`` keys, each made of ``WIDTH`` smallest hashes. Sets of a
similarity s share a key with a chance of s ** WIDTH each, so a pair at exactly 0.8 has
none in common with a chance of 1.3e-7, one at 0.85 of 6.5e-11.

Documents of the same set take part once. First come the pairs that the pigeonring filter finds, as in ``simhash``: sets
whose 64-bit fingerprints differ in at most four bits. Those are the close copies; at a similarity of 0.8 fingerprints
differ in about ten bits, so the keys do the rest. Then the members of a key are only compared with
one of them, its centre, which takes one comparison for each member and links most copies; this is
done twice, with other centres (``CENTRES`` are the keys that take part). Then keys whose members are not
yet in one component are gone through: members outside of the key's largest component are compared with
all of other components. Keys with many members, or long ones, are cut into blocks for that, and pairs of
blocks are compared apart. Pairs within a component are left out, which leaves components as they are.

Defined results: null texts and texts without a word have the same, empty set and link
with each other; texts of fewer words than a shingle have one shingle of all words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import BROADCAST_BYTES, by_arrow, groups, map_rows, sized, stored, unused, utf8
from pulsegrid.llm.components import components
from pulsegrid.llm.simhash import links

SHINGLE = 5
ALIKE = 0.8
SEED = 42
BANDS, WIDTH = 40, 5
CENTRES = (8, 40)
#: Members of a key that are compared at once, and shingles they have together; larger keys are cut into blocks of about this size.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
_TURNS = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * WIDTH), dtype=np.uint64)
_FACTORS, _ADDED = _TURNS[0] * np.uint64(2) + np.uint64(1), _TURNS[1]


def shingles(raw: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct hashes of a text's shingles of words, A-Z lower-cased, in rising order; none without a word."""
    words = raw.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(size) - 1
    starts = ends + 1 - size
    n = max(1, len(words) - shingle + 1)
    of = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((of(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist())), np.uint64, n))


def keys(found: np.ndarray) -> np.ndarray:
    """The keys of a set of shingles, none of an empty one."""
    if not len(found):
        return np.empty(0, np.int64)
    least = np.full(BANDS * WIDTH, np.uint64((1 << 64) - 1))
    for k in range(0, len(found), 2048):
        least = np.minimum(least, (np.multiply.outer(found[k:k + 2048], _FACTORS) + _ADDED).min(0))
    return np.array([xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(least.reshape(BANDS, WIDTH))], np.uint64).view(np.int64)


def fingerprint(found: np.ndarray) -> int:
    """The SimHash of a set of shingles, 0 of an empty one."""
    counts = np.zeros(64, np.int64)
    for k in range(0, len(found), 1 << 14):
        counts += np.unpackbits(found[k:k + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(found), bitorder="little").view(np.int64)[0])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*arrays, np.empty(0, np.int64)]).astype(np.int64)))


def signatures(rows: DataFrame) -> DataFrame:
    """``key, row, node, size, fp, bands`` for ``key, row, _text``: a digest of the set of shingles, its size, fingerprint and keys."""
    def work(batch):
        sets = [shingles(x) for x in batch["_text"].to_pylist()]
        return {"key": batch["key"], "row": batch["row"], "size": [len(s) for s in sets], "fp": [fingerprint(s) for s in sets], "bands": _lists([keys(s) for s in sets]),
                "node": pa.array(np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64))}
    return map_rows(rows, "key long, row long, node long, size long, fp long, bands array<bigint>", lambda: work)


def _crossing(root: np.ndarray, left: np.ndarray, ends: np.ndarray, values: np.ndarray, alike: float) -> list[tuple[int, int]]:
    """Links, named by their roots, of the ``left`` nodes with nodes of other roots; ``values`` between two ``ends`` are a node's set. Two roots that got linked are one."""
    size, starts = np.diff(ends), ends[:-1]
    terms, codes = np.unique(values, return_inverse=True)
    held = np.zeros(len(terms), bool)
    _, part = np.unique(root, return_inverse=True)
    edges = []
    for k in np.flatnonzero(left):
        other = part != part[k]
        # Sets of too different sizes cannot be alike.
        other &= np.minimum(size, size[k]) >= alike * np.maximum(size, size[k])
        if not other.any():
            continue
        own = codes[ends[k]:ends[k + 1]]
        held[own] = True
        common = np.add.reduceat(held[codes], starts, dtype=np.int64)
        held[own] = False
        for x in np.flatnonzero(other & (common / (size + size[k] - common) >= alike)):
            if part[x] != part[k]:
                edges.append((int(root[k]), int(root[x])))
                part[part == part[x]] = part[k]
    return edges


def _members(nodes: DataFrame) -> DataFrame:
    """``key, band, node, size`` for the keys that more than one node has.

    Most keys are a node's own. They are counted once, by key alone, and never dealt out again.
    """
    rows = nodes.select("node", "size", F.posexplode("bands").alias("band", "key"))
    shared = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "shared")
    return stored(rows.join(sized(shared, 24), "key"), "members")


def _keyed(members: DataFrame, bands: int, roots: DataFrame | None = None) -> DataFrame:
    """``key, node, size, root`` for the first ``bands`` keys of each node."""
    rows = members.filter(F.col("band") < bands)
    if roots is None:
        return rows.select("key", "node", "size", F.col("node").alias("root"))
    return rows.join(roots, F.col("node") == F.col("member"), "left").select("key", "node", "size", F.coalesce("root", "node").alias("root"))


def _blocks(n, size, block: int):
    """Blocks for ``n`` members of ``size`` shingles together. Beyond 32,768 blocks they grow instead of their number."""
    return F.least(F.lit(1 << 15), F.ceil(F.greatest(n / block, size / BLOCK_SHINGLES))).cast("int")


def _compared(nodes: DataFrame, texts: DataFrame, deals: DataFrame, again: DataFrame | None, alike: float) -> DataFrame:
    """Links between roots found where ``deals`` (``node, root, left, pair``) brings nodes together: the ``left`` ones of a pair meet all others of it.

    A node's set is made once, of its text, and goes from there to its pairs; neither texts nor sets are stored or dealt
    out by node in between. What says where is short, and is broadcast to the texts if it is small enough.
    ``again`` are the rows that are there more than once.
    """
    sent = deals.groupBy("node").agg(F.collect_set(F.struct("pair", "root", "left")).alias("sent"))
    wanted = stored(nodes.select("node", F.col("first.row").alias("row")).join(sent, "node"), "wanted")
    size = wanted.agg(F.sum(F.size("sent") * 40 + 80)).first()[0]
    if size is None:  # nothing to compare
        return nodes.sparkSession.range(0).selectExpr("id AS a", "id AS b")
    rows = texts.join(F.broadcast(wanted) if size <= BROADCAST_BYTES else wanted, "row")
    if again is not None:
        rows = rows.join(again, "row", "left_anti").union(rows.join(again, "row", "left_semi").dropDuplicates(["row"]))

    def work(batch):
        return {"node": batch["node"], "found": _lists([shingles(x).view(np.int64) for x in batch["_text"].to_pylist()]), "sent": batch["sent"]}

    sets = map_rows(rows.select("node", "sent", "_text"), "node long, found array<bigint>, sent array<struct<pair: bigint, root: bigint, left: boolean>>", lambda: work)
    spread = sets.select("node", "found", F.explode("sent").alias("s")).select("node", "s.*", "found")

    def run(batches):
        for group in groups(batches, "pair"):
            if len(group) > 1:
                found = group["found"].combine_chunks()
                found = found.chunk(0) if isinstance(found, pa.ChunkedArray) else found
                ends = np.concatenate([[0], np.cumsum(found.value_lengths().to_numpy(zero_copy_only=False))])
                edges = _crossing(group["root"].to_numpy(), group["left"].to_numpy(), ends, found.flatten().to_numpy(), alike)
                edges = np.array(edges, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], names=["a", "b"])

    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return by_arrow(spread.repartition(tasks, "pair").sortWithinPartitions("pair"), run, "a long, b long")


def _to_centres(members: DataFrame, bands: int, alike: float, block: int, turn: int, roots: DataFrame | None = None) -> DataFrame:
    """Deals that bring nodes to the centres of their keys: one comparison for each node.

    The centre of a key is its least node by a hash that ``turn`` chooses. A node is compared with the least centre
    of all its keys, of those that do not share its root already; so the copies of a text meet at few centres. The
    nodes of a centre are cut into blocks, and the centre goes to each.
    """
    rows = _keyed(members, bands, roots)
    order = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "root", "size")
    centres = rows.groupBy("key").agg(F.min(order).alias("c"), F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    fits = F.expr("root <> c.root") & (F.least("size", "c.size") >= F.lit(alike) * F.greatest("size", "c.size"))
    pairs = rows.join(centres.select("key", "c"), "key").filter(fits).groupBy("node", "root", "size").agg(F.min("c").alias("c"))
    return _dealt(pairs.select("node", "root", "size", F.col("c.node").alias("centre"), F.col("c.root").alias("its")), block)


def _on_ring(nodes: DataFrame, alike: float, block: int) -> DataFrame:
    """Deals that bring nodes to the least of those that the pigeonring filter links them with: at most one comparison for each node."""
    some = nodes.filter("size > 0").select("node", "size", "fp")
    # Sets of the same fingerprint go through the filter once; the least of them stands for it.
    stands = stored(some.groupBy("fp").agg(F.min(F.struct("node", "size")).alias("s")).select("fp", "s.*"), "stands")
    # The stand of a fingerprint is a node itself, so what is linked has its name already.
    found = links(stands.select("node", F.array("fp").alias("fps"))).distinct()
    ends = [F.struct(F.xxhash64(x).alias("h"), F.col(x).alias("node"), F.col(f"{x}_size").alias("size")) for x in "ab"]
    across = found.join(stands.select(F.col("node").alias("a"), F.col("size").alias("a_size")), "a").join(
        stands.select(F.col("node").alias("b"), F.col("size").alias("b_size")), "b").filter(
        F.least("a_size", "b_size") >= F.lit(alike) * F.greatest("a_size", "b_size"))
    # The starts on the ring find most pairs of a large group several times over; one partner for each node, the least, holds it together.
    across = across.groupBy(F.greatest(*ends).alias("x")).agg(F.min(F.least(*ends)).alias("c")).select(
        "x.node", "x.size", F.col("c.node").alias("centre"), F.col("c.size").alias("its_size"))
    same = some.join(stands.select("fp", F.col("node").alias("centre"), F.col("size").alias("its_size")), "fp").filter("node <> centre").select(
        "node", "size", "centre", "its_size")
    fits = F.least("size", "its_size") >= F.lit(alike) * F.greatest("size", "its_size")
    return _dealt(across.union(same).filter(fits).select("node", F.col("node").alias("root"), "size", "centre", F.col("centre").alias("its")), block)


def _dealt(pairs: DataFrame, block: int) -> DataFrame:
    """Deals for nodes and the centres they are compared with (``node, root, size, centre, its``)."""
    pairs = stored(pairs, "pairs")
    met = pairs.groupBy("centre", "its").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"))
    met = stored(met.select("centre", "its", _blocks(F.col("n"), F.col("shingles"), block).alias("blocks")), "centres")
    at = pairs.join(sized(met.select("centre", "blocks"), 32), "centre").select(
        "node", "root", F.lit(False).alias("left"), F.xxhash64("centre", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).alias("pair"))
    to = met.select("centre", "its", F.explode(F.expr("sequence(0, blocks - 1)")).alias("i")).select(
        F.col("centre").alias("node"), F.col("its").alias("root"), F.lit(True).alias("left"), F.xxhash64("centre", "i").alias("pair"))
    return at.union(to)


def _across(members: DataFrame, block: int, roots: DataFrame) -> DataFrame:
    """Deals that bring nodes of different roots together that share a key.

    The members of a key's largest root need not be compared with each other: the others, those left over, are compared with
    all members. Both are cut into blocks, and pairs of blocks compared apart.
    """
    rows = _keyed(members, BANDS, roots)
    # Root by root first, so that the many members of one combine before the shuffle.
    parts = rows.groupBy("key", "root").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    met = parts.groupBy("key").agg(
        F.max(F.struct("n", "root", "shingles")).alias("big"), F.sum("n").alias("n"), F.sum("shingles").alias("shingles"),
        F.count(F.lit(1)).alias("roots"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y")).filter("roots > 1")
    # Keys with the same members count once.
    met = met.groupBy("n", "x", "y").agg(F.min(F.struct("key", "big", "shingles")).alias("m")).select("n", "m.*")
    met = stored(met.select("key", F.col("big.root").alias("big"), _blocks(F.col("n"), F.col("shingles"), block).alias("blocks"), _blocks(
        F.col("n") - F.col("big.n"), F.col("shingles") - F.col("big.shingles"), block).alias("left_blocks")), "keys")
    open_ = stored(rows.join(sized(met, 64), "key").select("key", "node", "root", "blocks", "left_blocks", (F.col("root") != F.col("big")).alias("left")), "open")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("left_blocks"))
    # A member meets every block of those left over; one left over meets every block of members as well.
    as_member = open_.select("node", "root", F.lit(False).alias("left"), "key", mine.alias("i"), F.explode(F.expr("sequence(0L, left_blocks - 1L)")).alias("j"))
    as_left = open_.filter("left").select("node", "root", "left", "key", F.explode(F.expr("sequence(0L, blocks - 1L)")).alias("i"), own.alias("j"))
    spread = as_member.unionByName(as_left).groupBy("node", "root", F.xxhash64("key", "i", "j").alias("pair")).agg(F.max("left").alias("left"))
    return spread.select("node", "root", "left", "pair")


def _merged(roots: DataFrame, found: DataFrame) -> DataFrame:
    """``roots`` after the links ``found`` between roots; a node that was not listed is a root of its own."""
    if found.isEmpty():
        return roots
    now = stored(components(found).select(F.col("node").alias("was"), F.col("root").alias("now")), "renamed")
    moved = roots.join(sized(now, 48), F.col("root") == F.col("was"), "left").select("member", F.coalesce("now", "root").alias("root"))
    new = now.join(roots, F.col("was") == F.col("member"), "left_anti").select(F.col("was").alias("member"), F.col("now").alias("root"))
    return stored(moved.union(new), "roots")


def linked(nodes: DataFrame, texts: DataFrame, again: DataFrame | None, alike: float, block: int) -> DataFrame:
    """``member, root`` of the nodes that have links."""
    members = _members(nodes)
    edges = stored(_compared(nodes, texts, _on_ring(nodes, alike, block), again, alike), "links")
    roots = stored(components(edges).withColumnRenamed("node", "member"), "roots")
    for turn, bands in enumerate(CENTRES):
        deals = _to_centres(members, bands, alike, block, turn, roots)
        roots = _merged(roots, stored(_compared(nodes, texts, deals, again, alike), "links"))
    return _merged(roots, stored(_compared(nodes, texts, _across(members, block, roots), again, alike), "links"))


def one_of_each(docs: DataFrame, *, id: str = "doc_id", text: str = "text", alike: float = ALIKE, block: int = BLOCK) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id, repeated rows once.

    Distinct texts under one id are judged each on its own. A null id counts as a large one made of the text, so it stays
    only where no other does.
    """
    key = F.coalesce(F.col(id).cast("long"), F.lit(1 << 62) + F.pmod(F.xxhash64(text), F.lit(1 << 61)))
    row = F.xxhash64(key, F.col(text))
    texts = docs.select(key.alias("key"), row.alias("row"), utf8(text).alias("_text"))
    own = stored(signatures(texts), "signatures")
    nodes = stored(own.groupBy("node", "size", "fp", "bands").agg(F.min(F.struct("key", "row")).alias("first")), "nodes")
    again = stored(own.groupBy("row").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("row"), "again")
    repeats = None if again.isEmpty() else again
    roots = linked(nodes, texts.select("row", "_text"), repeats, alike, block)
    named = nodes.join(roots, F.col("node") == F.col("member"), "left").groupBy(F.coalesce("root", "node").alias("root"))
    [name] = unused(docs.columns, "_row")
    first = stored(named.agg(F.min("first").alias("first")).select(F.col("first.row").alias(name)), "first")
    kept = docs.withColumn(name, row).join(sized(first, 48), name, "left_semi")
    # Texts are dealt out again only if some row is there twice.
    if repeats is not None:
        twice = again.withColumnRenamed("row", name)
        kept = kept.join(twice, name, "left_anti").union(kept.join(twice, name, "left_semi").dropDuplicates([name]))
    return kept.drop(name)
