"""SimHash near-duplicates, found with the pigeonring filter.

The 64 bits lie on a ring of five segments. If two fingerprints differ in at
most four bits, then from some segment on, around the ring, the differences of
the first n segments together never exceed their share n * 4 / 5 (rounded down:
0, 1, 2, 3, 4). So linked fingerprints share one whole segment and differ in at
most one bit of the next: that is the join key, 26 bits, with the one bit
flipped from 0 to 1 on one side. The longer chains are checked on the members
of a key before the full distance is taken.

Several tables of fingerprints can be asked for, each from its own mixing of the
shingles' hashes: documents then link if one table's differ in at most four bits and
all tables' together in at most ``most`` bits. One table finds close copies;
more of them also find looser ones, and the sum keeps chance meetings out.

Documents of the same fingerprints take part once. Keys with many members are
cut into blocks, and pairs of blocks are compared apart from each other; of a
block's links only a spanning forest is kept, which leaves components as they are.

Defined results: null and empty texts have fingerprint zero and link like any
other; null ids never name a component unless all its ids are null; repeated
rows are kept, each with its component; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import by_arrow, groups, map_rows, sized, stored, utf8
from pulsegrid.llm.components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Widths of the segments, from the lowest bit up.
WIDTHS = (13, 13, 13, 13, 12)
LOW = tuple(sum(WIDTHS[:i]) for i in range(5))
#: Members of a key that are compared at once; larger keys are cut into blocks of about this size.
BLOCK = 1024


def _mixed(hashes: np.ndarray, table: int) -> np.ndarray:
    """The hashes themselves for the first table, another 64 bits of each for the next ones."""
    if not table:
        return hashes
    x = hashes + np.uint64((table * 0x9E3779B97F4A7C15) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(raw: bytes, shingle: int = SHINGLE, tables: int = 1) -> list[int]:
    """The SimHash in each table of a text's shingles of words, A-Z lower-cased; 0 without a word."""
    words = raw.lower().split()
    if not words:
        return [0] * tables
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(size) - 1
    starts = ends + 1 - size
    n = max(1, len(words) - shingle + 1)
    firsts, lasts = starts[:n].tolist(), ends[-n:].tolist()
    of, counts = xxhash.xxh64_intdigest, np.zeros((tables, 64), np.int64)
    for k in range(0, n, 1 << 14):
        hashes = np.fromiter((of(joined[a:b], SEED) for a, b in zip(firsts[k:k + (1 << 14)], lasts[k:k + (1 << 14)])), np.uint64)
        for t in range(tables):
            bits = np.unpackbits(_mixed(hashes, t).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts[t] += bits.sum(0, dtype=np.int64)
    packed = np.packbits(2 * counts > n, axis=1, bitorder="little")
    return packed.view(np.int64).ravel().tolist()


def fingerprints(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, tables: int = 1,
) -> DataFrame:
    """``doc_id`` and ``fps`` (of each table the 64 bits as a signed long), one row per document."""
    def work(batch):
        return {"doc_id": batch["_id"], "fps": [fingerprint(x, shingle, tables) for x in batch["_text"].to_pylist()]}
    return map_rows(docs.select(F.col(id).cast("long").alias("_id"), utf8(text).alias("_text")),
                    "doc_id long, fps array<bigint>", lambda: work)


def _keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint and start on the ring its own key, then the keys with one more bit in the second segment."""
    bits, keys, own = fp.view(np.uint64), [], []
    for i, (width, low) in enumerate(zip(WIDTHS, LOW)):
        j = (i + 1) % 5
        first = bits >> np.uint64(low) & np.uint64((1 << width) - 1)
        second = bits >> np.uint64(LOW[j]) & np.uint64((1 << WIDTHS[j]) - 1)
        base = np.uint64(i) << np.uint64(26) | first << np.uint64(13)
        for flip in (0, *(1 << b for b in range(WIDTHS[j]))):
            keys.append(np.where(second & np.uint64(flip) == 0, base | second | np.uint64(flip), np.uint64(1 << 40)))
            own.append(flip == 0)
    return np.array(keys).T, np.array(own)


def chains(nodes: DataFrame) -> DataFrame:
    """``p, own`` rows for ``short, fps``: a key in the upper half of ``p``, the node's ``short`` in the lower.

    Two nodes that are close in a table meet under at least one key that one of them owns.
    """
    def work(batch):
        short = batch["short"].to_numpy(zero_copy_only=False)
        fps = np.array(batch["fps"].to_pylist(), dtype=np.int64).reshape(len(short), -1)
        packed, owned = [], []
        for t in range(fps.shape[1]):
            keys, own = _keys(np.ascontiguousarray(fps[:, t]))
            real = keys < np.uint64(1 << 40)
            packed.append((keys[real].astype(np.int64) + (t * 5 << 26) << 32) | np.repeat(short, real.sum(1)))
            owned.append(np.broadcast_to(own, keys.shape)[real])
        return {"p": pa.array(np.concatenate(packed)), "own": pa.array(np.concatenate(owned))}
    # A node makes 37 rows for each table.
    return map_rows(nodes.select("short", "fps"), "p long, own boolean", lambda: work, most_rows=500)


def _forest(node: np.ndarray, fps: np.ndarray, ring: int, most: int | None) -> list[tuple[int, int]]:
    """A spanning forest of the links among nodes that met at one start on one table's ring (``5 * table + start``)."""
    table, start = divmod(ring, 5)
    masks = np.zeros(3, np.uint64)
    for n in range(3):
        for k in range(n + 2):
            j = (start + k) % 5
            masks[n] |= np.uint64(((1 << WIDTHS[j]) - 1) << LOW[j])
    node, at = np.unique(node, return_index=True)
    bits = fps[at].view(np.uint64)
    one = bits[:, table]
    left, frontier, edges = np.arange(len(node)), [], []
    while len(left):
        if not frontier:
            frontier.append(left[0])
            left = left[1:]
        k = frontier.pop()
        differ = one[left] ^ one[k]
        near = np.arange(len(left))
        for n, mask in enumerate(masks):
            near = near[np.bitwise_count(differ[near] & mask) <= n + 1]
        near = near[np.bitwise_count(differ[near]) <= DISTANCE]
        if most is not None and len(near):
            near = near[np.bitwise_count(bits[left[near]] ^ bits[k]).sum(1, dtype=np.int64) <= most]
        if len(near):
            found = left[near]
            left = np.delete(left, near)
            edges += [(int(node[k]), int(node[x])) for x in found]
            frontier += found.tolist()
    return edges


def links(nodes: DataFrame, *, most: int | None = None, block: int = BLOCK) -> DataFrame:
    """Edges ``a, b`` between linked nodes (``node, fps``, distinct); same components as all linked pairs.

    Linked: at most four differing bits in one table, and ``most`` in all tables together if given.
    """
    # Rows are one number, half of it a hash of the node; nodes that share it only add candidates.
    nodes = nodes.select("node", "fps", F.expr("xxhash64(node) & 4294967295").alias("short"))
    rows, key = chains(nodes), F.shiftrightunsigned("p", 32)
    # Counts first, combined on the map side: keys without a possible pair go, large keys get blocks.
    met = rows.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("owned")).filter("n > 1 AND owned")
    # Beyond 32,768 blocks (15 bits) they grow instead of their number.
    blocks = F.least(F.lit(1 << 15), F.ceil(F.col("n") / block)).cast("int")
    met = stored(met.select("key", blocks.alias("blocks")), "keys")
    members = stored(rows.select("p").join(sized(met, 48), key == F.col("key")).select("key", "blocks", F.expr("p & 4294967295").alias("short")), "members")
    members = members.join(nodes, "short")
    members = members.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    spread = members.select("key", "node", "fps", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"), "mine")
    # 32 bits of key and 15 for each block.
    spread = spread.select("node", "fps", F.expr("(key << 30) | (bigint(least(mine, other)) << 15) | greatest(mine, other)").alias("pair"))

    def run(batches):
        for group in groups(batches, "pair"):
            if len(group) > 1:
                fps = np.array(group["fps"].to_pylist(), dtype=np.int64)
                found = _forest(group["node"].to_numpy(), fps, group["pair"][0].as_py() >> 56, most)
                if found:
                    ends = np.array(found, dtype=np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    # A set number of tasks: the groups are small in bytes, but each costs comparisons.
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return by_arrow(spread.repartition(tasks, "pair").sortWithinPartitions("pair"), run, "a long, b long")


def near_duplicates(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, tables: int = 1, most: int | None = None,
) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row per document; ``fingerprint`` is the first table's."""
    node = F.col("fps")[0] if tables == 1 else F.xxhash64("fps")
    own = stored(fingerprints(docs, id=id, text=text, shingle=shingle, tables=tables).withColumn("node", node), "fingerprints")
    nodes = stored(own.groupBy("node", "fps").agg(F.min("doc_id").alias("first_id")), "nodes")
    roots = stored(components(links(nodes, most=most)).withColumnRenamed("node", "member"), "roots")
    named = nodes.join(roots, F.col("node") == F.col("member"), "left").withColumn("root", F.coalesce("root", "node"))
    ids = stored(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "ids")
    named = stored(named.join(ids, "root").select("node", "component_id"), "named")
    return own.join(named, "node").select(
        "doc_id", F.lower(F.lpad(F.hex(F.col("fps")[0]), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, *, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id, repeated rows once.

    A null id counts as a large one made of the text, so it stays only where no other does.
    """
    key = F.coalesce(F.col(id).cast("long"), F.lit(1 << 62) + F.pmod(F.xxhash64(text), F.lit(1 << 61)))
    keyed = docs.withColumn("_key", key)
    found = near_duplicates(keyed.select("_key", text), id="_key", text=text, **options)
    first = stored(found.filter("doc_id = component_id").groupBy(F.col("doc_id").alias("_key")).count(), "first")
    kept = keyed.join(sized(first.select("_key"), 48), "_key", "left_semi")
    # Texts are dealt out again only if some row is there twice.
    again = first.filter("count > 1").select("_key")
    if not again.isEmpty():
        kept = kept.join(again, "_key", "left_anti").union(kept.join(again, "_key", "left_semi").dropDuplicates(["_key"]))
    return kept.select(*docs.columns)
