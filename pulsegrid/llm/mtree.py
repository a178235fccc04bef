"""Exact top-k search by inner product with an M-tree in pages.

Integer vectors are searched by inner product, which is no metric; so each gets
one more component, the root of what its squared length lacks to the largest one,
and queries get a zero there. Then distance squared = |q|^2 + largest - 2 * score, and
the nearest vectors are those of the highest score.

The tree: routing objects, a bounded sample of ``PIVOTS`` vectors, divide all vectors
into cells by the nearest one; cells are cut into blocks of about ``BLOCK`` vectors, so
none has to fit into one task. A block holds pages of ``PAGE`` entries, each with a
routing object, its covering radius, its distance to the cell's routing object, and the
distances of its entries to it. A search looks at a query's own cell first; what it finds
there bounds which other cells are sent the query. In a block pages are visited best
first, and neither a page nor an entry is computed if the stored distances and the
triangle inequality put it beyond the k-th result. Bounds are taken with slack for
rounding, scores are integers: the result is exact, ties going to the smaller id.

Defined results: rows with a null id, a null vector, or null or non-finite components take no
part; shorter vectors are filled up with zeros; rows repeating id and vector are one; a
query's own id is no result of it; other columns are ignored. Scores must fit into a long.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import by_arrow, stored

PIVOTS = 64
BLOCK = 32_768
QUERIES = 4_096
PAGE = 128
SLACK = 1e-9
#: Up to here sums of products are exact in doubles.
EXACT = float(1 << 53)


def prepared(rows: DataFrame, *, id: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """``id, v``: every component as floor(scale * x); rows that take no part are left out."""
    big = F.transform(vector, lambda x: x.cast("double"))
    whole = rows.select(F.col(id).cast("long").alias("id"), big.alias("x")).filter(
        F.col("id").isNotNull() & F.col("x").isNotNull()
        & F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return whole.select("id", F.transform("x", lambda x: F.floor(F.lit(scale) * x).cast("long")).alias("v"))


def _length2(v: str) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class Metric:
    """Scores and distances of integer vectors under the largest squared length ``most``."""

    def __init__(self, most: float):
        self.most = most
        self.kind = np.float64 if most < EXACT else np.int64

    def scores(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.astype(self.kind) @ b.astype(self.kind).T).astype(np.int64)

    def lift(self, a: np.ndarray) -> np.ndarray:
        """The added component of indexed vectors."""
        return np.sqrt(np.maximum(0.0, self.most - (a.astype(np.float64) ** 2).sum(1)))

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Distances between indexed vectors."""
        x, y = a.astype(np.float64), b.astype(np.float64)
        flat = (x ** 2).sum(1)[:, None] + (y ** 2).sum(1) - 2 * x @ y.T
        return np.sqrt(np.maximum(0.0, flat + (self.lift(a)[:, None] - self.lift(b)) ** 2))

    def to_query(self, q2: float, scores: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, q2 + self.most - 2.0 * scores))


class Tree:
    """Pages over one block of a cell, whose routing object is ``pivot``."""

    def __init__(self, metric: Metric, pivot: np.ndarray, vectors: np.ndarray, ids: list[np.ndarray], page: int = PAGE):
        self.metric, self.pivot = metric, pivot
        to_pivot = metric.between(vectors, pivot[None])[:, 0]
        # Routing objects at even steps of the distance to the cell's; entries go to the nearest.
        order = np.argsort(to_pivot, kind="stable")
        chosen = order[np.linspace(0, len(order) - 1, max(1, -(-len(order) // page))).astype(int)]
        chosen = np.unique(chosen)
        near = np.empty(len(vectors), int)
        to_centre = np.empty(len(vectors))
        for at in range(0, len(vectors), 4096):
            d = metric.between(vectors[at:at + 4096], vectors[chosen])
            near[at:at + 4096] = d.argmin(1)
            to_centre[at:at + 4096] = d.min(1)
        place = np.lexsort((to_centre, near))
        self.vectors, self.ids, self.entry = vectors[place].astype(metric.kind), [ids[i] for i in place], to_centre[place]
        edges = np.flatnonzero(np.diff(near[place], prepend=-1, append=-1))
        # Large pages are cut; their parts keep the routing object and get a radius of their own.
        cuts = [c for a, b in zip(edges, edges[1:]) for c in range(a, b, page)]
        self.first, self.last = np.array(cuts), np.array([*cuts[1:], len(place)])
        self.centre = chosen[near[place][self.first]]
        self.radius = self.entry[self.last - 1]
        self.parent = to_pivot[self.centre]
        self.centres = vectors[self.centre].astype(metric.kind)

    def search(self, q: np.ndarray, own: int, k: int, bound: float = np.inf) -> list[tuple[int, int]]:
        """``(-score, id)`` of the k best rows within ``bound`` of the query; ids of equal vectors are ascending."""
        m, q = self.metric, q.astype(self.metric.kind)
        q2 = float((q.astype(np.float64) ** 2).sum())
        slack = SLACK * (1 + np.sqrt(q2 + m.most))
        to_pivot = m.to_query(q2, np.array([float(self.pivot.astype(np.float64) @ q)]))[0]
        best: list[tuple[int, int]] = []  # a heap whose first is the worst kept: (score, -id)
        open_pages = np.flatnonzero(np.abs(to_pivot - self.parent) - self.radius <= bound + slack)
        to_centre = m.to_query(q2, (self.centres[open_pages] @ q).astype(np.float64))
        least = to_centre - self.radius[open_pages]
        for at in np.argsort(least, kind="stable"):
            if least[at] > bound + slack:
                break
            a, b = self.first[open_pages[at]], self.last[open_pages[at]]
            # Entries are sorted by their distance to the page's routing object.
            lo, hi = np.searchsorted(self.entry[a:b], [to_centre[at] - bound - slack, to_centre[at] + bound + slack])
            hi = np.searchsorted(self.entry[a:b], to_centre[at] + bound + slack, "right")
            if lo >= hi:
                continue
            scores = self.vectors[a + lo:a + hi] @ q
            if len(best) == k:
                some = np.flatnonzero(scores >= best[0][0])
            elif bound < np.inf:
                some = np.flatnonzero(m.to_query(q2, scores.astype(np.float64)) <= bound + slack)
            else:
                some = range(len(scores))
            for i in some:
                score = int(scores[i])
                for x in self.ids[a + lo + i]:
                    if x == own:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, (score, -x))
                    elif (score, -x) > best[0]:
                        heapq.heapreplace(best, (score, -x))
                    else:
                        break
            if len(best) == k:
                bound = min(bound, float(m.to_query(q2, np.array([float(best[0][0])]))[0]))
        return sorted((-s, -x) for s, x in best)


def top_k(rows: DataFrame, queries: Column, *, k: int = 5, id: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every row for which ``queries`` (over ``id``) holds, against all rows."""
    spark = rows.sparkSession
    plain = stored(prepared(rows, id=id, vector=vector, scale=scale), "vectors")
    width = max(1, plain.agg(F.max(F.size("v"))).first()[0] or 0)
    filled = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v")))
    plain = plain.select("id", filled.alias("v"))
    # Of equal vectors the k + 1 smallest ids can be results; the limit is applied before the shuffle as well.
    turn = F.dense_rank().over(Window.partitionBy("v").orderBy("id"))
    distinct = plain.withColumn("turn", turn).filter(F.col("turn") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    distinct = stored(distinct, "distinct")
    most = float(distinct.agg(F.max(_length2("v"))).first()[0] or 0.0)
    pivots = np.array([r.v for r in distinct.orderBy(F.xxhash64("v"), "v").limit(PIVOTS).collect()], np.int64).reshape(-1, width)
    asked = plain.withColumnRenamed("id", id).filter(queries).select(F.col(id).alias("query_id"), "v").distinct()
    if not len(pivots):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    # Cells, their radii and sizes.
    def nearest(batches, metric=Metric(most)):
        for b in batches:
            d = metric.between(_matrix(b["v"], width), pivots)
            yield pa.RecordBatch.from_arrays([pa.array(d.argmin(1), pa.int32()), pa.array(d.min(1)), b["v"], b["ids"]], names=["cell", "d", "v", "ids"])
    cells = stored(by_arrow(distinct, nearest, "cell int, d double, v array<bigint>, ids array<bigint>"), "cells")
    sizes = {r.cell: (r.n, r.r) for r in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("r")).collect()}
    blocks = {c: -(-n // BLOCK) for c, (n, _) in sizes.items()}
    count = F.create_map(*[F.lit(x) for c, n in blocks.items() for x in (c, n)])
    indexed = cells.withColumn("block", F.pmod(F.xxhash64("v"), count[F.col("cell")]).cast("int"))

    n_asked = asked.count()
    parts = max(1, -(-n_asked // QUERIES))
    asked = stored(asked.withColumn("part", F.pmod(F.xxhash64("query_id", "v"), F.lit(parts)).cast("int")), "asked")
    radius = np.full(len(pivots), -np.inf)
    radius[list(sizes)] = [r for _, r in sizes.values()]

    # First each query's own cell (one block of it) for a bound, then every block that can hold something within it.
    def reach(table: pa.RecordBatch, bounds: np.ndarray):
        m, q = Metric(most), _matrix(table["v"], width)
        q2 = (q.astype(np.float64) ** 2).sum(1)
        d = np.sqrt(np.maximum(0.0, q2[:, None] + most - 2.0 * m.scores(q, pivots)))
        return d - radius, bounds + SLACK * (1 + np.sqrt(q2 + most))

    def home(batches):
        for b in batches:
            least, _ = reach(b, np.zeros(b.num_rows))
            cell = least.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [b["query_id"], b["v"], b["part"], pa.array(cell, pa.int32()), pa.array(np.zeros(len(cell)), pa.int32()),
                 pa.array(np.full(len(cell), np.inf))], names=["query_id", "v", "part", "cell", "block", "bound"])

    def others(batches):
        for b in batches:
            least, bound = reach(b, b["bound"].to_numpy(zero_copy_only=False))
            at, cell = np.nonzero(least <= bound[:, None])
            n = np.array([blocks.get(c, 0) for c in cell.tolist()], dtype=int)
            at, cell, block = np.repeat(at, n), np.repeat(cell, n), np.concatenate([np.arange(x) for x in n] or [np.zeros(0, int)])
            t = b.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [t["query_id"], t["v"], t["part"], pa.array(cell, pa.int32()), pa.array(block, pa.int32()), t["bound"]],
                names=["query_id", "v", "part", "cell", "block", "bound"])
    sent = "query_id long, v array<bigint>, part int, cell int, block int, bound double"
    found = "query_id long, v array<bigint>, vec_id long, score long, bound double"

    def look(queries_: pa.Table, entries: pa.Table) -> pa.Table:
        out: dict = {"query_id": [], "at": [], "vec_id": [], "score": [], "bound": []}
        if len(queries_) and len(entries):
            metric = Metric(most)
            tree = Tree(metric, pivots[entries["c"][0].as_py()], _matrix(entries["v"], width), entries["ids"].to_pylist())
            q, names, bounds = _matrix(queries_["v"], width), queries_["query_id"].to_pylist(), queries_["bound"].to_pylist()
            for i, (v, own, bound) in enumerate(zip(q, names, bounds)):
                hits = tree.search(v, own, k, bound)
                q2 = float((v.astype(np.float64) ** 2).sum())
                last = float(metric.to_query(q2, np.array([float(-hits[-1][0])]))[0]) if len(hits) == k else np.inf
                for s, x in hits:
                    for name, value in zip(out, (own, i, x, -s, last)):
                        out[name].append(value)
        v = queries_["v"].combine_chunks().take(pa.array(out.pop("at"), pa.int64()))
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "v": v, "vec_id": pa.array(out["vec_id"], pa.int64()),
                         "score": pa.array(out["score"], pa.int64()), "bound": pa.array(out["bound"], pa.float64())})

    def searched(targets: DataFrame) -> DataFrame:
        pairs = targets.select("cell", "block", F.col("part").alias("of")).distinct()
        entries = indexed.join(pairs, ["cell", "block"]).select(F.col("cell").alias("c"), F.col("block").alias("b"), "of", "v", "ids")
        return targets.groupBy("cell", "block", "part").cogroup(entries.groupBy("c", "b", "of")).applyInArrow(look, found)

    first = searched(stored(by_arrow(asked, home, sent), "home"))
    bounds = first.groupBy("query_id", "v").agg(F.min("bound").alias("bound"))
    bounds = asked.join(bounds, ["query_id", "v"], "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
    hits = searched(stored(by_arrow(stored(bounds.select("query_id", "v", "part", "bound"), "bounds"), others, sent), "sent"))
    place = F.row_number().over(Window.partitionBy("query_id", "v").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
