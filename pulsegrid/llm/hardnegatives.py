"""Hard negatives by rotated one-bit codes, with exact scores for what the codes leave open.

Every vector is turned by one random rotation and coded by the signs of its components:
the code vector c of those signs, of length one, and the stored alignment <c, x>. What that
leaves of x is coded in the same way, ``LEVELS`` times in all, so that

    x = a1 c1 + ... + aL cL + r,   |r| stored.

Anchors are rotated too and rounded to ``PLANES`` bit planes, up to a rest e of known length. A
product <c, q> is then a few popcounts of the code with the planes, and by Cauchy and
Schwarz

    |<q, x> - sum of a_l <c_l, q>|  <=  |e| (a1 + ... + aL) + |r| sqrt(|q|^2 - <cL, q>^2),

as r stands at a right angle to the last code vector. The interval is sure, not likely. Only
rows whose interval reaches into what can still be a result are scored, in integers: the
codes decide nothing by themselves and the result is exact.

Anchors are a stated part of the rows. They are taken in blocks of at most about ``ANCHOR_BYTES``
(by a hash of the id), each shipped to the tasks, which stream over all rows in pieces and keep the
best of each anchor; of a task only those leave it. One pass finds the positives of a
block, a second one its negatives.

Defined results: rows with a null id, label or vector, or a null or non-finite component take no
part; of rows that share an id the least by label and vector does; shorter vectors are filled up
with zeros; ties go to the smaller id; an anchor without positives, or a positive without a
fitting negative, has no row; other columns are ignored; an empty table gives none. A hundred times a score
must fit into a long.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import by_arrow, map_rows, pieces, stored

LEVELS = 3
PLANES = 6
ANCHOR_BYTES = 16 << 20
#: Rows and anchors that are compared at once in a task, and pairs that are scored at once.
ROWS, ANCHORS, PAIRS = 1_024, 512, 32_768
SLACK = 1e-9
SEED = 20
LEAST = np.iinfo(np.int64).min
CODED = "id long, label long, anchor boolean, v array<bigint>, code binary, parts array<double>"
FOUND = "anchor_id long, slot int, id long, score long"


def prepared(rows: DataFrame, anchors: Column, *, id: str, vector: str, label: str, scale: float) -> DataFrame:
    """``id, label, v, anchor`` of the rows that take part: components as floor(scale * x), one row for each id."""
    whole = rows.select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), anchors.alias("anchor"),
                        F.transform(vector, lambda x: x.cast("double")).alias("x")).filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()
        & F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    whole = whole.select("id", F.struct(
        "label", F.transform("x", lambda x: F.floor(F.lit(scale) * x).cast("long")).alias("v"),
        F.coalesce("anchor", F.lit(False)).alias("anchor")).alias("r"))
    return whole.groupBy("id").agg(F.min("r").alias("r")).select("id", "r.*")


def rotation(width: int) -> np.ndarray:
    """An orthogonal matrix, always the same for a width."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def padded(vectors: list[np.ndarray] | np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def encode(x: np.ndarray, turn: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows, levels, words) and, for each row, its alignments and the length of what is left."""
    rest = x.astype(np.float64) @ turn
    root = math.sqrt(turn.shape[0])
    codes, parts = [], []
    for _ in range(levels):
        up = rest >= 0
        codes.append(np.packbits(up, axis=1, bitorder="little").view(np.uint64))
        along = np.abs(rest).sum(1) / root
        parts.append(along)
        rest = rest - np.where(up, along[:, None], -along[:, None]) / root
    parts.append(np.sqrt((rest ** 2).sum(1)))
    return np.stack(codes, 1), np.stack(parts, 1)


class Anchors:
    """A block of anchors, rotated and cut into bit planes."""

    def __init__(self, x: np.ndarray, turn: np.ndarray, planes: int = PLANES):
        q = x.astype(np.float64) @ turn
        self.length2 = (q ** 2).sum(1)
        self.low = q.min(1, initial=0)
        self.step = np.maximum((q.max(1, initial=0) - self.low) / ((1 << planes) - 1), 1e-300)
        level = np.rint((q - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        near = self.low[:, None] + self.step[:, None] * level
        self.sum, self.rest = near.sum(1), np.sqrt(((q - near) ** 2).sum(1))
        self.planes = np.stack([
            np.packbits(level >> j & 1, axis=1, bitorder="little").view(np.uint64) for j in range(planes)], 1)

    def interval(self, some: slice, codes: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest possible product of each row and each anchor of ``some``."""
        low, step, planes = self.low[some], self.step[some], self.planes[some]
        root, levels = math.sqrt(codes.shape[2] * 64), codes.shape[1]
        middle = np.zeros((len(codes), len(low)))
        for l in range(levels):
            code = codes[:, l]
            both = np.zeros(middle.shape, np.int64)
            for j in range(planes.shape[1]):
                for w in range(code.shape[1]):
                    both += np.bitwise_count(code[:, None, w] & planes[None, :, j, w]).astype(np.int64) << j
            ones = np.bitwise_count(code).sum(1, dtype=np.int64)
            along = (2 * (ones[:, None] * low + step * both) - self.sum[some]) / root
            middle += parts[:, l, None] * along
        sure = np.maximum(0.0, np.abs(along) - self.rest[some])
        across = np.sqrt(np.maximum(0.0, self.length2[some] - sure ** 2))
        reach = self.rest[some] * parts[:, :levels].sum(1)[:, None] + parts[:, levels, None] * across
        slack = SLACK * np.sqrt(self.length2[some]) * np.sqrt((parts ** 2).sum(1))[:, None] + 1e-6
        return middle - reach - slack, middle + reach + slack


def scores(x: np.ndarray, i: np.ndarray, q: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer products of rows ``i`` of x and ``j`` of q."""
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), PAIRS):
        out[at:at + PAIRS] = np.einsum("ab,ab->a", x[i[at:at + PAIRS]], q[j[at:at + PAIRS]])
    return out


class Best:
    """The ``k`` best rows of each slot, by falling score and then rising id."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.score = np.full((slots, k), LEAST)
        self.id = np.full((slots, k), np.iinfo(np.int64).max)

    def worst(self, slots) -> np.ndarray:
        """What a row must reach to count; the least integer while a slot has room."""
        return self.score[slots, -1]

    def add(self, slot: np.ndarray, score: np.ndarray, id: np.ndarray) -> None:
        if not len(slot):
            return
        met = np.unique(slot)
        old = self.score[met] > LEAST
        slot = np.concatenate([slot, np.repeat(met, old.sum(1))])
        score, id = np.concatenate([score, self.score[met][old]]), np.concatenate([id, self.id[met][old]])
        order = np.lexsort((id, -score, slot))
        slot, score, id = slot[order], score[order], id[order]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot, "left")
        keep = place < self.k
        slot, place = slot[keep], place[keep]
        self.score[slot, place], self.id[slot, place] = score[keep], id[keep]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, place = np.nonzero(self.score > LEAST)
        return slot, self.id[slot, place], self.score[slot, place]


def kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each column; minus infinity if there are fewer."""
    if len(values) < k:
        return np.full(values.shape[1], -np.inf)
    return np.partition(values, len(values) - k, axis=0)[len(values) - k]


def _number(found: np.ndarray) -> np.ndarray:
    return np.where(found == LEAST, -np.inf, found.astype(np.float64))


def positives(block, rows, anchors: Anchors, best: Best) -> None:
    """Let the rows of a piece of the table be positives of the anchors; ``block`` has ``id, label, x`` of the anchors."""
    for at in range(0, len(block["id"]), ANCHORS):
        some = slice(at, min(at + ANCHORS, len(block["id"])))
        same = (rows["label"][:, None] == block["label"][some]) & (rows["id"][:, None] != block["id"][some])
        low, high = anchors.interval(some, rows["codes"], rows["parts"])
        floor = np.maximum(kth(np.where(same, low, -np.inf), best.k), _number(best.worst(some)))
        i, j = np.nonzero(same & (high >= floor))
        j += at
        best.add(j, scores(rows["x"], i, block["x"], j), rows["id"][i])


def negatives(block, rows, anchors: Anchors, best: Best, lower: int, upper: int) -> None:
    """The same for negatives; slot ``a * n + p`` is of anchor a and its p-th positive, of score ``block["positive"][a, p]``."""
    n = block["positive"].shape[1]
    for at in range(0, len(block["id"]), ANCHORS):
        some = slice(at, min(at + ANCHORS, len(block["id"])))
        other = rows["label"][:, None] != block["label"][some]
        low, high = anchors.interval(some, rows["codes"], rows["parts"])
        wanted, open_ = np.zeros(other.shape, bool), []
        for p in range(n):
            score = block["positive"][some, p]
            there = score > LEAST
            bottom, top = (np.where(there, side * score.astype(np.float64) / 100, 0.0) for side in (lower, upper))
            slack = 1e-6 + SLACK * np.abs(top)
            surely = other & (low >= bottom + slack) & (high <= top - slack)
            floor = np.maximum(kth(np.where(surely, low, -np.inf), best.k), _number(best.worst(np.arange(some.start, some.stop) * n + p)))
            mine = other & there & (high >= np.maximum(floor, bottom - slack)) & (low <= top + slack)
            open_.append(mine)
            wanted |= mine
        i, j = np.nonzero(wanted)
        score = scores(rows["x"], i, block["x"], j + at)
        for p in range(n):
            against = block["positive"][j + at, p]
            fits = open_[p][i, j]
            fits[fits] = (lower * against[fits] <= 100 * score[fits]) & (100 * score[fits] <= upper * against[fits])
            best.add((j[fits] + at) * n + p, score[fits], rows["id"][i[fits]])


def coded(rows: DataFrame, width: int, levels: int) -> DataFrame:
    def make():
        turn = rotation(width)

        def work(batch):
            x = padded(batch["v"].to_numpy(zero_copy_only=False), width)
            codes, parts = encode(x, turn, levels)
            return {k: batch[k] for k in ("id", "label", "anchor", "v")} | {"code": [c.tobytes() for c in codes], "parts": list(parts)}
        return work
    return map_rows(rows.select("id", "label", "anchor", "v"), CODED, make, ROWS)


def _block(rows: list, width: int) -> dict[str, np.ndarray]:
    return {"id": np.array([r.id for r in rows], np.int64), "label": np.array([r.label for r in rows], np.int64),
            "x": padded([np.array(r.v, np.int64) for r in rows], width)}


def _over(table: DataFrame, block: dict[str, np.ndarray], width: int, levels: int, slots: int, k: int, look: Callable) -> DataFrame:
    """Stream over all rows in every task; returns the best of each task and slot."""
    shipped = table.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = shipped.value
        anchors, best = Anchors(mine["x"], rotation(width)), Best(len(mine["id"]) * slots, k)
        for batch in batches:
            for part in pieces(batch, most_rows=ROWS):
                code = b"".join(part["code"].to_pylist())
                look(mine, {
                    "id": part["id"].to_numpy(), "label": part["label"].to_numpy(), "x": padded(part["v"].to_numpy(zero_copy_only=False), width),
                    "codes": np.frombuffer(code, np.uint64).reshape(part.num_rows, levels, -1),
                    "parts": np.stack(part["parts"].to_numpy(zero_copy_only=False)),
                }, anchors, best)
        slot, id, score = best.rows()
        for at in range(0, len(slot), 65_536):
            to = slice(at, at + 65_536)
            yield pa.RecordBatch.from_arrays([
                pa.array(mine["id"][slot[to] // slots]), pa.array((slot[to] % slots).astype(np.int32)), pa.array(id[to]), pa.array(score[to])],
                names=["anchor_id", "slot", "id", "score"])
    found = by_arrow(table.select("id", "label", "v", "code", "parts"), run, FOUND)
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: Column, *, id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: float = 256.0,
         positives_each: int = 5, negatives_each: int = 10, lower: int = 30, upper: int = 90, levels: int = LEVELS,
         anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Positives are the best rows of the anchor's label, negatives the best of other labels whose score is
    from ``lower`` to ``upper`` hundredths of the positive's.
    """
    spark = rows.sparkSession
    taken = stored(prepared(rows, anchors, id=id, vector=vector, label=label, scale=scale), "vectors")
    width, chosen = taken.agg(F.max(F.size("v")), F.count_if("anchor")).first()
    width = max(64, -(-(width or 0) // 64) * 64)
    table = stored(coded(taken, width, levels), "codes")
    blocks = -(-chosen * (8 * width + 64) // anchor_bytes)
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for b in range(blocks):
        # A block of anchors is bounded in bytes, and so are its positives; both come to the driver and go to the tasks.
        block = _block(table.filter(F.col("anchor") & (F.pmod(F.xxhash64("id"), F.lit(blocks)) == b)).select("id", "label", "v").collect(), width)
        near = _over(table, block, width, levels, 1, positives_each, positives).collect()
        place = {k: i for i, k in enumerate(block["id"].tolist())}
        names, found = (np.full((len(place), positives_each), LEAST) for _ in range(2))
        for r in near:
            names[place[r.anchor_id], r.rank - 1], found[place[r.anchor_id], r.rank - 1] = r.id, r.score

        def look(mine, rows, anchors, best):
            negatives(mine, rows, anchors, best, lower, upper)
        far = _over(table, block | {"positive": found}, width, levels, positives_each, negatives_each, look)
        pairs = stored(spark.createDataFrame(
            [(r.anchor_id, r.rank - 1, r.id, r.score) for r in near], "anchor_id long, slot int, positive_id long, positive_score long"), "positives")
        out = out.unionByName(stored(far.join(pairs, ["anchor_id", "slot"]).select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "negatives"))
    return out
