"""Repeated passages by distributed prefix doubling over sampled positions.

A byte goes if a string of ``LENGTH`` (400) bytes that covers it also starts at
another place. Ranking the prefixes of every byte position, doubled round by
round, would shuffle a row for each byte several times; so positions are sampled
by their content and stand for the strings around them:

* The anchor of a string is the place of the smallest hash of 16 bytes among its
  first ``SPREAD`` (100) places, the leftmost if several are. Equal strings have their
  anchors at equal offsets. Strings that follow each other mostly share one: an
  anchor stands for a run of starts, about fifty.
* Round 1 ranks anchors by the prefix that all its strings have in common (301
  bytes from the anchor); unique ones leave. Spark names a rank by its fingerprint
  and counts the positions of each, combined on the map side.
* Round 2 ranks pairs of that rank and the rest of the run's strings, as far as they
  reach on both sides. Where a pair is met again, all strings of the run are.
* Round 3 ranks, for runs that were unique (where a passage begins or ends), the
  pair of the first rank and the whole string for every start in the run, together
  with one run of each class that could share some. That is past the threshold: all is decided.

Fingerprints take the place of sorted ranks since only equality counts: 64 bits
for round 1, which only excludes, and 128 for what is decided (round 2 two words,
round 3 one word beside the first rank).

Defined results: a null text is an empty one; texts below 400 bytes lose nothing;
rows that repeat are copies of each other and lose all; null ids are kept; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import map_rows, stored, utf8

LENGTH = 400
SPREAD = 100
GRAM = 16
#: Places whose smallest hashes are found at once.
SEGMENT = 1 << 20
_INDEX = np.uint64((1 << 21) - 1)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _anchors(data: np.ndarray, spread: int, length: int) -> np.ndarray:
    """For every start of a string of ``length`` in ``data`` the place of its anchor."""
    h, step = (data.astype(np.uint64) + np.uint64(1)) * _MIX[0], 1
    for mix in _MIX:
        h = (h[:-step] ^ (h[:-step] >> np.uint64(31))) * mix + h[step:]
        step *= 2
    h ^= h >> np.uint64(32)
    h *= _MIX[1]
    n = len(data) - length + 1
    # The place in the low bits makes the smallest value the leftmost of equal hashes.
    low = (h[:n + spread - 1] & ~_INDEX) | np.arange(n + spread - 1, dtype=np.uint64)
    span = 1
    while span < spread:
        step = min(span, spread - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    return (low & _INDEX).astype(np.int64)


def batch_runs(raws: list[bytes], spread: int = SPREAD, length: int = LENGTH) -> Iterator[tuple[int, int, int, int]]:
    """``(text, first start, last start, anchor)`` of every run of some texts; places count within their text.

    Short texts are taken together, a long one segment by segment.
    """
    some: list[int] = []
    size = 0
    for k, raw in enumerate(raws):
        if len(raw) < length:
            continue
        if len(raw) > SEGMENT // 2:
            yield from _long_runs(k, raw, spread, length)
            continue
        if size + len(raw) > SEGMENT:
            yield from _short_runs(some, raws, spread, length)
            some, size = [], 0
        some.append(k)
        size += len(raw)
    if some:
        yield from _short_runs(some, raws, spread, length)


def _short_runs(some: list[int], raws: list[bytes], spread: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    sizes = np.array([len(raws[k]) for k in some])
    at = np.cumsum(sizes) - sizes
    places = _anchors(np.frombuffer(b"".join(raws[k] for k in some), np.uint8), spread, length)
    starts = sizes - length + 1
    text = np.repeat(np.arange(len(some)), starts)
    start = np.arange(len(text)) - np.repeat(np.cumsum(starts) - starts, starts)
    anchor = places[start + at[text]] - at[text]
    new = np.flatnonzero(np.append(True, (np.diff(anchor) != 0) | (np.diff(text) != 0)))
    last = start[np.append(new[1:], len(start)) - 1]
    yield from zip([some[t] for t in text[new].tolist()], start[new].tolist(), last.tolist(), anchor[new].tolist())


def _long_runs(k: int, raw: bytes, spread: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    data, first, held = np.frombuffer(raw, np.uint8), 0, -1
    for at in range(0, len(raw) - length + 1, SEGMENT):
        places = _anchors(data[at:at + SEGMENT + length - 1], spread, length) + at
        new = np.flatnonzero(np.diff(places, prepend=held))
        for s, p in zip((new + at).tolist(), places[new].tolist()):
            if held >= 0:
                yield k, first, s - 1, held
            first, held = s, p
    yield k, first, len(raw) - length, held


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """A document is named by its id and a hash of both; documents equal in these are alike in all that follows."""
    key = F.col(id).cast("long")
    return docs.select(key.alias("doc_id"), F.xxhash64(key, text).alias("row"), utf8(text).alias("_text"))


def positions(texts: DataFrame, length: int = LENGTH, spread: int = SPREAD, ranks_only: bool = False) -> DataFrame:
    """Every run of every text: its text, starts, first rank ``a``, and the rank of its whole reach in ``b0, b1``."""
    one, two = xxhash.xxh64_intdigest, xxhash.xxh128_intdigest
    common = length - spread + 1

    def ranks(batch):
        raws = batch["_text"].to_pylist()
        return {"a": pa.array([_signed(one(raws[k][p:p + common])) for k, _, _, p in batch_runs(raws, spread, length)], pa.int64())}

    def work(batch):
        raws = batch["_text"].to_pylist()
        found = list(batch_runs(raws, spread, length))
        whole = [two(raws[k][s:e + length]) for k, s, e, _ in found]
        at = pa.array([k for k, *_ in found], pa.int64())
        return {"doc_id": batch["doc_id"].take(at), "row": batch["row"].take(at),
                "first": [s for _, s, _, _ in found], "last": [e for _, _, e, _ in found],
                "a": [_signed(one(raws[k][p:p + common])) for k, _, _, p in found],
                "b0": [_signed(x >> 64) for x in whole], "b1": [_signed(x & (1 << 64) - 1) for x in whole]}
    if ranks_only:
        return map_rows(texts.select("_text"), "a long", lambda: ranks)
    return map_rows(texts, "doc_id long, row long, first long, last long, a long, b0 long, b1 long", lambda: work)


def _met_again(rows: DataFrame, *names: str) -> DataFrame:
    """Ranks that more than one position has."""
    return stored(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"), "ranks")


def _of_documents(texts: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """Join texts with rows of ``doc_id, row, marks``, null ids with null ids."""
    other = marks.withColumnsRenamed({"doc_id": "_doc", "row": "_row"})
    return texts.join(other, texts["doc_id"].eqNullSafe(other["_doc"]) & (texts["row"] == other["_row"]), how).drop("_doc", "_row")


def repeated(docs: DataFrame, *, id: str = "doc_id", text: str = "text", length: int = LENGTH, spread: int = SPREAD) -> DataFrame:
    """``doc_id, row, start, end``: byte ranges, possibly overlapping, that together cover all repeated strings."""
    texts = _keyed(docs, id, text)
    long = texts.filter(F.octet_length("_text") >= length)

    # Round 1.
    met = _met_again(positions(long, length, spread, ranks_only=True), "a")
    runs = stored(positions(long, length, spread).join(met, "a"), "runs")

    # Round 2.
    met = _met_again(runs, "b0", "b1")
    runs = stored(runs.join(met.withColumn("again", F.lit(True)), ["b0", "b1"], "left"), "paired")
    whole = runs.filter("again").select("doc_id", "row", F.col("first").alias("start"), (F.col("last") + length).alias("end"))

    # Round 3: runs that were unique, and one run of every class that shares their first rank.
    place = F.struct("doc_id", "row", "first", "last", "a")
    unique = runs.filter("again IS NULL")
    classes = runs.filter("again").join(stored(unique.select("a").distinct(), "ranks"), "a", "left_semi").groupBy("b0", "b1").agg(
        F.min(place).alias("p")).select("p.*", F.lit(False).alias("asked"))
    open_runs = unique.select("doc_id", "row", "first", "last", "a", F.lit(True).alias("asked")).unionByName(classes)
    listed = stored(open_runs.groupBy("doc_id", "row").agg(
        F.collect_list(F.struct("first", "last", "a", "asked")).alias("runs")), "open")

    def strings(batch):
        out: dict = {c: [] for c in ("at", "start", "a", "w", "asked")}
        for k, (raw, some) in enumerate(zip(batch["_text"].to_pylist(), batch["runs"].to_pylist())):
            for r in some:
                for s in range(r["first"], r["last"] + 1):
                    out["at"].append(k)
                    out["start"].append(s)
                    out["a"].append(r["a"])
                    out["w"].append(_signed(xxhash.xxh64_intdigest(raw[s:s + length])))
                    out["asked"].append(r["asked"])
        at = pa.array(out.pop("at"), pa.int64())
        return out | {"doc_id": batch["doc_id"].take(at), "row": batch["row"].take(at)}
    starts = stored(map_rows(_of_documents(long, listed, "inner").select("doc_id", "row", "_text", "runs"),
                             "doc_id long, row long, start long, a long, w long, asked boolean", lambda: strings), "strings")
    met = _met_again(starts, "a", "w")
    single = starts.filter("asked").join(met, ["a", "w"]).select("doc_id", "row", "start", (F.col("start") + length).alias("end"))
    return whole.unionByName(single)


def union_of(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes; ranges that touch are one."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without_repeats(docs: DataFrame, *, id: str = "doc_id", text: str = "text", length: int = LENGTH, spread: int = SPREAD) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, spans`` (removed byte ranges) and ``kept``, the bytes left."""
    found = repeated(docs, id=id, text=text, length=length, spread=spread)
    marks = stored(found.groupBy("doc_id", "row").agg(F.collect_set(F.struct("start", "end")).alias("ranges")), "ranges")

    def work(batch):
        spans, kept = [], []
        for raw, ranges in zip(batch["_text"].to_pylist(), batch["ranges"].to_pylist()):
            cut = union_of([(r["start"], r["end"]) for r in ranges or ()])
            edges = [0, *(x for span in cut for x in span), len(raw)]
            kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            spans.append([{"start": a, "end": b} for a, b in cut])
        return {"doc_id": batch["doc_id"], "n_bytes": pa.array([len(x) for x in batch["_text"].to_pylist()], pa.int64()), "spans": spans, "kept": kept}
    return map_rows(_of_documents(_keyed(docs, id, text), marks, "left").select("doc_id", "_text", "ranges"),
                    "doc_id long, n_bytes long, spans array<struct<start: bigint, end: bigint>>, kept binary", lambda: work)


def digests(kept: DataFrame) -> DataFrame:
    """Counts and the digest of what ``without_repeats`` leaves."""
    return kept.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
