"""Keyed tables over the topics: latest record per key, retention, key partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_key(
    records: DataFrame, key: str = "key", *, order: tuple[str, ...] = ("partition", "offset"),
    tombstone: str | None = "value",
) -> DataFrame:
    """The last written record of every key; a key whose last record is null is gone.

    ``max_by`` combines on the map side, so one shuffled row per key and input
    partition is all a hot key costs.
    """
    others = [c for c in records.columns if c != key]
    newest = records.groupBy(key).agg(
        F.max_by(F.struct(*others), F.struct(*order)).alias("_last")
    ).select(key, "_last.*").select(*records.columns)
    return newest.filter(F.col(tombstone).isNotNull()) if tombstone else newest


def within_retention(records: DataFrame, time: str, days: int, as_of: Column) -> DataFrame:
    """Records not older than the retention; a plain range filter that reaches the scan."""
    return records.filter(F.col(time) >= as_of - F.make_dt_interval(F.lit(days)))


def key_partition(key: Column | str, partitions: int) -> Column:
    """The partition number of a key; all records of a key share it."""
    return F.pmod(F.hash(key), F.lit(partitions))


def key_pieces(
    records: DataFrame, partitions: int, *, key: str = "key", offset: str = "offset", rows_per_piece: int = 5_000_000,
    within: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``keyPartition`` and deal the rows out for a write partitioned by it and by ``within``.

    The number stays a function of the key alone. How many tasks write a
    folder follows from its rows, counted first (one number per folder
    reaches the driver, and goes from there to the tasks), so a hot key does not end in one task; the offset spreads
    its rows over the pieces. Pieces are placed by their number, so each task writes exactly one, into one folder.
    Small folders share a task, up to ``rows_per_piece`` rows together and in whole: the number of tasks follows the rows, not the days.
    """
    numbered = records.withColumn("keyPartition", key_partition(key, partitions))
    folder = ("keyPartition", *within)
    sizes = numbered.groupBy(*folder).count().orderBy(*folder).collect()
    if not sizes:
        return numbered
    pieces = [-(-r["count"] // rows_per_piece) for r in sizes]
    first, tasks, room = [], 0, {}
    for r, n in zip(sizes, pieces):
        if n == 1 and r["count"] <= room.get(r["keyPartition"], (0, 0))[1]:
            shared, left = room[r["keyPartition"]]
            first.append(shared)
            room[r["keyPartition"]] = shared, left - r["count"]
            continue
        first.append(tasks)
        if n == 1:
            room[r["keyPartition"]] = tasks, rows_per_piece - r["count"]
        tasks += n
    types = ", ".join(f"`{numbered.schema[c].name}` {numbered.schema[c].dataType.simpleString()}" for c in folder)
    table = records.sparkSession.createDataFrame(
        [(*r[:-1], f, n) for r, f, n in zip(sizes, first, pieces)], f"{types}, _first int, _pieces int")
    # By hint: Spark takes a table of unknown size for a huge one, and would broadcast records of small files instead.
    placed = numbered.join(F.broadcast(table), list(folder)).withColumn("_piece", (F.col("_first") + F.pmod(F.xxhash64(offset), F.col("_pieces"))).cast("int"))
    return placed.repartitionById(tasks, "_piece").select(*numbered.columns)
