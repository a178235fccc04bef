"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.session import work_dir

MAX_BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Settings while a table is written: the shuffle files behind it are of no more use then and are dropped at once, not
#: when the driver happens to collect its garbage; and texts go to Python in batches of fewer rows.
WHILE_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}
BROADCAST_BYTES = 32 << 20


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there and a lost executor loses nothing."""
    spark = df.sparkSession
    path, before = work_dir(spark, purpose), {k: spark.conf.get(k) for k in WHILE_WRITING}
    for k, v in WHILE_WRITING.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def sized(table: DataFrame, row_bytes: int, most: int = BROADCAST_BYTES) -> DataFrame:
    """A written table as one side of a join: broadcast if its counted rows fit into ``most`` bytes, else left to Spark."""
    return F.broadcast(table) if table.count() * row_bytes <= most else table


def utf8(column: str) -> Column:
    """The bytes of a text column; null becomes empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def by_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` whose tasks find this package and leave nothing of theirs in the worker for other operators' tasks."""
    lend_path(df.sparkSession)
    use = uuid.uuid4().hex

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(use)
        try:
            yield from run(batches)
        finally:
            release()
    return df.mapInArrow(task, schema)


#: What a worker keeps from one task to the next, for tasks of one use of an operator only: its name and one object.
_KEPT: dict[str, Any] = {"use": None, "key": None, "value": None}


def begin(use: str) -> None:
    """A task of ``use`` begins in this worker: what a task of another one has kept is let go."""
    if _KEPT["use"] != use:
        _KEPT.update(use=use, key=None, value=None)


def kept(key: Any, make: Callable[[], Any]) -> Any:
    """``make()``, or what it gave for the same key to an earlier task of the same use in this worker; one object at a time."""
    if _KEPT["key"] != key:
        _KEPT.update(key=None, value=None)
        _KEPT.update(value=make(), key=key)
    return _KEPT["value"]


def release() -> None:
    """Give memory that a task has freed back to the system; workers live on and would hold it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Cache(dict):
    """Values of ``make`` by key, begun anew beyond about ``most`` bytes; keys longer than ``longest`` are not kept.

    Keys and values have a length; what Python adds to both is counted as ``OVERHEAD``.
    """

    OVERHEAD = 220

    def __init__(self, make: Callable[[Any], Any], most: int, longest: int):
        super().__init__()
        self.make, self.most, self.longest, self.held = make, most, longest, 0

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= self.longest:
            size = len(key) + len(value) + self.OVERHEAD
            if self.held + size > self.most:
                self.clear()
                self.held = 0
            self.held += size
            self[key] = value
        return value


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """``names``, lengthened until none of ``columns`` is called so: helper columns beside those of any table."""
    taken = {c.lower() for c in columns}
    end = ""
    while any(f"{n}{end}".lower() in taken for n in names):
        end += "_"
    return [f"{n}{end}" for n in names]


#: Bytes that go to a Python worker at once. Spark's own bound of 64 MB costs several times that in an executor, outside of its heap.
BATCH_SETTING, BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def lend_path(spark: SparkSession) -> None:
    """Let Python tasks look for modules where this package lies, whatever folder the driver was started in.

    Workers take memory from the system's allocator in few arenas, so that it can be given back, and get texts in
    batches of ``MAX_BATCH_BYTES``; a session that sets a bound of its own keeps it.
    """
    if spark.conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, str(MAX_BATCH_BYTES))
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    environment.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    environment.setdefault("MALLOC_ARENA_MAX", "2")
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*known, root]))


def map_rows(
    df: DataFrame, schema: str, make: Callable[[], Callable[[dict[str, pa.Array]], dict[str, list | pa.Array]]],
    most_rows: int = 10_000,
) -> DataFrame:
    """Map Arrow batches to Arrow batches of ``schema``.

    ``make`` runs once per task and returns the function that turns the columns
    of one batch into output columns. Batches are cut by size first, so a run
    of very long texts does not grow the memory of a worker, and at ``most_rows``,
    for functions that make much of each row.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in pieces(batch, MAX_BATCH_BYTES, most_rows):
                out = work(dict(zip(part.schema.names, part.columns, strict=True)))
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x := out[f.name], pa.Array) else pa.array(x, f.type) for f in arrow], schema=arrow)

    return by_arrow(df, run, schema)


def pieces(batch: pa.RecordBatch, most: int = MAX_BATCH_BYTES, most_rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """``batch`` in row ranges of at most ``most`` bytes and ``most_rows`` rows, or of one row."""
    if batch.num_rows <= 1 or batch.nbytes <= most and batch.num_rows <= most_rows:
        if batch.num_rows:
            yield batch
        return
    half = batch.num_rows // 2
    yield from pieces(batch.slice(0, half), most, most_rows)
    yield from pieces(batch.slice(half), most, most_rows)


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The runs of equal ``key`` in batches that arrive sorted by it, each run whole.

    Runs must be of bounded size; callers split larger groups beforehand.
    """
    import pyarrow.compute as pc

    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        found = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        found = found.combine_chunks()
        keys = found[key]
        changed = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
        starts = [0, *(changed.nonzero()[0] + 1).tolist()]
        for a, b in zip(starts, starts[1:]):
            yield found.slice(a, b - a)
        rest = found.slice(starts[-1])
    if rest is not None:
        yield rest
