"""Latest status per equipment as keyed state of a streaming query.

The state lies in the RocksDB state store of the query, next to its checkpoint: a
micro-batch touches only the equipments it has records of, and changelog checkpoints
write only what changed. A tombstone deletes its equipment's state. The table of all equipments
is read from the store itself, as of the last finished micro-batch.

State is kept by equipment and slice, a hash of the offset, so the records of a hot equipment are spread over
``SLICES`` tasks; reading takes the newest of an equipment's slices. Only the newest row of a task's records of an equipment
and slice goes on to the state, so the state's Python sees equipments and not records. A deleted one leaves its place only, which
refuses older records of a repeated or late read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from pulsegrid.operators.tables import latest_by_key

#: What the session needs for it.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


#: Tasks the records of one equipment are spread over.
SLICES = 8
#: Rows a task holds before it keeps the newest of each group.
HELD = 1 << 17


def newest(batches: Iterator[pa.RecordBatch], key: str, held: int = HELD) -> Iterator[pa.RecordBatch]:
    """The newest row by (partition, offset) of each key and slice; more than one where there are more groups than a task may hold."""
    kept, n = [], 0
    for batch in batches:
        kept.append(batch)
        n += batch.num_rows
        if n >= held:
            kept = _newest(kept, key)
            n = sum(b.num_rows for b in kept)
            if n > held // 2:
                yield from kept
                kept, n = [], 0
    yield from _newest(kept, key)


def _newest(batches: list[pa.RecordBatch], key: str) -> list[pa.RecordBatch]:
    if not batches:
        return []
    rows = pa.Table.from_batches(batches)
    order = pc.sort_indices(rows, sort_keys=[("partition", "ascending"), ("offset", "ascending")], null_placement="at_start").to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    last = rows.select([key, "_slice"]).append_column("_place", pa.array(place)).group_by([key, "_slice"]).aggregate([("_place", "max")])
    return rows.take(pa.array(order[last["_place_max"].to_numpy()])).combine_chunks().to_batches()


class Latest(StatefulProcessor):
    """Keeps the newest row of a group by (partition, offset); a newest row without ``tombstone`` leaves its place only."""

    def __init__(self, schema: T.StructType, tombstone: str):
        self.schema, self.tombstone = schema, tombstone

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", self.schema)
        self.gone = handle.getValueState("gone", "partition int, offset long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        newest = max(rows, key=lambda r: (r["partition"], r["offset"]))
        place = (newest["partition"], newest["offset"])
        seen = None
        if self.last.exists():
            known = dict(zip(self.schema.names, self.last.get()))
            seen = (known["partition"], known["offset"])
        elif self.gone.exists():
            seen = tuple(self.gone.get())
        if seen is not None and place <= seen:
            return
        values = newest.asDict()
        if values[self.tombstone] is None:
            self.last.clear()
            self.gone.update(place)
        else:
            self.gone.clear()
            self.last.update(tuple(values[name] for name in self.schema.names))
        yield Row(**{name: values[name] for name in self.schema.names})

    def close(self) -> None:
        pass


def run_latest_state(
    statuses: DataFrame, checkpoint: str, *, key: str = "equipmentId", tombstone: str = "severity",
    every: str | None = None, sink: str | None = None, slices: int = SLICES,
) -> StreamingQuery:
    """Start the query; without ``every`` it works off what is there and stops.

    ``statuses`` are rows with ``partition`` and ``offset`` beside the key. With ``sink`` the rows that were newest in
    some batch are appended to Parquet there. A checkpoint keeps the number of slices it began with.
    """
    spark = statuses.sparkSession
    sliced = statuses.withColumn("_slice", F.pmod(F.xxhash64("offset"), F.lit(slices)))
    groups = sliced.mapInArrow(lambda batches: newest(batches, key), sliced.schema).groupBy(key, "_slice")
    changed = groups.transformWithState(Latest(statuses.schema, tombstone), statuses.schema, "Update", "None")

    def write(batch: DataFrame, batch_id: int) -> None:
        if sink:
            batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(sink)
        else:
            batch.write.format("noop").mode("overwrite").save()
    writer = changed.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    # A query keeps the settings it was started with.
    before = {name: spark.conf.get(name, None) for name in STATE_STORE}
    try:
        for name, value in STATE_STORE.items():
            spark.conf.set(name, value)
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def latest_state(spark: SparkSession, checkpoint: str, *, key: str = "equipmentId", tombstone: str = "severity") -> DataFrame:
    """The newest row of every key that is not deleted, read from the state of a query."""
    read = lambda name: spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
    last = read("last").select("value.*")
    gone = read("gone").select(F.col(f"key.{key}").alias(key), "value.partition", "value.offset")
    return latest_by_key(last.unionByName(gone, allowMissingColumns=True), key, order=("partition", "offset"), tombstone=tombstone)
