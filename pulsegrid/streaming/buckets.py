"""Latest status per equipment as a table in key buckets, of which a micro-batch rewrites only those it has records of.

A batch writes the buckets it has met as folders of its own, ``rows/batch=N/bucket=B``, then a map of the newest
batch of every bucket, ``versions/batch=N``. Readers go by the newest map, so a batch that died before its map is not
read, and a repeated one starts from the map before it and overwrites its own folders. The map has at most as many rows as there are
buckets, and is what reaches the driver.

Defined results: rows without a key share one key; a newest row whose ``tombstone`` column is null deletes its key (and a bucket without keys
is a version without rows); a batch without rows writes a map only. Batches must come in log order, as a topic delivers them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.operators.changes import LOG
from pulsegrid.operators.tables import key_partition, latest_by_key
from pulsegrid.streaming.sinks import _delete, _exists, _read


class BucketedLatest:
    """Kept up by ``sinks.run_latest``; the number of buckets belongs to the table and cannot change later."""

    def __init__(
        self, transform: Callable[[DataFrame], DataFrame], path: str, *, key: str = "equipmentId",
        tombstone: str | None = "severity", buckets: int = 256,
    ):
        self.transform, self.path, self.key, self.tombstone, self.buckets = transform, path, key, tombstone, buckets

    def _bucket(self) -> Column:
        return key_partition(self.key, self.buckets)

    def versions(self, spark: SparkSession, before: int | None = None) -> dict[int, int]:
        """The batch that holds each bucket, by the newest map or the newest one older than batch ``before``."""
        maps = _read(spark, f"{self.path}/versions", "bucket int, written long, batch long")
        maps = maps if before is None else maps.filter(F.col("batch") < before)
        newest = maps.agg(F.max("batch")).first()[0]
        return {} if newest is None else {r.bucket: r.written for r in maps.filter(F.col("batch") == newest).collect() if r.bucket is not None}

    def _rows(self, spark: SparkSession, held: dict[int, int], schema: T.StructType) -> DataFrame:
        """The rows of ``held`` buckets; only their folders are listed."""
        folders = [f"{self.path}/rows/batch={batch}/bucket={bucket}" for bucket, batch in sorted(held.items())]
        # A bucket whose keys are all deleted has no folder.
        folders = [f for f in folders if _exists(spark, f)]
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def snapshot(self, spark: SparkSession, schema: T.StructType, before: int | None = None) -> DataFrame:
        """The newest row of every key that is not deleted, as of the newest batch or the one before ``before``."""
        return self._rows(spark, self.versions(spark, before), schema)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Kept for its buckets and its rows, so the records are decoded and judged once.
        statuses = self.transform(batch).persist()
        try:
            held = self.versions(spark, before=batch_id)
            met = [r.bucket for r in statuses.select(self._bucket().alias("bucket")).distinct().collect()]
            known = self._rows(spark, {b: held[b] for b in met if b in held}, statuses.schema)
            latest = latest_by_key(statuses.unionByName(known), self.key, order=LOG, tombstone=self.tombstone)
            # Gathered by bucket for few files; a large bucket is split.
            latest.withColumn("bucket", self._bucket()).hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy(
                "bucket").parquet(f"{self.path}/rows/batch={batch_id}")
            held |= dict.fromkeys(met, batch_id)
            # A table that never had a row still says which batch it has seen.
            rows = sorted(held.items()) or [(None, batch_id)]
            spark.createDataFrame(rows, "bucket int, written long").coalesce(1).write.mode("overwrite").parquet(
                f"{self.path}/versions/batch={batch_id}")
        finally:
            statuses.unpersist()

    def clean(self, spark: SparkSession) -> int:
        """Delete what neither the newest map nor the one before it names; returns the number of bucket folders.

        The one before is what a repeat of the newest batch starts from. No reader may hold an older view meanwhile.
        """
        if not _exists(spark, f"{self.path}/versions"):
            return 0
        maps = _read(spark, f"{self.path}/versions", "bucket int, written long, batch long")
        newest = [r.batch for r in maps.select("batch").distinct().orderBy(F.desc("batch")).limit(2).collect()]
        used = maps.filter(F.col("batch").isin(newest)).select("bucket", F.col("written").alias("batch")).distinct()
        there = _read(spark, f"{self.path}/rows", "batch long, bucket int").filter(F.col("batch") <= newest[0]).distinct()
        gone = 0
        # Folders and not rows come to the driver, as for any listing of them.
        for r in there.join(used, ["bucket", "batch"], "left_anti").toLocalIterator():
            _delete(spark, f"{self.path}/rows/batch={r.batch}/bucket={r.bucket}")
            gone += 1
        for r in maps.filter(F.col("batch") < newest[-1]).select("batch").distinct().toLocalIterator():
            _delete(spark, f"{self.path}/versions/batch={r.batch}")
        return gone
