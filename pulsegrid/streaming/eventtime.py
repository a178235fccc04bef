"""Status changes in event-time order over micro-batches that arrive out of order.

Records wait in a buffer table until the watermark (the latest time seen, less the ``bound`` by which
records may be out of order) has passed them; then no earlier record can come any more, and what has been
passed is worked off in event-time order, after each equipment's last known status. A record the
watermark had already passed when it came is late: it changes nothing and is kept in a table of its own.

A step is the batch job over the rows that became final (``status_changes``), so an equipment with very many
records is cut into chunks and not ordered in one task. Buffer and known statuses take
turns between two slots, as in ``LatestStatus``: a repeated batch finds its input untouched.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.operators.changes import EVENT_TIME, status_changes
from pulsegrid.operators.tables import latest_by_key
from pulsegrid.streaming.sinks import Transform, _delete, _exists

PROGRESS = "asOfBatch long, watermark timestamp, latest timestamp"


class EventTimeChanges:
    """Changes under ``path``/changes, late records under ``path``/late; ``close`` works off what still waits.

    Rows need ``timestamp`` and ``eventId``. Rows without a time are late at once.
    """

    def __init__(self, transform: Transform, path: str, *, bound: dt.timedelta, key: str = "equipmentId", chunk_rows: int = 20_000_000):
        self.transform, self.path, self.bound, self.key, self.chunk_rows = transform, path, bound, key, chunk_rows

    def _slot(self, spark: SparkSession, before: int | None) -> tuple[str, int, dt.datetime | None, dt.datetime | None] | None:
        """The newest finished slot, of those older than batch ``before``."""
        found = []
        for slot in (0, 1):
            path = f"{self.path}/state/slot={slot}"
            if _exists(spark, f"{path}/progress/_SUCCESS"):
                row = spark.read.schema(PROGRESS).parquet(f"{path}/progress").first()
                if before is None or row[0] < before:
                    found.append((path, *row))
        return max(found, key=lambda f: f[1], default=None)

    def changes(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/changes").drop("batch")

    def late(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/late").drop("batch")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._step(self.transform(batch), batch_id, closing=False)

    def close(self, spark: SparkSession) -> None:
        """No more records will come: the buffer is final. Later batches would all be late."""
        last = self._slot(spark, None)
        if last is not None and last[3] is not None and (last[2] is None or last[2] < last[3]):
            self._step(spark.read.parquet(f"{last[0]}/buffer").limit(0), last[1] + 1, closing=True)

    def _step(self, statuses: DataFrame, batch_id: int, closing: bool) -> None:
        spark, path = statuses.sparkSession, f"{self.path}/state/slot={batch_id % 2}"
        before = self._slot(spark, batch_id)
        passed, latest = (None, None) if before is None else before[2:]
        # Decoded and judged once, for the maximum and the writes.
        statuses = statuses.persist()
        try:
            newest = max(filter(None, (latest, statuses.agg(F.max("timestamp")).first()[0])), default=None)
            is_late = F.col("timestamp").isNull() if passed is None else F.col("timestamp").isNull() | (F.col("timestamp") <= F.lit(passed))
            self._append(statuses.filter(is_late), "late", batch_id)
            waiting = statuses.filter(~is_late)
            watermark = newest if closing or newest is None else newest - self.bound
            if passed is not None:
                watermark = max(passed, watermark)
            known = None
            if before is not None:
                waiting = waiting.unionByName(spark.read.parquet(f"{before[0]}/buffer"))
                known = spark.read.parquet(f"{before[0]}/known")
            final = F.lit(False) if watermark is None else F.col("timestamp") <= F.lit(watermark)
            rows = waiting.filter(final).withColumn("_known", F.lit(False))
            if known is not None:
                # An equipment's last known status is the row before its first new one.
                rows = rows.unionByName(known.withColumn("_known", F.lit(True)))
            changed = status_changes(rows, key=self.key, order=EVENT_TIME, chunk_rows=self.chunk_rows)
            self._append(changed.filter(~F.col("_known")).drop("_known"), "changes", batch_id)
            # The mark last: a slot without it is not read.
            _delete(spark, f"{path}/progress/_SUCCESS")
            latest_by_key(rows.drop("_known"), self.key, order=EVENT_TIME, tombstone=None).write.mode("overwrite").parquet(f"{path}/known")
            waiting.filter(~final).write.mode("overwrite").parquet(f"{path}/buffer")
            spark.createDataFrame([(batch_id, watermark, newest)], PROGRESS).coalesce(1).write.mode("overwrite").parquet(f"{path}/progress")
        finally:
            statuses.unpersist()

    def _append(self, rows: DataFrame, name: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={batch_id}")
