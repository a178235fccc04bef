"""Status changes per equipment, computed without ever holding one equipment in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATUS_EVENT_VERSION = "1.0.0"
EVENT_TIME = ("timestamp", "eventId")
LOG = ("partition", "offset")


def status_changes(
    statuses: DataFrame, *, key: str = "equipmentId", status: str = "severity",
    order: tuple[str, str] = EVENT_TIME, chunk_rows: int = 20_000_000, chunks: int | None = None,
) -> DataFrame:
    """Rows whose status differs from the one before, with ``previousStatus`` (null at first).

    A window over the key alone would send a hot key to one task. Here each key
    is cut into chunks of consecutive rows:

    1. inside a chunk, ``lag`` finds the previous status; the first and the last
       row of the chunk are marked, the last by having no next one, so no frame is held;
    2. rows that are neither marked nor a change are dropped;
    3. the marked rows of a key, at most two per chunk, meet in a second window,
       where a first row takes over the status of the last row before it. The
       other rows stay with their chunk.

    In log order a chunk is a range of offsets of one topic partition, so it
    never holds more than ``chunk_rows`` rows. In any other order the chunks
    are the pieces of a range partitioning by (key, order), which Spark samples
    to equal size whatever the skew; as many as it takes to hold about
    ``chunk_rows`` rows each (the rows are counted), or ``chunks``.
    """
    if order == LOG:
        # One number per range of offsets, in (partition, offset) order.
        pieces = statuses.withColumn("_chunk", F.expr(f"shiftleft(CAST(partition AS BIGINT), 40) + offset div {chunk_rows}"))
    else:
        by = [F.col(c) for c in (key, *order)]
        spread = statuses.repartitionByRange(chunks or _chunks_for(statuses, chunk_rows), *by)
        pieces = spread.withColumn("_chunk", F.spark_partition_id())

    inside = Window.partitionBy(key, "_chunk").orderBy(*order)
    marked = pieces.withColumns({
        "previousStatus": F.lag(status).over(inside),
        "_first": F.row_number().over(inside) == 1,
        "_last": F.lead(F.lit(1)).over(inside).isNull(),
    })
    differs = ~F.col(status).eqNullSafe(F.col("previousStatus"))
    candidates = marked.filter(F.col("_first") | F.col("_last") | differs)
    ends = F.col("_first") | F.col("_last")
    across = Window.partitionBy(key, ends, F.when(~ends, F.col("_chunk"))).orderBy("_chunk", *order)
    previous = F.when(F.col("_first"), F.lag(status).over(across)).otherwise(F.col("previousStatus"))
    return (
        candidates.withColumn("previousStatus", previous)
        .filter(F.col("previousStatus").isNull() | (F.col(status) != F.col("previousStatus")))
        .select(*statuses.columns, "previousStatus")
    )


def _chunks_for(statuses: DataFrame, chunk_rows: int) -> int:
    """Pieces of about ``chunk_rows`` rows, no fewer than the session's shuffle partitions."""
    at_least = int(statuses.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(at_least, -(-statuses.count() // chunk_rows))


def status_event(changes: DataFrame, *, status: str = "severity") -> DataFrame:
    """Changes in the layout of the status contract."""
    return changes.select(
        "equipmentId",
        F.unix_millis("timestamp").alias("timestamp"),
        F.struct(
            F.col(status).alias("status"),
            "previousStatus",
            F.lit(None).cast("string").alias("reasonCode"),
            F.create_map(F.lit("healthScore"), F.col("healthScore").cast("string")).alias("details"),
        ).alias("payload"),
        "correlationId",
        F.lit(STATUS_EVENT_VERSION).alias("schemaVersion"),
        F.col("eventId").alias("sourceEventId"),
    )
