"""Counts of a running stream as a table: what each micro-batch received, dropped and found, by observation.

Observations (``route.counted``, ``route.observed``) ride on the stream's own plan. A listener takes them from
the progress of each micro-batch and writes them to a folder of their own, so a batch that is repeated
after a restart overwrites its first attempt, and a run that goes on adds rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

METRICS = "observation string, metric string, value long, run string, batch long"


class MetricsTable(StreamingQueryListener):
    """Appends the observations of every stream of a session (or of the named ``queries``) to the table under ``path``."""

    def __init__(self, spark: SparkSession, path: str, queries: Iterable[str] | None = None):
        self.spark, self.path, self.queries = spark, path, set(queries) if queries is not None else None
        self.failed: list[Exception] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if self.queries is not None and progress.name not in self.queries or not progress.observedMetrics:
            return
        rows = [(name, metric, int(value)) for name, row in progress.observedMetrics.items()
                for metric, value in row.asDict().items() if value is not None]
        try:
            # A handful of numbers for each batch.
            self.spark.createDataFrame(rows, "observation string, metric string, value long").coalesce(1).write.mode("overwrite").parquet(
                f"{self.path}/run={progress.id}/batch={progress.batchId}")
        except Exception as error:  # noqa: BLE001  (the bus would swallow it; the reader of the table gets it instead)
            self.failed.append(error)

    def onQueryTerminated(self, event) -> None:
        pass

    def flush(self) -> None:
        """Wait until the progress that was reported so far is written; raises what a write ran into."""
        self.spark._jsc.sc().listenerBus().waitUntilEmpty()
        if self.failed:
            raise self.failed[0]

    def __enter__(self) -> MetricsTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *raised) -> None:
        try:
            self.flush()
        finally:
            self.spark.streams.removeListener(self)


def metrics_table(spark: SparkSession, path: str) -> DataFrame:
    """``observation, metric, value, run, batch``: a row per number and micro-batch."""
    return spark.read.schema(METRICS).option("basePath", path).parquet(path)
