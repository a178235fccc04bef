"""Sinks of the streaming plans: a message table with runs, Kafka, and the latest-status table.

A message table belongs to any number of runs. A run is one streaming query with
its checkpoint (or one backfill); its identity is kept by the checkpoint, so a
restart goes on with the same run and a repeated micro-batch overwrites its own
folders. With every batch the run commits which source offsets it has answered
for. Readers take, for each source record, the messages of the newest run that
answers for it: a replay from earliest replaces what it has read again and
leaves older records, which the source may no longer hold, as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.operators.changes import LOG, status_changes
from pulsegrid.operators.tables import key_pieces, latest_by_key
from pulsegrid.sources.topics import SOURCE_HEADER

Transform = Callable[[DataFrame], DataFrame]

MESSAGES = T.StructType([
    T.StructField("sourceTopic", T.StringType()),
    T.StructField("sourcePartition", T.IntegerType()),
    T.StructField("sourceOffset", T.LongType()),
    T.StructField("recordTimestamp", T.TimestampType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("run", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("day", T.DateType()),
    T.StructField("keyPartition", T.IntegerType()),
    T.StructField("batch", T.LongType()),
])
COMMITS = "sourceTopic string, sourcePartition int, firstOffset long, lastOffset long, run string, batch long"
RUNS = "seq long, run string"
#: Offsets of a bucket in the join of messages with the offsets in force.
BUCKET = 1 << 24


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _read(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if _exists(spark, path) else spark.createDataFrame([], schema)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """Which source offsets each batch of each run has answered for, and the place ``seq`` of the run in their order."""
    return _read(spark, f"{path}/commits", COMMITS).join(_read(spark, f"{path}/runs", RUNS), "run")


def _register(spark: SparkSession, path: str, run: str) -> None:
    """Give a new run its place after all others; there is one row per run."""
    if _exists(spark, f"{path}/runs/run={run}/_SUCCESS"):
        return
    last = _read(spark, f"{path}/runs", RUNS).agg(F.max("seq")).first()[0] or 0
    spark.createDataFrame([(last + 1,)], "seq long").coalesce(1).write.mode("overwrite").parquet(f"{path}/runs/run={run}")


def _commit(ranges: DataFrame, path: str, run: str, batch_id: int) -> None:
    _register(ranges.sparkSession, path, run)
    (
        ranges.select("sourceTopic", "sourcePartition", "firstOffset", "lastOffset", F.lit(run).alias("run"), F.lit(batch_id).alias("batch"))
        .coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("run", "batch").parquet(f"{path}/commits")
    )


def _ranges(source: DataFrame) -> DataFrame:
    """The offsets of a batch. A topic delivers each partition in offset order, so a range says it all."""
    return source.groupBy(F.col("topic").alias("sourceTopic"), F.col("partition").alias("sourcePartition")).agg(
        F.min("offset").alias("firstOffset"), F.max("offset").alias("lastOffset"))


def write_messages(
    messages: DataFrame, path: str, batch_id: int, *, run: str = "run-0", source: DataFrame | None = None,
    clustered: bool = False, key_partitions: int | None = None, rows_per_piece: int = 5_000_000,
) -> None:
    """One write for all topics: folders by run, topic, day, key partition and micro-batch.

    The day comes from the record, not from the clock, so a repeated batch
    overwrites exactly the folders of its first attempt. ``source`` are the
    records the messages were made of; their offsets are committed after the
    write (without it, those of the messages, read from what was written).

    ``clustered`` gathers the rows of a topic and day into few files first, for
    backfills over many days; Spark splits large ones by size. ``key_partitions``
    keeps the messages of a key together by number, each number written
    in as many pieces as it has ``rows_per_piece`` rows.
    """
    _write(messages, path, batch_id, run, clustered=clustered, key_partitions=key_partitions, rows_per_piece=rows_per_piece)
    if source is None:
        # Not from the messages: that would make all of them once more.
        written = _read(messages.sparkSession, f"{path}/messages", MESSAGES).filter((F.col("run") == run) & (F.col("batch") == batch_id))
        source = written.selectExpr("sourceTopic AS topic", "sourcePartition AS partition", "sourceOffset AS offset")
    _commit(_ranges(source), path, run, batch_id)


def _write(messages: DataFrame, path: str, batch_id: int, run: str, **layout) -> None:
    (
        laid_out(messages, **layout).withColumns({"run": F.lit(run), "batch": F.lit(batch_id)}).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run", "topic", "day", "keyPartition", "batch").parquet(f"{path}/messages")
    )


def laid_out(
    messages: DataFrame, *, clustered: bool = False, key_partitions: int | None = None, rows_per_piece: int = 5_000_000,
) -> DataFrame:
    """Messages with their folder columns; nothing is shuffled unless the layout asks for it."""
    rows = messages.withColumn("day", F.to_date(F.coalesce("recordTimestamp", F.timestamp_seconds(F.lit(0)))))
    if key_partitions:
        return key_pieces(rows, key_partitions, offset="sourceOffset", rows_per_piece=rows_per_piece, within=("day",))
    rows = rows.withColumn("keyPartition", F.lit(0))
    return rows.hint("rebalance", F.col("topic"), F.col("day")) if clustered else rows


def messages_table(spark: SparkSession, path: str, *, as_of: DataFrame | None = None) -> DataFrame:
    """The messages in force; filters on topic and day prune folders.

    Of a source record that several runs have read only the newest one's messages
    count. Batches that were never committed are left out. ``as_of`` takes an
    earlier reading of ``commits``.

    Messages are not dealt out by batch or by offsets, as few of either may have all of them: what is joined with them
    goes to their tasks, a row for each batch and one for each range in force.
    """
    done = commits(spark, path) if as_of is None else as_of
    rows = _read(spark, f"{path}/messages", MESSAGES).join(F.broadcast(done.select("run", "batch", "seq").distinct()), ["run", "batch"])
    newest = in_force(islands(done)).select(
        F.col("sourceTopic").alias("_topic"), F.col("sourcePartition").alias("_partition"), "firstOffset", "lastOffset", F.col("seq").alias("_seq"),
        F.explode(F.expr(f"sequence(firstOffset div {BUCKET}, lastOffset div {BUCKET})")).alias("_bucket"))
    here = (
        (F.col("sourceTopic") == F.col("_topic")) & (F.col("sourcePartition") == F.col("_partition"))
        & (F.expr(f"sourceOffset div {BUCKET}") == F.col("_bucket")) & F.col("sourceOffset").between(F.col("firstOffset"), F.col("lastOffset"))
    )
    return rows.join(F.broadcast(newest), here, "left").filter("_seq IS NULL OR _seq <= seq").select(*[f.name for f in MESSAGES])


def islands(done: DataFrame) -> DataFrame:
    """What each run has read without a break: ranges of batches that follow each other, as one.

    A run reads a partition in order, so a batch answers for all offsets from where the batch before it
    ended, whether there is a record at each of them or not (transactions and compaction leave gaps). So a run
    that has lost no batch has one range for each partition, however many batches it had. Batches of one run that
    reach into each other's offsets raise an error: such a source was not in offset order, and ranges cannot
    tell what was read.
    """
    each = Window.partitionBy("run").orderBy("batch")
    streaks = done.select("run", "batch").distinct().withColumn(
        "streak", F.sum((F.col("batch") != F.coalesce(F.lag("batch").over(each) + 1, F.lit(-1))).cast("int")).over(each))
    by = Window.partitionBy("run", "sourceTopic", "sourcePartition").orderBy("firstOffset")
    mixed = F.raise_error(F.concat(F.lit("offsets of run "), "run", F.lit(" are not in order at batch "), F.col("batch").cast("string")))
    # Gaps may be closed only between batches in their order.
    disorder = (F.lag("lastOffset").over(by) >= F.col("firstOffset")) | (F.lag("batch").over(by) >= F.col("batch"))
    checked = done.withColumn("firstOffset", F.when(disorder, mixed.cast("long")).otherwise(F.col("firstOffset")))
    return checked.join(streaks, ["run", "batch"]).groupBy("seq", "run", "sourceTopic", "sourcePartition", "streak").agg(
        F.min("firstOffset").alias("firstOffset"), F.max("lastOffset").alias("lastOffset")).drop("streak")


def in_force(ranges: DataFrame) -> DataFrame:
    """Ranges that may overlap as ranges that do not: ``sourceTopic, sourcePartition, firstOffset, lastOffset`` and the newest ``seq`` over them.

    Between two neighbouring edges of ranges the same ranges lie; a sweep over the edges keeps, for each
    stretch, the newest of those open. The table is as small as the number of runs and breaks.
    """
    place = ("sourceTopic", "sourcePartition")
    edges = ranges.select(*place, F.col("firstOffset").alias("at")).union(ranges.select(*place, (F.col("lastOffset") + 1).alias("at"))).distinct()
    stretches = edges.withColumn("end", F.lead("at").over(Window.partitionBy(*place).orderBy("at"))).filter("end IS NOT NULL")
    over = stretches.join(ranges, list(place)).filter("firstOffset <= at AND lastOffset >= end - 1")
    newest = over.groupBy(*place, "at", "end").agg(F.max("seq").alias("seq"))
    # Neighbours of the same run are one range again.
    by = Window.partitionBy(*place).orderBy("at")
    begins = (F.lag("seq").over(by).isNull() | (F.lag("seq").over(by) != F.col("seq")) | (F.lag("end").over(by) != F.col("at"))).cast("int")
    marked = newest.withColumns({"begins": begins, "firstOffset": F.col("at"), "lastOffset": F.col("end") - 1})
    return _joined(marked, by, *place, "seq")


def _joined(marked: DataFrame, by, *names: str) -> DataFrame:
    return marked.withColumn("island", F.sum("begins").over(by)).groupBy(*names, "island").agg(
        F.min("firstOffset").alias("firstOffset"), F.max("lastOffset").alias("lastOffset")).drop("island")


def backfill(messages: DataFrame, source: DataFrame, path: str, *, run: str | None = None, **layout) -> str:
    """Write a batch plan's messages as a run of its own, gathered by topic and day; returns the run."""
    name = run or f"backfill-{uuid.uuid4().hex}"
    write_messages(messages, path, 0, run=name, source=source, **{"clustered": True, **layout})
    return name


def compact(spark: SparkSession, path: str, **layout) -> str:
    """Rewrite the messages in force as one run with large files; later batches of a live run stay in force.

    Readers see either the old folders or the new ones: the new run counts from its
    commit on. ``drop_hidden`` then frees the old ones.
    """
    name = f"compact-{uuid.uuid4().hex}"
    # Placed before the reading: what a new run commits meanwhile comes after it and stays in force.
    _register(spark, path, name)
    seen = commits(spark, path)
    done = islands(seen).persist()
    try:
        _write(messages_table(spark, path, as_of=seen).drop("run", "day", "keyPartition", "batch"), path, 0, name, **{"clustered": True, **layout})
        by = Window.partitionBy("sourceTopic", "sourcePartition").orderBy("firstOffset", "lastOffset")
        reach = F.max("lastOffset").over(by.rowsBetween(Window.unboundedPreceding, -1))
        marked = done.withColumn("begins", (reach.isNull() | (F.col("firstOffset") > reach + 1)).cast("int"))
        _commit(_joined(marked, by, "sourceTopic", "sourcePartition"), path, name, 0)
    finally:
        done.unpersist()
    return name


def drop_hidden(spark: SparkSession, path: str) -> list[str]:
    """Delete batches all of whose offsets newer runs have answered for; returns the runs that lost some.

    No reader or writer may hold an older view of the table meanwhile.
    """
    done = commits(spark, path)
    later = islands(done).select(
        F.col("seq").alias("_seq"), F.col("sourceTopic").alias("_topic"), F.col("sourcePartition").alias("_partition"),
        F.col("firstOffset").alias("_first"), F.col("lastOffset").alias("_last"))
    open_ = done.join(later, F.expr(
        "_topic = sourceTopic AND _partition = sourcePartition AND _first <= firstOffset AND _last >= lastOffset AND _seq > seq"), "left_anti")
    gone = done.select("run", "batch").distinct().join(open_.select("run", "batch").distinct(), ["run", "batch"], "left_anti")
    folders = spark.read.schema(MESSAGES).parquet(f"{path}/messages").select("run", "topic", "day", "keyPartition", "batch").distinct()
    # Folders and not rows come to the driver, as for any listing of them.
    for r in folders.join(gone, ["run", "batch"]).toLocalIterator():
        _delete(spark, f"{path}/messages/run={r.run}/topic={r.topic}/day={r.day}/keyPartition={r.keyPartition}/batch={r.batch}")
    lost = gone.collect()
    for r in lost:
        _delete(spark, f"{path}/commits/run={r.run}/batch={r.batch}")
    return sorted({r.run for r in lost})


def drop_expired(spark: SparkSession, path: str, topic: str, days: int, as_of: Column) -> list[str]:
    """Delete the day folders of a topic that are wholly beyond its retention; returns the days."""
    oldest = F.to_date(as_of.cast("timestamp") - F.make_dt_interval(F.lit(days)))
    table = spark.read.schema(MESSAGES).parquet(f"{path}/messages")
    old = table.filter((F.col("topic") == topic) & (F.col("day") < oldest)).select("run", "day").distinct().collect()
    for r in old:
        _delete(spark, f"{path}/messages/run={r.run}/topic={topic}/day={r.day}")
    return sorted({str(r.day) for r in old})


def retained(table: DataFrame, topic: str, days: int, as_of: Column) -> DataFrame:
    """The messages of a topic that are within its retention; whole day folders are skipped."""
    oldest = as_of.cast("timestamp") - F.make_dt_interval(F.lit(days))
    in_topic = table.filter((F.col("topic") == topic) & (F.col("day") >= F.to_date(oldest)))
    return in_topic.filter(F.col("recordTimestamp") >= oldest)


def source_headers() -> list[Column]:
    """The headers of a message: the place of its source record, which ``with_source_place`` reads."""
    place = F.concat_ws("/", "sourceTopic", F.col("sourcePartition").cast("string"), F.col("sourceOffset").cast("string"))
    return [F.struct(F.lit(SOURCE_HEADER).alias("key"), place.cast("binary").alias("value"))]


def write_kafka(messages: DataFrame, servers: str) -> None:
    """All topics in one Kafka write, by the ``topic`` column.

    Kafka gets a repeated batch twice; readers drop the second copy by the
    source place in the headers (see ``once``).
    """
    (
        messages.select("topic", "key", "value", F.array(*source_headers()).alias("headers"))
        .write.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all").option("includeHeaders", "true").save()
    )


def once(messages: DataFrame, *, within: str | None = None) -> DataFrame:
    """Messages without the copies a repeated batch may have left.

    A message is named by its topic and the place of its source record (what
    ``kafka_topic`` restores with ``with_source``); messages without a place are
    kept as they are. On a stream ``within`` bounds the state: copies further apart
    than that in record time are not looked for.
    """
    name = ["topic", "sourceTopic", "sourcePartition", "sourceOffset"]
    placed, other = messages.filter("sourceOffset IS NOT NULL"), messages.filter("sourceOffset IS NULL")
    if within:
        return placed.withWatermark("timestamp", within).dropDuplicatesWithinWatermark(name).union(other)
    return placed.dropDuplicates(name).union(other)


def run(
    source: DataFrame, transform: Transform, path: str, checkpoint: str, *, name: str | None = None,
    every: str | None = None, **layout,
) -> StreamingQuery:
    """Start a plan from ``source`` to the message table under ``path``.

    Without ``every`` the query works off what is there and stops; with it
    (such as ``"1 second"``) it goes on. After a loss the query restarts from
    the checkpoint and repeats at most the last micro-batch. A new checkpoint
    over the same table is a replay and replaces what it reads again.
    ``layout`` goes to ``write_messages``.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        write_messages(transform(batch), path, batch_id, run=run_of(batch), source=batch, **layout)
    return _start(source, write, checkpoint, name, every)


def run_of(batch: DataFrame) -> str:
    """The identity of the streaming query a micro-batch belongs to; its checkpoint keeps it over restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def run_to_kafka(
    source: DataFrame, transform: Transform, servers: str, checkpoint: str, *, every: str = "1 second",
) -> StreamingQuery:
    return _start(source, lambda batch, _: write_kafka(transform(batch), servers), checkpoint, None, every)


def _start(source, write, checkpoint, name, every) -> StreamingQuery:
    writer = source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


class LatestStatus:
    """The newest status per equipment and its changes, kept up by micro-batches.

    The table is small (one row per equipment) next to the log. Two snapshot
    folders take turns: batch N reads the folder of batch N-1 and overwrites
    the other one, so a repeated batch finds its input untouched. A row whose
    ``tombstone`` column is null deletes its equipment, as in ``latest_by_key``.
    """

    def __init__(
        self, transform: Transform, path: str, *, key: str = "equipmentId", tombstone: str | None = "severity",
        chunk_rows: int = 20_000_000,
    ):
        self.transform, self.path, self.key, self.tombstone, self.chunk_rows = transform, path, key, tombstone, chunk_rows

    def snapshot(self, spark: SparkSession, before: int | None = None) -> DataFrame | None:
        """The newest snapshot, or the newest one older than batch ``before``."""
        found = []
        for slot in (0, 1):
            path = f"{self.path}/latest/slot={slot}"
            # A folder without this mark was never finished.
            if not _exists(spark, f"{path}/_SUCCESS"):
                continue
            row = spark.read.parquet(f"{self.path}/latest/batches/slot={slot}").first()
            if row and (before is None or row[0] < before):
                found.append((row[0], spark.read.parquet(path)))
        return max(found, key=lambda pair: pair[0])[1] if found else None

    def changes(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("mergeSchema", "false").parquet(f"{self.path}/changes").drop("batch")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Kept for the two writes, so the records are decoded and judged once.
        statuses = self.transform(batch).persist()
        try:
            known = self.snapshot(spark, before=batch_id)
            rows = statuses.withColumn("_known", F.lit(False))
            if known is not None:
                # An equipment's last known status takes part as the row before its first new one.
                rows = rows.unionByName(known.withColumn("_known", F.lit(True)))
            changed = status_changes(rows, key=self.key, order=LOG, chunk_rows=self.chunk_rows)
            (
                changed.filter(~F.col("_known")).drop("_known").withColumn("batch", F.lit(batch_id))
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch").parquet(f"{self.path}/changes")
            )
            slot = batch_id % 2
            # The number first: a snapshot without its mark is not read, whatever its number says.
            _delete(spark, f"{self.path}/latest/slot={slot}/_SUCCESS")
            spark.createDataFrame([(batch_id,)], "asOfBatch long").coalesce(1).write.mode("overwrite").parquet(
                f"{self.path}/latest/batches/slot={slot}")
            latest_by_key(rows.drop("_known"), self.key, order=LOG, tombstone=self.tombstone).write.mode("overwrite").parquet(
                f"{self.path}/latest/slot={slot}")
        finally:
            statuses.unpersist()


def run_latest(
    source: DataFrame, table: LatestStatus, checkpoint: str, *, every: str | None = None,
) -> StreamingQuery:
    return _start(source, table, checkpoint, None, every)
