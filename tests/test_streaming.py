"""The streaming plans: same results as batch, whatever the cuts and the losses."""

import pytest
from pyspark.sql import functions as F

from checks import events as ev
from pulsegrid.operators import changes, route, rules_status, tables
from pulsegrid.plans import health, ingest
from pulsegrid.sources.topics import file_topic, with_source_place
from pulsegrid.streaming import sinks

AT = "2026-01-01 00:00:00"


@pytest.fixture(scope="module")
def archive(spark, sf_dir, tmp_path_factory):
    """The telemetry topic as several files, in offset order."""
    path = str(tmp_path_factory.mktemp("archive")) + "/topic"
    topic = ev.faulty_topic(ev.read_events(spark, sf_dir), "stream")
    for i in range(4):
        topic.filter(F.col("offset") % 1000 >= 250 * i).filter(F.col("offset") % 1000 < 250 * (i + 1)).coalesce(1) \
            .write.mode("append").parquet(path)
    return path


def _rows(df):
    return sorted(tuple(r) for r in df.select("topic", "key", "value", "sourceOffset").collect())


def _plan(topic):
    return health.stream_messages(topic, processed_at=F.lit(AT).cast("timestamp"))


def test_stream_equals_batch(spark, archive, tmp_path):
    stream = file_topic(spark, archive, streaming=True, max_files_per_trigger=1)
    query = sinks.run(stream, _plan, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    assert len({p["batchId"] for p in query.recentProgress if p["numInputRows"]}) == 4
    assert _rows(sinks.messages_table(spark, f"{tmp_path}/out")) == _rows(_plan(file_topic(spark, archive)))


def test_restart_adds_nothing(spark, archive, tmp_path):
    for _ in range(2):
        stream = file_topic(spark, archive, streaming=True)
        sinks.run(stream, _plan, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    assert _rows(sinks.messages_table(spark, f"{tmp_path}/out")) == _rows(_plan(file_topic(spark, archive)))


def test_a_lost_batch_is_repeated_without_copies(spark, archive, tmp_path):
    """The write of a batch succeeds but the query dies before the batch is committed."""
    out, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    calls = []

    def dying(batch, batch_id):
        sinks.write_messages(_plan(batch), out, batch_id, run=sinks.run_of(batch), source=batch)
        calls.append(batch_id)
        if len(calls) == 2:
            raise RuntimeError("executor lost")

    def start(write):
        stream = file_topic(spark, archive, streaming=True, max_files_per_trigger=1)
        return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint) \
            .trigger(availableNow=True).start()

    with pytest.raises(Exception, match="executor lost"):
        start(dying).awaitTermination()
    start(dying).awaitTermination()
    assert calls == [0, 1, 1, 2, 3]
    assert _rows(sinks.messages_table(spark, out)) == _rows(_plan(file_topic(spark, archive)))


def _halves(spark, archive, tmp_path):
    """A second archive that holds only the newer half of the records, in one file."""
    file_topic(spark, archive).filter(F.col("offset") >= 500).coalesce(1).write.parquet(f"{tmp_path}/newer")
    return f"{tmp_path}/newer"


def test_replay_replaces_what_it_reads_and_leaves_the_rest(spark, archive, tmp_path):
    out, expected = f"{tmp_path}/out", _rows(_plan(file_topic(spark, archive)))
    run = lambda path, files, checkpoint: sinks.run(
        file_topic(spark, path, streaming=True, max_files_per_trigger=files), _plan, out, f"{tmp_path}/{checkpoint}").awaitTermination()
    run(archive, 1, "a")
    run(archive, 2, "b")
    assert _rows(sinks.messages_table(spark, out)) == expected
    run(_halves(spark, archive, tmp_path), 1, "c")
    table = sinks.messages_table(spark, out)
    assert _rows(table) == expected
    runs = {r.run: (r.low, r.high) for r in table.groupBy("run").agg(F.min("sourceOffset").alias("low"), F.max("sourceOffset").alias("high")).collect()}
    assert len(runs) == 2 and {high < 500 or low >= 500 for low, high in runs.values()} == {True}


def test_a_replay_with_other_rules_answers_for_its_records(spark, archive, tmp_path):
    """Records the newer run drops have no message any more, though an older run wrote one."""
    out = f"{tmp_path}/out"
    sinks.run(file_topic(spark, archive, streaming=True), _plan, out, f"{tmp_path}/a").awaitTermination()
    even = lambda batch: _plan(batch).filter("sourceOffset % 2 = 0")
    sinks.run(file_topic(spark, archive, streaming=True), even, out, f"{tmp_path}/b").awaitTermination()
    assert _rows(sinks.messages_table(spark, out)) == _rows(even(file_topic(spark, archive)))


def test_uncommitted_batches_are_not_read(spark, archive, tmp_path):
    out, batch = f"{tmp_path}/out", file_topic(spark, archive)
    sinks._write(_plan(batch), out, 0, "lost")
    assert sinks.messages_table(spark, out).count() == 0
    sinks.write_messages(_plan(batch), out, 0, run="lost", source=batch)
    assert _rows(sinks.messages_table(spark, out)) == _rows(_plan(batch))


def test_compaction_keeps_messages_and_later_batches(spark, archive, tmp_path):
    out, whole = f"{tmp_path}/out", file_topic(spark, archive)
    parts = [whole.filter(F.floor(F.col("offset") / 250) == i) for i in range(4)]
    for i in range(3):
        sinks.write_messages(_plan(parts[i]), out, i, run="live", source=parts[i])
    sinks.compact(spark, out)
    sinks.write_messages(_plan(parts[3]), out, 3, run="live", source=parts[3])
    assert _rows(sinks.messages_table(spark, out)) == _rows(_plan(whole))
    assert sinks.drop_hidden(spark, out) == ["live"]
    assert _rows(sinks.messages_table(spark, out)) == _rows(_plan(whole))
    assert sinks.messages_table(spark, out).filter("run = 'live'").agg(F.min("sourceOffset")).first()[0] >= 750


def test_interleaved_batches_are_an_error(spark, archive, tmp_path):
    out, whole = f"{tmp_path}/out", file_topic(spark, archive)
    for i in range(2):
        part = whole.filter(F.col("offset") % 2 == i)
        sinks.write_messages(_plan(part), out, i, run="mixed", source=part)
    with pytest.raises(Exception, match="not in order"):
        sinks.messages_table(spark, out).count()


def test_kafka_copies_by_their_headers(spark, archive, tmp_path):
    sent = _plan(file_topic(spark, archive))
    twice = sent.unionByName(sent.limit(100)).select(
        "key", "value", "topic", F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"),
        F.col("recordTimestamp").alias("timestamp"), F.array(*sinks.source_headers()).alias("headers"))
    back = with_source_place(twice)
    assert _rows(sinks.once(back)) == _rows(sent)
    strange = spark.createDataFrame([(None, [("source", b"no place")]), (None, None), (None, [("source", b"a/b/3/4")])],
                                    "key string, headers array<struct<key string, value binary>>").selectExpr(
        "key", "'v' AS value", "'t' AS topic", "0 AS partition", "1L AS offset", "timestamp'2026-01-01' AS timestamp", "headers")
    places = {(r.sourceTopic, r.sourcePartition, r.sourceOffset) for r in with_source_place(strange).collect()}
    assert places == {(None, None, None), ("a/b", 3, 4)} and sinks.once(with_source_place(strange)).count() == 3
    # On a stream, with bounded state.
    twice.drop("headers").withColumn("headers", F.array(*[F.struct(
        F.lit("source").alias("key"), F.concat_ws("/", "topic", F.lit("0"), "offset").cast("binary").alias("value"))])).write.parquet(f"{tmp_path}/kafka")
    stream = with_source_place(spark.readStream.schema(spark.read.parquet(f"{tmp_path}/kafka").schema).parquet(f"{tmp_path}/kafka"))
    query = sinks.once(stream, within="1 hour").writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()


def test_copies_are_dropped_by_place(spark, archive):
    messages = _plan(file_topic(spark, archive))
    assert sinks.once(messages.unionByName(messages)).count() == messages.count()


def test_retention_skips_day_folders(spark, sf_dir, tmp_path):
    sinks.write_messages(health.status_messages(ev.telemetry_topic(ev.read_events(spark, sf_dir), "status")),
                         f"{tmp_path}/out", 0)
    table = sinks.messages_table(spark, f"{tmp_path}/out")
    kept = sinks.retained(table, "equipment.status", 7, F.lit("2024-01-31 00:00:00"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan and "2024-01-24" in plan.split("PartitionFilters")[1][:200]
    assert kept.count() == table.filter(
        "topic = 'equipment.status' AND recordTimestamp >= timestamp'2024-01-24 00:00:00'").count() > 0


def test_ingest_stream(spark, sf_dir, tmp_path):
    bodies = lambda streaming: ev.ingestion_documents(ev.read_events(spark, sf_dir, streaming=streaming))
    plan = lambda b: ingest.messages(b, as_of=F.lit(AT).cast("timestamp"))
    sinks.run(bodies(True), plan, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    assert _rows(sinks.messages_table(spark, f"{tmp_path}/out")) == _rows(plan(bodies(False)))


def _log(topic):
    return rules_status.score(ev.telemetry(topic)).select(
        "topic", "partition", "offset", "equipmentId", "eventId", "timestamp", "severity", "healthScore")


def test_latest_status_and_changes_over_batches(spark, sf_dir, tmp_path):
    events = ev.read_events(spark, sf_dir)
    for i in range(5):
        events.filter(F.floor(F.col("event_id") / 200) == i).coalesce(1).write.mode("append").parquet(f"{tmp_path}/events")
    table = sinks.LatestStatus(_log, f"{tmp_path}/table", chunk_rows=50)
    source = spark.readStream.schema(ev.EVENTS_SCHEMA).option("maxFilesPerTrigger", "1") \
        .option("latestFirst", "false").parquet(f"{tmp_path}/events")
    seen = []

    def flaky(batch, batch_id):
        table(batch, batch_id)
        seen.append(batch_id)
        if len(seen) in (2, 5):
            raise RuntimeError("executor lost")

    for _ in range(3):
        query = source.writeStream.foreachBatch(flaky).option("checkpointLocation", f"{tmp_path}/c") \
            .trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        except Exception as error:  # noqa: BLE001
            assert "executor lost" in str(error)
    assert seen == [0, 1, 1, 2, 3, 3, 4]

    whole = _log(events)
    columns = ["equipmentId", "offset", "severity"]
    rows = lambda df, *more: sorted(tuple(r) for r in df.select(*columns, *more).collect())
    assert rows(table.snapshot(spark)) == rows(
        tables.latest_by_key(whole, "equipmentId", order=changes.LOG, tombstone="severity"))
    text = F.coalesce("previousStatus", F.lit("")).alias("p")
    assert rows(table.changes(spark), text) == rows(changes.status_changes(whole, order=changes.LOG), text)


def test_observed_counts_in_progress(spark, sf_dir, tmp_path):
    source = route.observed(_log(ev.read_events(spark, sf_dir, streaming=True)), "routing")
    query = source.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c") \
        .trigger(availableNow=True).start()
    query.awaitTermination()
    counts = [p["observedMetrics"]["routing"] for p in query.recentProgress if p["numInputRows"]][0]
    assert (counts["received"], counts["critical"], counts["warning"]) == (1000, 412, 47)
