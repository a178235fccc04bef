"""One query per operator, each over the whole ``events`` table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import events as ev
from checks import faulty_bodies
from pulsegrid import contracts
from pulsegrid.config import STATUS_PROFILE, STREAM_PROFILE, BridgeConfig, HealthConfig, IngestConfig, TopicConfig
from pulsegrid.functions import scalar
from pulsegrid.operators import (
    audit, changes, conform, enrich, parse, replay, route, rules_status, rules_stream, tables, validate,
)
from pulsegrid.plans import health, ingest
from pulsegrid.schemas import RAW_CONTRACT, Contract
from pulsegrid.session import RECOMMENDED, work_dir
from pulsegrid.sources.topics import envelope, with_source_place
from pulsegrid.streaming import eventtime, metrics, sinks, state
from pulsegrid.streaming.buckets import BucketedLatest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2024-02-10 00:00:00"
RAW_AS_OF = "2024-01-31 00:00:00"

# A second configuration, so that nothing rests on the defaults.
OTHER_STATUS = HealthConfig(
    temperature_warning=60.0, temperature_critical=110.0, pressure_warning_low=0.9,
    pressure_warning_high=1.1, pressure_critical_low=0.45, pressure_critical_high=1.55,
    critical_codes=("E001", "E010"), warning_codes=("W001", "E002", "X1"),
    temperature_weight=20, pressure_weight=50, error_weight=20,
)
OTHER_STREAM = HealthConfig(
    temperature_warning=50.0, temperature_critical=140.0, pressure_warning_low=0.7,
    pressure_warning_high=1.3, pressure_critical_low=0.42, pressure_critical_high=1.58,
    critical_codes=("E003",), warning_codes=("W010", "W001", "E020"),
    temperature_weight=25, pressure_weight=15, error_weight=35,
)
OPTIONAL_SOURCE = Contract("RawTelemetryEvent", tuple(
    (name, "optional string" if name == "sourceSystem" else kind) for name, kind in RAW_CONTRACT.fields
))


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function
    return register


# -- inputs ------------------------------------------------------------------------------------

def _events(spark: SparkSession, sf_dir: str, *, streaming: bool = False) -> DataFrame:
    # As in session.RECOMMENDED: methods beyond that are interpreted.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", RECOMMENDED["spark.sql.codegen.hugeMethodLimit"])
    return ev.read_events(spark, sf_dir, streaming=streaming)


def _telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.telemetry(_events(spark, sf_dir))


def _topic(spark: SparkSession, sf_dir: str, profile: str, *, streaming: bool = False) -> DataFrame:
    return ev.telemetry_topic(_events(spark, sf_dir, streaming=streaming), profile)


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.ingestion_documents(_events(spark, sf_dir))


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.validate(_bodies(spark, sf_dir))


def _json(path: str, name: str, source: str = "value") -> Column:
    return F.coalesce(F.get_json_object(source, f"$.{path}"), F.lit("")).alias(name)


def _codes(name: str = "errorCodes") -> Column:
    return F.coalesce(F.array_join(name, ",", "null"), F.lit("-")).alias("codes")


def _millis(name: str) -> Column:
    return F.coalesce(F.unix_millis(name), F.lit(-1)).alias("millis")


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)


# -- sources, sinks and table layout -----------------------------------------------------------

@query("s01_telemetry_topic")
def s01(spark, sf_dir):
    return _topic(spark, sf_dir, "status").select(
        "key", "topic", "partition", "offset", _json("equipmentId", "equipmentId"),
        _json("correlationId", "correlationId"),
        F.get_json_object("value", "$.temperature").try_cast("double").alias("temperature"),
    )


@query("s02_ingestion_bodies")
def s02(spark, sf_dir):
    return _bodies(spark, sf_dir).select("offset", "value")


def _written(spark: SparkSession, messages: DataFrame, purpose: str) -> DataFrame:
    path = work_dir(spark, purpose)
    sinks.write_messages(messages, path, 0)
    return sinks.messages_table(spark, path)


@query("s03_status_sink")
def s03(spark, sf_dir):
    topics = TopicConfig()
    a = _written(spark, health.status_messages(_topic(spark, sf_dir, "status")), "status-sink")
    b = _written(spark, health.stream_messages(_topic(spark, sf_dir, "stream")), "stream-sink")
    fields = ["key", "sourceOffset", _json("severity", "severity"), _json("healthScore", "healthScore")]
    one = a.filter(F.col("topic") == topics.status).select(F.lit("status").alias("profile"), *fields)
    two = b.filter(F.col("topic") == topics.status).select(F.lit("stream").alias("profile"), *fields)
    return one.unionByName(two)


@query("s04_alert_sink")
def s04(spark, sf_dir):
    topics = TopicConfig()
    a = _written(spark, health.status_messages(_topic(spark, sf_dir, "status")), "status-sink")
    b = _written(spark, health.stream_messages(_topic(spark, sf_dir, "stream")), "stream-sink")
    fields = ["key", "sourceOffset", _json("correlationId", "correlationId"), _json("healthScore", "healthScore")]
    one = a.filter(F.col("topic") == topics.status_profile_alert).select("topic", *fields)
    two = b.filter(F.col("topic") == topics.stream_profile_alert).select("topic", *fields)
    return one.unionByName(two)


@query("s05_validated_raw_sink")
def s05(spark, sf_dir):
    table = _written(spark, ingest.messages(_bodies(spark, sf_dir)), "raw-sink")
    return table.filter(F.col("topic") == TopicConfig().raw).select(
        "key", "sourceOffset", _json("correlationId", "correlationId"),
        _json("payload.temperature", "temperature"),
    )


@query("s06_dead_letter_sink")
def s06(spark, sf_dir):
    table = _written(spark, ingest.messages(_bodies(spark, sf_dir)), "dead-letter-sink")
    return table.filter(F.col("topic") == TopicConfig().dead_letter).select(
        "key", "sourceOffset", _json("equipmentId", "equipmentId"),
        _json("payload.originalPayload", "originalPayload"),
    )


def _cut(spark: SparkSession, rows: DataFrame, pieces: int, by: str = "event_id", path: str | None = None, only: range | None = None) -> str:
    """``rows`` as pieces of rising ``by``, one written after the other as a topic's segments are; null goes first.

    Each piece has as many files as the rows have partitions (two at least), and more if those had too many rows for one task;
    ``only`` writes some of the pieces.
    """
    path = path or work_dir(spark, "cut")
    low, high, count = rows.agg(F.min(by), F.max(by), F.count(F.lit(1))).first()
    step, files = -(-(high - low + 1) // pieces), max(2, rows.rdd.getNumPartitions(), -(-count // (pieces * ev.ROWS_PER_PIECE)))
    for i in only or range(pieces):
        mine = F.col(by).between(low + i * step, low + (i + 1) * step - 1)
        rows.filter(mine if i else mine | F.col(by).isNull()).repartition(files).write.mode("append").parquet(path)
    return path


def _stream_of(spark: SparkSession, path: str, pieces: int) -> DataFrame:
    """A folder of so many pieces as a stream of one piece for each micro-batch."""
    cut = spark.read.parquet(path)
    return spark.readStream.schema(cut.schema).option("maxFilesPerTrigger", str(max(1, len(cut.inputFiles()) // pieces))).parquet(path)


def _finished(query, batches: int | None = None) -> None:
    query.awaitTermination()
    ran = len({p["batchId"] for p in query.recentProgress if p["numInputRows"]})
    if batches is not None and ran != batches:
        raise RuntimeError(f"{ran} micro-batches ran, {batches} were meant to")


def _health_run(spark, sf_dir, profile: str, cut: str, path: str, checkpoint: str, batches: int) -> None:
    plan = health.status_messages if profile == "status" else health.stream_messages
    topic = ev.telemetry_topic(_stream_of(spark, cut, batches), profile)
    _finished(sinks.run(topic, plan, path, checkpoint), batches)


@query("s07_replay_from_earliest")
def s07(spark, sf_dir):
    path = work_dir(spark, "replay-out")
    _health_run(spark, sf_dir, "status", _cut(spark, _events(spark, sf_dir), 4), path, work_dir(spark, "replay-checkpoint"), 4)
    return sinks.messages_table(spark, path).select(
        "topic", "key", "sourceOffset", _json("severity", "severity"), _json("healthScore", "healthScore"),
    )


@query("s07_replay_again")
def s07_again(spark, sf_dir):
    """Read in four batches; then the older half is gone from the source, and a replay reads the rest in two over the same table."""
    events, path = _events(spark, sf_dir), work_dir(spark, "again-out")
    _health_run(spark, sf_dir, "status", _cut(spark, events, 4), path, work_dir(spark, "again-checkpoint"), 4)
    middle = events.agg(F.expr("min(event_id) + (max(event_id) - min(event_id) + 1) div 2")).first()[0]
    newer = _cut(spark, events.filter(F.col("event_id") >= middle), 2)
    _health_run(spark, sf_dir, "status", newer, path, work_dir(spark, "again-checkpoint"), 2)
    return sinks.messages_table(spark, path).groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("sourceOffset").alias("records"),
        F.sum("sourceOffset").alias("offset_sum"), F.countDistinct("run").alias("runs"))


@query("s07_replay_over_gaps")
def s07_gaps(spark, sf_dir):
    """Only every third offset holds a record, and two of twelve batches read nothing of one partition; then the newer half is read again.

    Each run keeps one range for each partition, whatever its batches.
    """
    path, count = work_dir(spark, "gaps-out"), 12
    events = _events(spark, sf_dir).withColumn("place", F.col("event_id") * 3 + F.col("event_id") % 2)
    low, high = events.agg(F.min("place"), F.max("place")).first()
    step = -(-(high - low + 1) // count)

    def read(run: str, batches: range) -> None:
        for i, b in enumerate(batches):
            rows = ev.telemetry_topic(events.filter(F.col("place").between(low + b * step, low + (b + 1) * step - 1)), "status")
            # Odd events are in the second partition, which has a pause.
            rows = rows.withColumns({"partition": (F.col("offset") % 2).cast("int"), "offset": F.col("offset") * 3 + F.col("offset") % 2})
            if b in (4, 5):
                rows = rows.filter("partition = 0")
            sinks.write_messages(health.status_messages(rows), path, i, run=run, source=rows)
    read("first", range(count))
    read("again", range(count // 2, count))
    done = sinks.commits(spark, path)
    ranges = sinks.islands(done).groupBy("run").agg(F.count(F.lit(1)).alias("ranges"))
    table = sinks.messages_table(spark, path).groupBy("run", "topic", "sourcePartition").agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("sourceOffset").alias("records"), F.sum("sourceOffset").alias("offset_sum"))
    return table.join(ranges, "run")


@query("s08_exactly_once")
def s08(spark, sf_dir):
    """Four batches on one checkpoint; the query dies after the second one's write, before its commit, and is started again."""
    path, checkpoint, written = work_dir(spark, "once-out"), work_dir(spark, "once-checkpoint"), []
    topic = ev.telemetry_topic(_stream_of(spark, _cut(spark, _events(spark, sf_dir), 4), 4), "stream")

    def dying(batch: DataFrame, batch_id: int) -> None:
        sinks.write_messages(health.stream_messages(batch), path, batch_id, run=sinks.run_of(batch), source=batch)
        written.append(batch_id)
        if written == [0, 1]:
            raise RuntimeError("lost")

    for _ in range(2):
        run = topic.writeStream.foreachBatch(dying).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        try:
            run.awaitTermination()
        except StreamingQueryException as error:
            if written != [0, 1]:
                raise RuntimeError("not the loss that was meant") from error
    if written != [0, 1, 1, 2, 3]:
        raise RuntimeError(f"batches ran as {written}")
    table = sinks.messages_table(spark, path)
    return table.groupBy("topic", _json("healthScore", "healthScore")).agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("sourceOffset").alias("records"),
    )


@query("s08_copies_on_a_stream")
def s08_stream(spark, sf_dir):
    """Twelve batches of half an hour; each third message is sent again in the batch after its own. State is kept for an hour and a half."""
    sent = health.stream_messages(_topic(spark, sf_dir, "stream"))
    low, high = _events(spark, sf_dir).agg(F.min("event_id"), F.max("event_id")).first()
    into = (F.col("sourceOffset") - low) / (high - low + 1)
    sent = sent.withColumns({"timestamp": F.timestamp_seconds(1_704_067_200 + into * 6 * 3600), "piece": F.floor(into * 12)})
    again = sent.filter("sourceOffset % 3 = 0").withColumn("piece", F.least(F.col("piece") + 1, F.lit(11)))
    cut = _cut(spark, sent.unionByName(again), 12, by="piece")
    path = work_dir(spark, "once-stream")
    query = sinks.once(_stream_of(spark, cut, 12), within="90 minutes").writeStream.format("parquet").option(
        "checkpointLocation", work_dir(spark, "once-checkpoint")).trigger(availableNow=True).start(path)
    _finished(query, 12)
    table = spark.read.parquet(path)
    held = max(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"])
    return table.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("sourceOffset").alias("records"), F.sum("sourceOffset").alias("offset_sum")).withColumn(
        "bounded", F.lit(held < 0.7 * table.count()))


@query("s08_kafka_copies")
def s08_kafka(spark, sf_dir):
    """Rows as a Kafka topic holds them, a third of them twice; the place in the headers tells the copies."""
    sent = health.stream_messages(_topic(spark, sf_dir, "stream"))
    copies = sent.withColumn("times", F.expr("CASE WHEN sourceOffset % 3 = 0 THEN 2 ELSE 1 END"))
    rows = copies.select("*", F.explode(F.expr("sequence(1, times)")).alias("attempt")).select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), "topic", F.lit(0).alias("partition"),
        (F.col("sourceOffset") * 2 + F.col("attempt")).alias("offset"), F.col("recordTimestamp").alias("timestamp"),
        F.array(F.struct(F.lit("trace").alias("key"), F.lit("x").cast("binary").alias("value")), *sinks.source_headers()).alias("headers"))
    path = work_dir(spark, "kafka-rows")
    rows.write.parquet(path)
    return sinks.once(with_source_place(spark.read.parquet(path))).groupBy("topic", "sourceTopic", "sourcePartition").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("sourceOffset").alias("offset_sum"))


def _status_log(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """The status profile's log as typed rows, in the order they were written."""
    rows = rules_status.score(ev.telemetry(_events(spark, sf_dir) if events is None else events))
    return rows.select(
        "topic", "partition", "offset", "equipmentId", "eventId", "correlationId", "timestamp",
        "severity", "healthScore",
    )


def _with_tombstones(log: DataFrame) -> DataFrame:
    """Every tenth record is a tombstone: it deletes its key until the next record."""
    return log.withColumn("severity", F.when(F.col("offset") % 10 != 0, F.col("severity")))


@query("s09_latest_status")
def s09(spark, sf_dir):
    log = _with_tombstones(_status_log(spark, sf_dir))
    return tables.latest_by_key(log, "equipmentId", tombstone="severity").select(
        "equipmentId", "offset", "severity", "healthScore",
    )


@query("s09_latest_status_stream")
def s09_stream(spark, sf_dir):
    table = sinks.LatestStatus(_with_tombstones, work_dir(spark, "latest"))
    source = _status_log(spark, sf_dir, _stream_of(spark, _cut(spark, _events(spark, sf_dir), 5), 5))
    _finished(sinks.run_latest(source, table, work_dir(spark, "latest-checkpoint")), 5)
    return table.snapshot(spark).select("equipmentId", "offset", "severity", "healthScore")


@query("s09_latest_status_state")
def s09_state(spark, sf_dir):
    """The latest status as keyed state: three batches, a restart, two more; the table is read from the state."""
    events, checkpoint = _events(spark, sf_dir), work_dir(spark, "state-checkpoint")
    path = _cut(spark, events, 5, only=range(3))
    for pieces, new in ((3, 3), (5, 2)):
        if pieces == 5:
            _cut(spark, events, 5, path=path, only=range(3, 5))
        _finished(state.run_latest_state(_with_tombstones(_status_log(spark, sf_dir, _stream_of(spark, path, pieces))), checkpoint), new)
    return state.latest_state(spark, checkpoint).select("equipmentId", "offset", "severity", "healthScore")


@query("s09_latest_status_buckets")
def s09_buckets(spark, sf_dir):
    """The latest status in key buckets over five batches, cleaned of older versions."""
    table = BucketedLatest(_with_tombstones, work_dir(spark, "buckets"), buckets=16)
    source = _status_log(spark, sf_dir, _stream_of(spark, _cut(spark, _events(spark, sf_dir), 5), 5))
    _finished(sinks.run_latest(source, table, work_dir(spark, "buckets-checkpoint")), 5)
    table.clean(spark)
    return table.snapshot(spark, source.schema).select("equipmentId", "offset", "severity", "healthScore")


@query("s10_retention")
def s10(spark, sf_dir):
    topics = TopicConfig()
    raw = tables.within_retention(
        _topic(spark, sf_dir, "status"), "timestamp", topics.raw_retention_days, F.lit(RAW_AS_OF).cast("timestamp"),
    ).select(F.lit("raw").alias("topic"), "offset")
    alerts = tables.within_retention(
        route.critical_only(rules_status.score(_telemetry(spark, sf_dir))), "timestamp",
        topics.alert_retention_days, F.lit(AS_OF).cast("timestamp"),
    ).select(F.lit("alert").alias("topic"), "offset")
    return raw.unionByName(alerts)


@query("s10_expired_days_dropped")
def s10_dropped(spark, sf_dir):
    """The days of the status topic that are beyond its retention are deleted; alerts stay."""
    path = work_dir(spark, "expired")
    topic = _topic(spark, sf_dir, "status")
    sinks.backfill(health.status_messages(topic), topic, path)
    sinks.drop_expired(spark, path, TopicConfig().status, TopicConfig().raw_retention_days, F.lit(RAW_AS_OF))
    left = sinks.messages_table(spark, path).groupBy("topic", "day").agg(F.count(F.lit(1)).alias("messages"))
    return left.select("topic", F.col("day").cast("string").alias("day"), "messages")


@query("s10_compacted")
def s10_compacted(spark, sf_dir):
    """Four batches and a partial replay, compacted; what they had written is deleted afterwards."""
    events, path = _events(spark, sf_dir), work_dir(spark, "compact")
    _health_run(spark, sf_dir, "status", _cut(spark, events, 4), path, work_dir(spark, "compact-checkpoint"), 4)
    newer = _cut(spark, events.filter(F.col("event_id") >= 100), 2)
    _health_run(spark, sf_dir, "status", newer, path, work_dir(spark, "compact-checkpoint"), 2)
    sinks.compact(spark, path)
    sinks.drop_hidden(spark, path)
    table = sinks.messages_table(spark, path)
    return table.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("sourceOffset").alias("offset_sum"), F.countDistinct("run").alias("runs"))


@query("s11_key_partitions")
def s11(spark, sf_dir):
    """A table laid out by key partition and read back: each key in one of them, each of them written in several pieces."""
    topics, path = TopicConfig(), work_dir(spark, "key-partitions")
    topic = _topic(spark, sf_dir, "status")
    # Pieces of an eighth of a partition's rows, so that every partition has several, and about as many at any size.
    rows = -(-_events(spark, sf_dir).count() // (8 * topics.status_profile_partitions))
    sinks.write_messages(
        health.status_messages(topic), path, 0, source=topic, key_partitions=topics.status_profile_partitions, rows_per_piece=rows)
    table = sinks.messages_table(spark, path).filter(F.col("topic") == topics.status)
    files = spark.read.schema(sinks.MESSAGES).parquet(f"{path}/messages").filter(F.col("topic") == topics.status)
    per_partition = files.groupBy("keyPartition").agg((F.countDistinct("_metadata.file_path") > 1).alias("several"))
    return table.join(per_partition, "keyPartition").groupBy("key").agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct("keyPartition").alias("partitions"),
        F.max((F.col("keyPartition") >= topics.status_profile_partitions).cast("int")).alias("out_of_range"),
        F.min("several").alias("several_pieces"),
    )


# -- validation, enrichment, dead letters --------------------------------------------------------

def _first_error() -> Column:
    return F.coalesce(F.get("errors", F.lit(0)), F.lit("")).alias("error")


@query("v01_empty_body")
def v01(spark, sf_dir):
    return _validated(spark, sf_dir).select(
        "offset", (_first_error() == validate.EMPTY_BODY).alias("empty_body"),
    )


@query("v02_malformed_json")
def v02(spark, sf_dir):
    return _validated(spark, sf_dir).select(
        "offset", (_first_error() == validate.INVALID_JSON).alias("malformed"),
    )


@query("v02_repeated_members")
def v02_repeated(spark, sf_dir):
    """Members that repeat inside the payload: the last one counts, and the body is not malformed."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")  # as in session.RECOMMENDED
    again = F.when(F.col("offset") % 3 != 0, F.regexp_replace("value", F.lit('"payload":\\{'), F.concat(
        F.lit('"payload":{"k":"first-'), F.col("offset"), F.lit('",')))).otherwise(F.col("value"))
    bodies = ev.clean_documents(_events(spark, sf_dir)).withColumn("value", again)
    return validate.validate(bodies).select("offset", "valid", F.col("record.payload")["k"].alias("k"))


@query("v03_reported_version")
def v03(spark, sf_dir):
    n = F.col("offset")
    version = (
        F.when(n % 5 == 0, F.concat(F.lit('"1.'), n % 7, F.lit('.0"')))
        .when(n % 5 == 1, F.lit("2"))
        .when(n % 5 == 2, F.lit("null"))
        .when(n % 5 == 3, F.lit('{"major":1}'))
        .otherwise(F.lit('"1.0.0"'))
    )
    bodies = _bodies(spark, sf_dir).withColumn("value", F.regexp_replace(
        "value", F.lit('"schemaVersion":"1.0.0"'), F.concat(F.lit('"schemaVersion":'), version),
    ))
    return validate.validate(bodies).select("offset", "reportedVersion")


@query("v04_contract_conformance")
def v04(spark, sf_dir):
    """Every field of the contract missing, null or of a wrong type, one fault per body."""
    n = F.col("offset")
    wrong = {"string": "7", "long": '"7"', "map<string>": '{"a":1}', "optional string": "7"}
    faulty = F.col("value")
    for i, (name, kind) in enumerate(RAW_CONTRACT.fields):
        pattern = rf'"{name}":("[^"]*"|\{{[^}}]*\}}|[^,}}]*)'
        for case, member in enumerate(('"other":0', f'"{name}":null', f'"{name}":{wrong[kind]}')):
            here = (n % 8 == i) & (F.floor(n / 8) % 4 == case)
            faulty = F.when(here, F.regexp_replace("value", pattern, member)).otherwise(faulty)
    bodies = ev.clean_documents(_events(spark, sf_dir)).withColumn("value", faulty)
    return validate.validate(bodies).select("offset", "valid", _first_error())


@query("v04_nested_contracts")
def v04_nested(spark, sf_dir):
    """Bodies of all five contracts, one fault at one node of each: the node missing, of a wrong type, or none."""
    out, kinds = None, len(contracts.BUNDLED)
    for i, (name, text) in enumerate(contracts.BUNDLED.items()):
        tree = contracts.read_contract(text)
        texts = faulty_bodies.bodies(tree)
        table = spark.createDataFrame(list(enumerate(texts)), "variant long, body string")
        mine = _events(spark, sf_dir).filter(F.col("event_id") % kinds == i).withColumn("variant", F.expr(f"event_id div {kinds}") % len(texts))
        rows = conform.conformance(envelope(
            mine.join(table, "variant"), F.replace("body", F.lit("@ID"), F.expr(ev.EQUIPMENT_ID)),
            key=F.lit("k"), topic=name, offset=F.col("event_id"), timestamp=F.col("ts")), tree)
        rows = rows.select("offset", F.lit(name).alias("contract"), "valid", F.coalesce("error", F.lit("")).alias("error"),
                           F.coalesce("record.equipmentId", F.lit("")).alias("equipmentId"), F.coalesce("record.timestamp", F.lit(-1)).alias("millis"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("v05_required_semantics")
def v05(spark, sf_dir):
    """All messages, in order, for up to three blank texts per body."""
    n = F.col("offset")
    text = F.col("value")
    for i, name in enumerate(validate.REQUIRED_TEXT):
        blank = F.regexp_replace(text, F.lit(f'"{name}":"[^"]*"'), F.lit(f'"{name}":" \\\\t"'))
        text = F.when(F.floor(n / (2 ** i)) % 2 == 1, blank).otherwise(text)
    bodies = ev.clean_documents(_events(spark, sf_dir)).withColumn("value", text)
    return validate.validate(bodies).select("offset", F.array_join("errors", "; ").alias("errors"))


@query("v06_error_list")
def v06(spark, sf_dir):
    return _validated(spark, sf_dir).select(
        "offset", F.size("errors").alias("error_count"), F.array_join("errors", "; ").alias("reason"),
    )


@query("v07_validation_result")
def v07(spark, sf_dir):
    return _validated(spark, sf_dir).select(
        "offset", "valid", F.size("errors").alias("error_count"), "schemaName", "reportedVersion",
    )


@query("v08_split")
def v08(spark, sf_dir):
    return ingest.outcomes(_bodies(spark, sf_dir)).select("route", "offset")


@query("v09_claimed_correlation_id")
def v09(spark, sf_dir):
    return _bodies(spark, sf_dir).selectExpr("offset", f"{validate.claimed_correlation_id()} AS correlationId")


@query("v10_enriched_event")
def v10(spark, sf_dir):
    return enrich.enrich(_validated(spark, sf_dir), as_of=F.lit(AS_OF).cast("timestamp")).select(
        "offset", "equipmentId", F.col("timestamp").alias("millis"), "correlationId", "schemaVersion",
        "sourceSystem", _text("metricName"), _text("unit"),
        F.col("payload")["temperature"].alias("payload_temperature"), F.col("payload")["k"].alias("payload_k"),
        F.col("ingestionMetadata.ingestionService").alias("service"),
        F.col("ingestionMetadata.ingestionId").alias("ingestionId"),
        F.col("ingestionMetadata.validated").alias("validated"),
    )


@query("v11_optional_text")
def v11(spark, sf_dir):
    n = F.col("offset")
    union = F.concat(
        F.lit('"metricName":{"string":"'), F.when(n % 3 == 0, F.lit("null")).otherwise(F.concat(F.lit("m"), n % 3)),
        F.lit('"}'),
    )
    bodies = _bodies(spark, sf_dir).withColumn(
        "value", F.regexp_replace("value", F.lit('"metricName":null'), union))
    return enrich.enrich(validate.validate(bodies)).select("offset", _text("metricName"), _text("unit"))


@query("v12_source_system_default")
def v12(spark, sf_dir):
    n = F.col("offset")
    plain = F.regexp_replace("value", F.lit('"sourceSystem":"([^"]*)"'), F.when(
        n % 2 == 0, F.lit('"sourceSystem":null')).otherwise(F.lit('"sourceSystem":{"string":"$1"}')))
    bodies = _bodies(spark, sf_dir).withColumn("value", plain)
    return enrich.enrich(validate.validate(bodies, contract=OPTIONAL_SOURCE)).select("offset", "sourceSystem")


@query("v13_dead_letter")
def v13(spark, sf_dir):
    return enrich.dead_letters(_validated(spark, sf_dir)).select(
        "offset", "equipmentId", "correlationId", "schemaVersion", "payload.*",
        F.col("errorMetadata.source").alias("source"), F.array_join("errorMetadata.errors", "; ").alias("errors"),
    )


@query("v14_claimed_equipment_id")
def v14(spark, sf_dir):
    rejected = _validated(spark, sf_dir).filter("NOT valid")
    return rejected.select("offset", F.col("claimedEquipmentId").alias("equipmentId"))


@query("v15_acknowledgements")
def v15(spark, sf_dir):
    return enrich.acknowledgements(_validated(spark, sf_dir)).select(
        "offset", *[F.coalesce(F.col(f"ack.{n}"), F.lit("")).alias(n)
                    for n in ("status", "correlationId", "topic", "schemaName", "schemaVersion")],
        F.array_join("ack.errors", "; ").alias("errors"),
    )


def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything one run of the ingestion stream has written, over four micro-batches."""
    path = work_dir(spark, "ingested")
    bodies = ev.ingestion_documents(_stream_of(spark, _cut(spark, _events(spark, sf_dir), 4), 4))
    _finished(sinks.run(bodies, ingest.messages, path, work_dir(spark, "ingested-checkpoint")), 4)
    return sinks.messages_table(spark, path)


@query("v15_acknowledgements_sink")
def v15_sink(spark, sf_dir):
    acks = _ingested(spark, sf_dir).filter(F.col("topic") == TopicConfig().acknowledgement)
    return acks.select(
        "sourceOffset", "key", *[_json(n, n) for n in ("status", "correlationId", "topic", "schemaName", "schemaVersion")],
        F.array_join(F.from_json(F.get_json_object("value", "$.errors"), "array<string>"), "; ").alias("errors"),
    ).withColumnRenamed("topic", "target")


def _registry(spark: SparkSession, schemas: list[tuple[str, int, str]]) -> DataFrame:
    return spark.createDataFrame(schemas, "subject string, version int, schema string")


def _avro(name: str, **changes: str | None) -> str:
    """The raw contract as Avro JSON, with other types for some fields or (None) without them."""
    types = {"string": '"string"', "long": '"long"', "map<string>": '{"type":"map","values":"string"}', "optional string": '["null","string"]'}
    fields = {n: types[k] for n, k in RAW_CONTRACT.fields}
    fields |= {n: types.get(k, k) for n, k in changes.items() if k}
    listed = ",".join(f'{{"name":"{n}","type":{t}}}' for n, t in fields.items() if changes.get(n, t) is not None)
    return f'{{"type":"record","name":"{name}","fields":[{listed}]}}'


@query("v16_contract_of_the_registry")
def v16_registry(spark, sf_dir):
    """Three ways the contract is found: the newest of the registry (which knows neither metric nor unit), and
    twice the bundled one, for a registry that is not there and one whose newest entry cannot be read."""
    subject = IngestConfig().raw_subject
    newest = _registry(spark, [(subject, 1, _avro("Old", equipmentId="long")), (subject, 2, _avro("Raw2", unit=None, metricName=None)),
                               ("other", 9, _avro("Other", payload="string"))])
    broken = _registry(spark, [(subject, 1, _avro("Old")), (subject, 2, _avro("New", equipmentId='"number"'))])
    missing = work_dir(spark, "no-registry") + "/none"
    out = None
    for name, registry in (("newest", lambda: newest), ("missing", lambda: spark.read.parquet(missing)), ("broken", lambda: broken)):
        sent = ingest.under_registry(registry)(_bodies(spark, sf_dir)).filter(F.col("topic") == TopicConfig().acknowledgement)
        rows = sent.select(F.lit(name).alias("registry"), "sourceOffset", _json("status", "status"), _json("schemaName", "schemaName"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("v16_fallback_is_audited")
def v16_audited(spark, sf_dir):
    """The newest entry cannot be read: bodies go by the bundled contract, and an audit message says so."""
    subject = IngestConfig().raw_subject
    broken = _registry(spark, [(subject, 3, _avro("Old")), (subject, 4, _avro("New", equipmentId='"number"'))])
    sent = ingest.under_registry(lambda: broken)(_bodies(spark, sf_dir)).filter(F.col("topic") == TopicConfig().audit)
    payload = [_json(f"payload.{n}", n) for n in ("action", "outcome", "resource")]
    return sent.select(*payload, _json("payload.details.problem", "problem"), _json("payload.details.version", "version")).groupBy(
        "action", "outcome", "resource", "problem", "version").agg(F.count(F.lit(1)).alias("messages"))


@query("v16_unreadable_is_reported")
def v16_unreadable(spark, sf_dir):
    """A registry with a version per event: five kinds of entries that cannot be read, and nested ones that can."""
    field = lambda kind: F.concat(F.lit('{"type":"record","name":"V'), F.col("event_id"), F.lit(f'","fields":[{{"name":"a","type":{kind}}}]}}'))
    entries = (
        field('"double"'), field('["null",{"type":"array","items":{"type":"enum","name":"E","symbols":["X"]}}]'), field('"number"'),
        field('["null","string","string"]'), F.lit("not json"), F.concat(F.lit('{"type":"record","name":"V'), F.col("event_id"), F.lit('"}')),
        F.lit('{"type":"record","name":"Loop","fields":[{"name":"next","type":["null","Loop"]}]}'))
    schema = F.element_at(F.array(*entries), (F.col("event_id") % len(entries) + 1).cast("int"))
    registry = _events(spark, sf_dir).select(
        F.concat(F.lit("telemetry."), F.col("event_type")).alias("subject"), F.col("event_id").alias("version"), schema.alias("schema"))
    return validate.registry_report(registry).select("subject", "version", "readable", F.coalesce("problem", F.lit("")).alias("problem"))


@query("v16_latest_contract")
def v16(spark, sf_dir):
    """A registry with one version per event: the newest of each subject."""
    registry = _events(spark, sf_dir).select(
        F.concat(F.lit("telemetry."), F.col("event_type")).alias("subject"),
        F.col("event_id").alias("version"),
        F.concat(F.lit('{"type":"record","name":"V'), F.col("event_id"), F.lit('","fields":[]}')).alias("schema"),
    )
    return validate.latest_versions(registry)


# -- parse, project, re-key, serialise -----------------------------------------------------------

@query("p01_parse_status")
def p01(spark, sf_dir):
    rows = parse.parse_status(ev.faulty_topic(_events(spark, sf_dir), "status")).filter("parsed")
    return rows.select(
        "offset", _text("equipmentId"), _text("correlationId"), _text("equipmentType"), _millis("timestamp"),
        "temperature", "pressure", _codes(), _text("schemaVersion"),
    )


@query("p02_parse_stream")
def p02(spark, sf_dir):
    rows = parse.parse_stream(ev.faulty_topic(_events(spark, sf_dir), "stream")).filter("parsed")
    return rows.select("offset", _text("equipmentId"), _text("correlationId"), "temperature", "pressure")


@query("p03_stream_defaults")
def p03(spark, sf_dir):
    rows = parse.usable(parse.parse_stream(ev.faulty_topic(_events(spark, sf_dir), "stream")))
    return rows.select("offset", "eventId", _millis("timestamp"), _codes(), "schemaVersion")


@query("p04_status_defaults")
def p04(spark, sf_dir):
    rows = parse.with_defaults(parse.usable(parse.parse_status(ev.faulty_topic(_events(spark, sf_dir), "status"))))
    return rows.select("offset", _codes(), F.to_json("metadata").alias("metadata"), "schemaVersion")


@query("p05_drop_unusable")
def p05(spark, sf_dir):
    events = _events(spark, sf_dir)
    keep = lambda rows, profile: parse.usable(rows).select(F.lit(profile).alias("profile"), "offset")
    return (
        keep(parse.parse_status(ev.faulty_topic(events, "status")), "status")
        .unionByName(keep(parse.parse_status(ev.faulty_topic(events, "status"), strict=False), "status lenient"))
        .unionByName(keep(parse.parse_stream(ev.faulty_topic(events, "stream")), "stream"))
    )


@query("p06_rekey_by_equipment")
def p06(spark, sf_dir):
    return parse.rekey(_telemetry(spark, sf_dir)).select("key", "offset")


@query("p07_serialise")
def p07(spark, sf_dir):
    a = health.status_health(_topic(spark, sf_dir, "status")).select(
        F.lit("status").alias("profile"), "offset", route.to_text(route.STATUS_HEALTH).alias("value"))
    b = health.stream_health(_topic(spark, sf_dir, "stream")).select(
        F.lit("stream").alias("profile"), "offset", route.to_text(route.STREAM_HEALTH).alias("value"))
    return a.unionByName(b).select(
        "profile", "offset", _json("equipmentId", "equipmentId"), _json("correlationId", "correlationId"),
        _json("healthScore", "healthScore"), _json("isCritical", "isCritical"), _json("severity", "severity"),
        _json("schemaVersion", "schemaVersion"),
    )


@query("p08_measurement_bridge")
def p08(spark, sf_dir):
    """Ingested events end to end: validate, enrich, bridge, then both rule profiles."""
    config = BridgeConfig(pressure_key="k", pressure_factor=0.02)
    telemetry = parse.bridge(enrich.enrich(_validated(spark, sf_dir)), config)
    status = rules_status.score(telemetry).withColumnRenamed("severity", "status_severity").withColumnRenamed(
        "healthScore", "status_score").drop("temperatureScore", "pressureScore", "errorCodeScore", "isCritical")
    return rules_stream.score(status).select(
        "offset", "equipmentId", _millis("timestamp"), "temperature", "pressure",
        "status_score", "status_severity", F.col("healthScore").alias("stream_score"),
        F.col("severity").alias("stream_severity"),
    )


@query("p08_code_separators")
def p08_separators(spark, sf_dir):
    """Code lists with separators that mean something in a pattern, and white space around the codes."""
    rows = enrich.enrich(_validated(spark, sf_dir))
    out = None
    for name, sep in (("comma", ","), ("bar", "|"), ("blank", " "), ("dots", "..")):
        listed = F.concat(F.lit(" X9"), F.lit(sep), F.lit("\tW00") if sep != " " else F.lit("W00"), (F.col("offset") % 3 + 1).cast("string"))
        listed = listed if sep != " " else F.ltrim(listed)
        telemetry = parse.bridge(rows.withColumn("payload", F.map_concat(
            F.map_filter("payload", lambda k, v: k != "errorCodes"), F.create_map(F.lit("errorCodes"), listed))), BridgeConfig(codes_separator=sep))
        part = rules_status.score(telemetry).select(F.lit(name).alias("separator"), "offset", _codes(), "errorCodeScore")
        out = part if out is None else out.unionByName(part)
    return out


@query("p09_intake_counts")
def p09_intake(spark, sf_dir):
    """What both plans take in and drop, counted while they run."""
    rows = []
    for profile, plan in (("status", health.status_messages), ("stream", health.stream_messages)):
        seen = Observation(f"{profile}_intake")
        plan(ev.faulty_topic(_events(spark, sf_dir), profile), intake=seen).write.format("noop").mode("overwrite").save()
        rows.append((profile, *[seen.get[n] for n in ("received", "dropped")]))
    return spark.createDataFrame(rows, "profile string, received long, dropped long")


@query("p09_stream_metrics")
def p09_stream(spark, sf_dir):
    """What both plans count in four micro-batches each, from the table the listener writes: intake of damaged records, severities of clean ones."""
    path, cut, out = work_dir(spark, "metrics"), _cut(spark, _events(spark, sf_dir), 4), None
    plans = {"status": health.status_health, "stream": health.stream_health}
    with metrics.MetricsTable(spark, path):
        for profile, plan in plans.items():
            for observation, topic in (("intake", ev.faulty_topic), ("routing", ev.telemetry_topic)):
                name = f"{profile}_{observation}"
                rows = topic(_stream_of(spark, cut, 4), profile)
                counted = plan(rows, intake=name) if observation == "intake" else route.observed(plan(rows), name)
                _finished(counted.writeStream.format("noop").option("checkpointLocation", work_dir(spark, "metrics-checkpoint")).trigger(
                    availableNow=True).start(), 4)
    table = metrics.metrics_table(spark, path).withColumn("profile", F.split("observation", "_")[0])
    total = lambda observation, metric: F.sum(F.when(
        (F.split("observation", "_")[1] == observation) & (F.col("metric") == metric), F.col("value"))).alias(metric)
    return table.groupBy("profile").agg(
        F.countDistinct("batch").alias("batches"), total("intake", "received"), total("intake", "dropped"),
        *[total("routing", m) for m in ("critical", "warning", "healthy")])


@query("p09_observed_counts")
def p09(spark, sf_dir):
    rows = []
    for profile, rules in (("status", rules_status), ("stream", rules_stream)):
        seen = Observation(f"{profile}_routing")
        scored = route.observed(rules.score(_telemetry(spark, sf_dir)), seen)
        scored.write.format("noop").mode("overwrite").save()
        counts = seen.get
        rows.append((profile, *[counts[n] for n in ("received", "critical", "warning", "healthy")]))
    return spark.createDataFrame(rows, "profile string, received long, critical long, warning long, healthy long")


# -- health rules, status profile ------------------------------------------------------------------

def _status(spark: SparkSession, sf_dir: str, config: HealthConfig = STATUS_PROFILE) -> DataFrame:
    return rules_status.score(_telemetry(spark, sf_dir), config)


@query("h01_temperature_score")
def h01(spark, sf_dir):
    return _telemetry(spark, sf_dir).select(
        "offset", F.expr(rules_status.temperature_score()).alias("temperatureScore"))


@query("h02_pressure_score")
def h02(spark, sf_dir):
    return _telemetry(spark, sf_dir).select(
        "offset", F.expr(rules_status.pressure_score()).alias("pressureScore"))


@query("h03_error_score")
def h03(spark, sf_dir):
    return _telemetry(spark, sf_dir).select(
        "offset", F.expr(rules_status.error_score()).alias("errorCodeScore"))


@query("h04_health_score")
def h04(spark, sf_dir):
    return _status(spark, sf_dir).select("offset", "healthScore")


@query("h05_criticality")
def h05(spark, sf_dir):
    return _status(spark, sf_dir).select("offset", "isCritical")


@query("h06_severity")
def h06(spark, sf_dir):
    return _status(spark, sf_dir).groupBy("severity").agg(
        F.count(F.lit(1)).alias("records"), F.sum("healthScore").alias("health"),
        F.sum("temperatureScore").alias("temperature"), F.sum("pressureScore").alias("pressure"),
        F.sum("errorCodeScore").alias("code"),
    )


@query("h07_violations")
def h07(spark, sf_dir):
    return _status(spark, sf_dir).select(
        "offset", F.size("violations").alias("violation_count"), F.array_join("violations", " | ").alias("violations"))


@query("h08_breakdown")
def h08(spark, sf_dir):
    return rules_status.evaluate(_telemetry(spark, sf_dir)).select(
        "offset", "breakdown.temperatureScore", "breakdown.pressureScore", "breakdown.errorCodeScore",
        F.size("breakdown.violations").alias("violation_count"))


@query("h09_health_record")
def h09(spark, sf_dir):
    return rules_status.evaluate(_telemetry(spark, sf_dir)).select(
        "offset", "correlationId", "equipmentId", "equipmentType", _millis("telemetryTimestamp"),
        "healthScore", "isCritical", "severity", "schemaVersion")


@query("h10_other_configuration")
def h10(spark, sf_dir):
    return _status(spark, sf_dir, OTHER_STATUS).select(
        "offset", "temperatureScore", "pressureScore", "errorCodeScore", "healthScore", "isCritical", "severity")


# -- health rules, stream profile ------------------------------------------------------------------

def _stream(spark: SparkSession, sf_dir: str, config: HealthConfig = STREAM_PROFILE) -> DataFrame:
    return rules_stream.score(_telemetry(spark, sf_dir), config)


@query("r01_temperature")
def r01(spark, sf_dir):
    return _stream(spark, sf_dir).select("offset", "temperatureStatus", "temperatureScore")


@query("r02_pressure")
def r02(spark, sf_dir):
    return _stream(spark, sf_dir).select("offset", "pressureStatus", "pressureScore")


@query("r03_error_codes")
def r03(spark, sf_dir):
    return _stream(spark, sf_dir).select("offset", "errorStatus", "errorCodeScore")


@query("r04_matched_codes")
def r04(spark, sf_dir):
    return _telemetry(spark, sf_dir).select(
        "offset", F.array_join(F.expr(rules_stream.matched_codes()), ",").alias("matched"))


@query("r05_health_score")
def r05(spark, sf_dir):
    return _stream(spark, sf_dir).select("offset", "healthScore")


@query("r06_severity")
def r06(spark, sf_dir):
    return _stream(spark, sf_dir).groupBy("severity").agg(
        F.count(F.lit(1)).alias("records"), F.sum("healthScore").alias("health"),
        F.sum("temperatureScore").alias("temperature"), F.sum("pressureScore").alias("pressure"),
        F.sum("errorCodeScore").alias("code"),
    )


@query("r07_health_record")
def r07(spark, sf_dir):
    return rules_stream.evaluate(_telemetry(spark, sf_dir)).select(
        "offset", "eventId", "equipmentId", "correlationId", "healthScore", "isCritical", "severity",
        "temperatureStatus", "pressureStatus", "errorStatus", "sourceEventId", "schemaVersion")


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluated = rules_stream.evaluate(_telemetry(spark, sf_dir))
    return rules_stream.alerts(route.branched(evaluated).filter("branch = 'critical'"))


@query("r08_alert_type")
def r08(spark, sf_dir):
    return _alerts(spark, sf_dir).select("offset", "alertType")


@query("r09_alert_message")
def r09(spark, sf_dir):
    return _alerts(spark, sf_dir).select("offset", "message")


@query("r10_alert_record")
def r10(spark, sf_dir):
    return _alerts(spark, sf_dir).select(
        "offset", "alertId", "equipmentId", "correlationId", "healthScore", "temperatureValue", "pressureValue",
        _codes(), "sourceEventId", "schemaVersion")


@query("r11_other_configuration")
def r11(spark, sf_dir):
    return _stream(spark, sf_dir, OTHER_STREAM).select(
        "offset", "temperatureStatus", "pressureStatus", "errorStatus", "temperatureScore", "pressureScore",
        "errorCodeScore", "healthScore", "severity")


# -- filters and routing -----------------------------------------------------------------------------

@query("t01_all_to_status")
def t01(spark, sf_dir):
    messages = health.status_messages(_topic(spark, sf_dir, "status")).unionByName(
        health.stream_messages(_topic(spark, sf_dir, "stream")))
    return messages.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("sourceOffset").alias("offset_sum"))


@query("t02_critical_filter")
def t02(spark, sf_dir):
    return route.critical_only(_status(spark, sf_dir)).select("offset", "healthScore")


@query("t03_severity_branches")
def t03(spark, sf_dir):
    return route.branched(_stream(spark, sf_dir)).select("branch", "offset")


@query("t04_critical_to_alerts")
def t04(spark, sf_dir):
    messages = health.stream_messages(_topic(spark, sf_dir, "stream"))
    return messages.filter(F.col("topic") == TopicConfig().stream_profile_alert).select(
        "key", "sourceOffset", _json("alertType", "alertType"), _json("message", "message"),
        _json("sourceEventId", "sourceEventId"))


# -- work the contracts declare ------------------------------------------------------------------------

@query("c01_status_changes")
def c01(spark, sf_dir):
    found = changes.status_changes(_status_log(spark, sf_dir))
    return changes.status_event(found).select(
        "equipmentId", F.col("timestamp").alias("millis"), "payload.status",
        F.coalesce("payload.previousStatus", F.lit("")).alias("previousStatus"), "correlationId", "sourceEventId")


@query("c01_status_changes_log_order")
def c01_log(spark, sf_dir):
    # Small chunks, so that hand-overs between chunks happen at every scale.
    found = changes.status_changes(_status_log(spark, sf_dir), order=changes.LOG, chunk_rows=1000)
    return found.select(
        "equipmentId", "offset", "severity", F.coalesce("previousStatus", F.lit("")).alias("previousStatus"))


@query("c01_status_changes_stream")
def c01_stream(spark, sf_dir):
    table = sinks.LatestStatus(lambda batch: batch, work_dir(spark, "changes"), chunk_rows=1000)
    source = _status_log(spark, sf_dir, _stream_of(spark, _cut(spark, _events(spark, sf_dir), 5), 5))
    _finished(sinks.run_latest(source, table, work_dir(spark, "changes-checkpoint")), 5)
    return table.changes(spark).select(
        "equipmentId", "offset", "severity", F.coalesce("previousStatus", F.lit("")).alias("previousStatus"))


@query("c01_status_changes_out_of_order")
def c01_out_of_order(spark, sf_dir):
    """Records come up to a day out of order, in eight batches; some of the first half come at the very end and are late."""
    events = _events(spark, sf_dir)
    first, last = events.agg(F.min(F.unix_seconds("ts")), F.max(F.unix_seconds("ts"))).first()
    jitter = F.unix_seconds("ts") + F.pmod(F.xxhash64("event_id"), F.lit(86_000))
    left_behind = (F.col("event_id") % 50 == 0) & (F.unix_seconds("ts") < first + (last - first) // 2)
    cut = _cut(spark, events.withColumn("arrival", F.when(left_behind, last + 86_000).otherwise(jitter)), 8, by="arrival")
    table = eventtime.EventTimeChanges(lambda batch: batch, work_dir(spark, "event-time"), bound=dt.timedelta(days=1))
    source = _status_log(spark, sf_dir, _stream_of(spark, cut, 8))
    _finished(source.writeStream.foreachBatch(table).option("checkpointLocation", work_dir(spark, "event-time-checkpoint")).trigger(
        availableNow=True).start(), 8)
    table.close(spark)
    late = table.late(spark).select("equipmentId", "offset", "severity", F.lit("").alias("previousStatus"), F.lit(True).alias("late"))
    return table.changes(spark).select(
        "equipmentId", "offset", "severity", F.coalesce("previousStatus", F.lit("")).alias("previousStatus"), F.lit(False).alias("late")).unionByName(late)


@query("c02_audit_trail")
def c02(spark, sf_dir):
    rows = audit.ingest_audit(_validated(spark, sf_dir)).unionByName(
        audit.health_audit(_status(spark, sf_dir), "status-profile"))
    return rows.select(
        "equipmentId", "correlationId", "payload.action", "payload.actor", "payload.outcome", "payload.resource",
        F.coalesce(F.col("payload.details")["errorCount"], F.col("payload.details")["severity"]).alias("detail"))


@query("c02_audit_sink")
def c02_sink(spark, sf_dir):
    found = _ingested(spark, sf_dir).filter(F.col("topic") == TopicConfig().audit)
    return found.select(
        "sourceOffset", "key", *[_json(f"payload.{n}", n) for n in ("action", "actor", "outcome", "resource")],
        _json("correlationId", "correlationId"), _json("payload.details.errorCount", "detail"))


@query("c03_dead_letter_replay")
def c03(spark, sf_dir):
    """Letters of the strict rules, replayed with plain text allowed for nullable strings."""
    letters = enrich.dead_letters(_validated(spark, sf_dir))
    again = replay.replay(letters, IngestConfig(strict_union=False))
    return again.select(
        F.when(F.col("letter").isNull(), F.lit("accepted")).otherwise(F.lit("dead letter")).alias("route"), "offset",
        F.coalesce("letter.payload.attemptCount", "attemptCount").alias("attemptCount"))


@query("c04_contract_projections")
def c04(spark, sf_dir):
    rows = ingest.outcomes(_bodies(spark, sf_dir)).withColumns({
        "raw": F.when(F.col("event").isNotNull(), enrich.raw_contract(F.col("event"))),
        "dead": F.when(F.col("letter").isNotNull(), enrich.dead_letter_contract(F.col("letter")))})
    size = len(rows.schema["dead"].dataType["payload"].dataType.fields)
    either = lambda name: F.coalesce(F.col(f"raw.{name}"), F.col(f"dead.{name}")).alias(name)
    return rows.select(
        F.when(F.col("raw").isNotNull(), F.lit("raw")).otherwise(F.lit("dead letter")).alias("contract"),
        either("equipmentId"), either("correlationId"), either("schemaVersion"),
        F.coalesce(F.size(F.when(F.col("raw").isNotNull(), F.col("raw.payload"))), F.lit(size)).alias("members"),
        F.coalesce(F.col("raw.sourceSystem"), F.col("dead.payload.failureCode")).alias("detail"))


@query("c04_alert_contract")
def c04_alert(spark, sf_dir):
    rows = rules_stream.alert_contract(_alerts(spark, sf_dir))
    return rows.select(
        "offset", "equipmentId", "correlationId", "schemaVersion", "acknowledged", "payload.alertId", "payload.severity", "payload.title",
        F.coalesce("payload.threshold", F.lit("")).alias("threshold"), F.col("payload.attributes")["healthScore"].alias("healthScore"),
        F.col("payload.attributes")["sourceEventId"].alias("sourceEventId"))


# -- scalar functions ------------------------------------------------------------------------------------

@query("f01_f06_numbers")
def f_numbers(spark, sf_dir):
    odd = "CASE WHEN event_id % 3 = 0 THEN double('NaN') ELSE value END"
    return _events(spark, sf_dir).selectExpr(
        "event_id AS offset",
        f"{scalar.truncated('value - 50D')} AS truncated",
        f"{scalar.quotient('event_id - 500', 7)} AS quotient",
        f"NOT isnan({odd}) AND {odd} >= {scalar.double(90)} AS at_least_90",
        "CAST(greatest(0, least(100, event_id - 50)) AS INT) AS clamped",
        f"{scalar.fixed('value', 2)} AS two_decimals",
        f"{scalar.fixed('value', 1)} AS one_decimal",
    )


@query("f05_f14_texts")
def f_texts(spark, sf_dir):
    maybe_blank = r"CASE offset % 4 WHEN 0 THEN ' \t' WHEN 1 THEN '' WHEN 2 THEN key END"
    return _telemetry(spark, sf_dir).select(
        "offset",
        F.expr(scalar.contains_any("errorCodes", ("W001", "E010"))).alias("contains"),
        F.expr(scalar.count_of("errorCodes", ("W001", "X1"))).alias("occurrences"),
        F.coalesce(F.array_join(F.expr(scalar.keep_only("errorCodes", ("W001", "X1"))), "+"), F.lit("-")).alias("kept"),
        F.coalesce(F.expr(scalar.list_text("errorCodes")), F.lit("-")).alias("list_text"),
        F.expr(scalar.is_blank(maybe_blank)).alias("blank"),
        F.expr(scalar.origin_id("any")).alias("origin_id"),
        F.unix_millis("timestamp").alias("millis"),
        scalar.iso_utc(F.col("timestamp")).alias("iso"),
        F.to_json(F.create_map(F.lit("equipment"), F.col("equipmentId"))).alias("map_json"),
    )
