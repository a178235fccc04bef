"""Severity routing, serialisation, and the fan-out of one record to its topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pulsegrid.config import IngestConfig, TopicConfig
from pulsegrid.functions.scalar import iso_utc, pinned
from pulsegrid.operators import enrich, rules_stream
from pulsegrid.schemas import ORIGIN, STATUS_HEALTH, STREAM_ALERT, STREAM_HEALTH

KEEP_NULLS = {"ignoreNullFields": "false"}
INSTANTS = ("timestamp", "telemetryTimestamp", "processedAt")


def critical_only(health: DataFrame) -> DataFrame:
    """Rows of the status profile that also go to the alert topic."""
    return health.select("*", pinned(is_alert()).alias("_alert")).filter("_alert").drop("_alert")


def is_alert() -> Column:
    return F.expr("isCritical OR severity = 'CRITICAL'")


def branch() -> Column:
    """The one branch a row belongs to; the first match wins."""
    return F.expr("CASE severity WHEN 'CRITICAL' THEN 'critical' WHEN 'WARNING' THEN 'warning' ELSE 'healthy' END")


def branched(health: DataFrame) -> DataFrame:
    """Health rows with their ``branch``: three that exclude each other and leave nothing out.

    One column instead of three tables: whoever needs all branches passes over
    the records once, a filter on it takes one.
    """
    return health.select("*", pinned(branch()).alias("branch"))


def to_text(columns: tuple[str, ...], source: str | None = None) -> Column:
    """The named columns as one JSON object: null fields stay, times are ISO text in UTC."""
    fields = []
    for name in columns:
        value = F.col(f"{source}.{name}" if source else name)
        fields.append((iso_utc(value) if name in INSTANTS else value).alias(name))
    return F.to_json(F.struct(*fields), KEEP_NULLS)


def status_profile_messages(health: DataFrame, topics: TopicConfig = TopicConfig()) -> DataFrame:
    """Every health record to the status topic, critical ones to the alert topic as well."""
    text = to_text(STATUS_HEALTH)
    # The text is made once per record; both messages carry the same text.
    rows = health.select(*ORIGIN, is_alert().alias("_alert"), F.col("equipmentId").alias("_key"), text.alias("_text"))
    status = _message(topics.status, F.col("_key"), F.col("_text"))
    alert = _message(topics.status_profile_alert, F.col("_key"), F.col("_text"))
    return fan_out(rows, status, F.when(F.col("_alert"), alert))


def stream_profile_messages(health: DataFrame, topics: TopicConfig = TopicConfig()) -> DataFrame:
    """Every health record to the status topic, a typed alert for each one of the critical branch."""
    critical = branch() == "critical"
    status = _message(topics.status, F.col("key"), to_text(STREAM_HEALTH))
    alert = _message(topics.stream_profile_alert, F.col("key"), alert_text())
    return fan_out(health, status, F.when(critical, alert))


def alert_text() -> Column:
    """The alert record of a stream-profile health row as JSON."""
    values = rules_stream.alert_columns()
    fields = [(iso_utc(values[n]) if n in INSTANTS else values[n]).alias(n) for n in STREAM_ALERT]
    return F.to_json(F.struct(*fields), KEEP_NULLS)


def ingest_messages(
    validated: DataFrame, config: IngestConfig = IngestConfig(), *, as_of: Column | None = None,
    audit: tuple[Column, ...] = (),
) -> DataFrame:
    """Accepted bodies to the raw topic by equipment, rejected ones to the dead-letter topic.

    Every body is answered on the acknowledgement topic, by correlation id, and
    leaves the given ``audit`` records (null ones are skipped), by equipment.
    """
    raw = _message(
        config.topics.raw, F.col("record.equipmentId"), F.to_json(enrich.enriched_event(config, as_of), KEEP_NULLS)
    )
    letter = _message(
        config.topics.dead_letter, enrich.known_correlation_id(),
        F.to_json(enrich.dead_letter(config, as_of), KEEP_NULLS),
    )
    answer = enrich.acknowledgement(config, as_of)
    answer = answer.withField("ingestedAt", iso_utc(answer["ingestedAt"]))
    correlation = F.when(F.col("valid"), F.col("record.correlationId")).otherwise(enrich.known_correlation_id())
    ack = _message(config.topics.acknowledgement, correlation, F.to_json(answer, KEEP_NULLS))
    return fan_out(validated, F.when(F.col("valid"), raw).otherwise(letter), ack, *audit_messages(audit, config))


def audit_messages(records: tuple[Column, ...], config: IngestConfig = IngestConfig()) -> list[Column]:
    """Audit records as messages by equipment; one without an entry gives none."""
    return [F.when(entry["payload"].isNotNull(), _message(
        config.topics.audit, entry["equipmentId"], F.to_json(entry, KEEP_NULLS))) for entry in records]


def _message(topic: str, key: Column, value: Column) -> Column:
    return F.struct(F.lit(topic).alias("topic"), key.alias("key"), value.alias("value"))


def fan_out(rows: DataFrame, *messages: Column) -> DataFrame:
    """One pass, one output: a row per message, with the place of its source record.

    The ``topic`` column picks the topic in a Kafka write and the folder in a
    file write, so no second scan, no cache and no second sink is involved.
    """
    listed = rows.select(
        F.col("topic").alias("sourceTopic"), F.col("partition").alias("sourcePartition"),
        F.col("offset").alias("sourceOffset"), F.col("recordTimestamp"),
        F.inline(F.array(*messages)),
    )
    return listed.filter(F.col("topic").isNotNull()) if len(messages) > 1 else listed


def counted(parsed: DataFrame, observation: Observation | str = "intake") -> DataFrame:
    """Count records as they come in and those that will be dropped, before anything is dropped."""
    return parsed.observe(
        observation,
        F.count(F.lit(1)).alias("received"),
        F.count_if(~F.col("parsed")).alias("dropped"),
    )


def observed(health: DataFrame, observation: Observation | str = "routing") -> DataFrame:
    """Count what passes by, without another pass and without changing a row."""
    severity = F.col("severity")
    return health.observe(
        observation,
        F.count(F.lit(1)).alias("received"),
        F.count_if(severity == "CRITICAL").alias("critical"),
        F.count_if(severity == "WARNING").alias("warning"),
        F.count_if(severity == "HEALTHY").alias("healthy"),
    )
