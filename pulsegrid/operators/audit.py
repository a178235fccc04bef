"""Audit rows for what happened to each record, in the layout of the audit contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import IngestConfig, TopicConfig
from pulsegrid.operators.enrich import known_correlation_id
from pulsegrid.operators.route import is_alert
from pulsegrid.schemas import AUDIT_ACTIONS, AUDIT_OUTCOMES

AUDIT_VERSION = "1.0.0"


def _entry(action: str, actor: str, outcome: Column | str, resource: str, details: Column) -> Column:
    if action not in AUDIT_ACTIONS or isinstance(outcome, str) and outcome not in AUDIT_OUTCOMES:
        raise ValueError(f"not in the audit contract: {action}, {outcome}")
    return F.struct(
        F.lit(action).alias("action"),
        F.lit(actor).alias("actor"),
        (F.lit(outcome) if isinstance(outcome, str) else outcome).alias("outcome"),
        F.lit(resource).alias("resource"),
        details.alias("details"),
    )


def _records(equipment: Column, correlation: Column, time: Column, *entries: Column) -> tuple[Column, ...]:
    """Audit records with the given entries as payload; where an entry is null, the record has none."""
    return tuple(F.struct(
        F.coalesce(equipment, F.lit("UNKNOWN")).alias("equipmentId"),
        F.unix_millis(time).alias("timestamp"),
        entry.alias("payload"),
        F.coalesce(correlation, F.lit("UNKNOWN")).alias("correlationId"),
        F.lit(AUDIT_VERSION).alias("schemaVersion"),
    ) for entry in entries)


def _rows(df: DataFrame, records: tuple[Column, ...]) -> DataFrame:
    """One pass over the rows; each gives as many audit rows as it has records."""
    return df.select(F.inline(F.array(*records))).filter(F.col("payload").isNotNull())


def ingest_audit(
    validated: DataFrame, config: IngestConfig = IngestConfig(), *, as_of: Column | None = None,
) -> DataFrame:
    return _rows(validated, ingest_records(config, as_of=as_of))


def ingest_records(config: IngestConfig = IngestConfig(), *, as_of: Column | None = None) -> tuple[Column, ...]:
    """VALIDATE for every body, DEAD_LETTER for the rejected ones; over validation results."""
    valid, actor = F.col("valid"), config.service_name
    equipment = F.when(valid, F.col("record.equipmentId")).otherwise(F.col("claimedEquipmentId"))
    correlation = F.when(valid, F.col("record.correlationId")).otherwise(known_correlation_id())
    outcome = F.when(valid, F.lit("SUCCESS")).otherwise(F.lit("FAILURE"))
    details = F.create_map(F.lit("errorCount"), F.size("errors").cast("string"))
    return _records(
        equipment, correlation, F.current_timestamp() if as_of is None else as_of,
        _entry("VALIDATE", actor, outcome, config.raw_subject, details),
        F.when(~valid, _entry("DEAD_LETTER", actor, "SUCCESS", config.topics.dead_letter, details)),
    )


def contract_records(
    problem: str, version: int | None, config: IngestConfig = IngestConfig(), *, as_of: Column | None = None,
) -> tuple[Column, ...]:
    """SCHEMA_REGISTER with FAILURE: the newest registered contract cannot be read, the bundled one is in force."""
    details = F.create_map(F.lit("problem"), F.lit(problem), F.lit("version"), F.lit(str(version)))
    return _records(
        F.lit("SYSTEM"), F.lit(None).cast("string"), F.current_timestamp() if as_of is None else as_of,
        _entry("SCHEMA_REGISTER", config.service_name, "FAILURE", config.raw_subject, details))


def health_audit(
    health: DataFrame, actor: str, topics: TopicConfig = TopicConfig(), *,
    alert_topic: str | None = None, as_of: Column | None = None,
) -> DataFrame:
    """EMIT_STATUS for every health record, EMIT_ALERT for the critical ones."""
    details = F.create_map(F.lit("severity"), F.col("severity"))
    return _rows(health, _records(
        F.col("equipmentId"), F.col("correlationId"),
        F.current_timestamp() if as_of is None else as_of,
        _entry("EMIT_STATUS", actor, "SUCCESS", topics.status, details),
        F.when(is_alert(), _entry(
            "EMIT_ALERT", actor, "SUCCESS", alert_topic or topics.status_profile_alert, details)),
    ))
