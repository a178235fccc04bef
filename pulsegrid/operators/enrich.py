"""What becomes of a validated body: an enriched event, a dead letter, an acknowledgement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import IngestConfig
from pulsegrid.functions.scalar import is_blank, iso_utc, origin_id
from pulsegrid.schemas import DEAD_LETTER, FAILURE_CODES, ORIGIN, RAW_EVENT

DEAD_LETTER_VERSION = "1.0.0"
FAILURE_CODE = "SCHEMA_VALIDATION"


def _now(as_of: Column | None) -> Column:
    return F.current_timestamp() if as_of is None else as_of


def enriched_event(config: IngestConfig = IngestConfig(), as_of: Column | None = None) -> Column:
    """The published event of an accepted row: its eight fields plus ingestion metadata."""
    record = F.col("record")
    optional = lambda name: F.nullif(record[name], F.lit("null")).alias(name)
    return F.struct(
        record["equipmentId"].alias("equipmentId"),
        record["timestamp"].alias("timestamp"),
        record["payload"].alias("payload"),
        record["correlationId"].alias("correlationId"),
        record["schemaVersion"].alias("schemaVersion"),
        F.coalesce(record["sourceSystem"], F.lit("unknown")).alias("sourceSystem"),
        optional("metricName"),
        optional("unit"),
        F.struct(
            iso_utc(_now(as_of)).alias("ingestedAt"),
            F.lit(config.service_name).alias("ingestionService"),
            F.expr(origin_id("ingest")).alias("ingestionId"),
            F.lit(True).alias("validated"),
        ).alias("ingestionMetadata"),
    )


def enrich(
    validated: DataFrame, config: IngestConfig = IngestConfig(), *, as_of: Column | None = None,
) -> DataFrame:
    """Accepted rows as enriched events."""
    return validated.filter("valid").select(
        *ORIGIN,
        enriched_event(config, as_of).alias("event"),
    ).select(*ORIGIN, "event.*")


def known_correlation_id() -> Column:
    return F.expr(f"CASE WHEN {is_blank('claimedCorrelationId')} THEN 'UNKNOWN' ELSE claimedCorrelationId END")


def dead_letter(
    config: IngestConfig = IngestConfig(), as_of: Column | None = None, attempt: Column | None = None,
) -> Column:
    """The dead letter of a rejected row, with the original text whole."""
    return F.struct(
        F.col("claimedEquipmentId").alias("equipmentId"),
        F.unix_millis(_now(as_of)).alias("timestamp"),
        known_correlation_id().alias("correlationId"),
        F.lit(DEAD_LETTER_VERSION).alias("schemaVersion"),
        F.struct(
            F.lit(config.topics.raw).alias("originalTopic"),
            F.col("schemaName").alias("originalSchema"),
            F.col("reportedVersion").alias("originalSchemaVersion"),
            F.array_join("errors", "; ").alias("failureReason"),
            F.lit(FAILURE_CODE).alias("failureCode"),
            F.coalesce(F.col("value"), F.lit("")).alias("originalPayload"),
            (F.lit(1) if attempt is None else attempt).alias("attemptCount"),
        ).alias("payload"),
        F.struct(
            F.lit(config.service_name).alias("source"),
            F.col("errors"),
            iso_utc(_now(as_of)).alias("deadLetteredAt"),
        ).alias("errorMetadata"),
    )


def dead_letters(
    validated: DataFrame, config: IngestConfig = IngestConfig(), *,
    as_of: Column | None = None, attempt: Column | None = None,
) -> DataFrame:
    """Rejected rows as dead letters."""
    return validated.filter(~F.col("valid")).select(
        *ORIGIN,
        dead_letter(config, as_of, attempt).alias("letter"),
    ).select(*ORIGIN, "letter.*")


def acknowledgement(config: IngestConfig = IngestConfig(), as_of: Column | None = None) -> Column:
    """The answer to a body: ACCEPTED with topic, schema and time, or REJECTED with the errors."""
    accepted = F.col("valid")
    return F.struct(
        F.when(accepted, F.lit("ACCEPTED")).otherwise(F.lit("REJECTED")).alias("status"),
        F.when(accepted, F.col("record.correlationId"))
        .otherwise(F.col("claimedCorrelationId")).alias("correlationId"),
        F.when(accepted, F.lit(config.topics.raw)).alias("topic"),
        F.when(accepted, F.col("schemaName")).alias("schemaName"),
        F.when(accepted, F.col("reportedVersion")).alias("schemaVersion"),
        _now(as_of).alias("ingestedAt"),
        F.col("errors"),
    )


def acknowledgements(
    validated: DataFrame, config: IngestConfig = IngestConfig(), *, as_of: Column | None = None,
) -> DataFrame:
    """One answer per body."""
    return validated.select(*ORIGIN, acknowledgement(config, as_of).alias("ack"))


def raw_contract(event: Column) -> Column:
    """An enriched event cut to the fields of the raw contract, in contract order."""
    return F.struct(*[event[f.name].cast(f.dataType).alias(f.name) for f in RAW_EVENT.fields])


def dead_letter_contract(letter: Column) -> Column:
    """A dead letter cut to the fields of its contract; unknown failure codes become UNKNOWN."""
    code = letter["payload"]["failureCode"]
    in_domain = F.when(code.isin(*FAILURE_CODES), code).otherwise(F.lit("UNKNOWN"))
    fields = {f.name: letter[f.name] for f in DEAD_LETTER.fields if f.name != "errorMetadata"}
    fields["payload"] = letter["payload"].withField("failureCode", in_domain)
    return F.struct(*[value.alias(name) for name, value in fields.items()])
