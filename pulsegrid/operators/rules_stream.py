"""Health rules of the stream profile: a status and a score per dimension, and typed alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import STREAM_PROFILE, HealthConfig
from pulsegrid.functions.scalar import (
    contains_any, count_of, double, fixed, keep_only, list_text, origin_id, quotient, texts, truncated,
)
from pulsegrid.schemas import ORIGIN

SCHEMA_VERSION = 1
ALERT_CONTRACT_VERSION = "1.0.0"
STATUSES = ("temperatureStatus", "pressureStatus", "errorStatus")


def temperature_status(config: HealthConfig = STREAM_PROFILE, t: str = "temperature") -> str:
    return f"""CASE WHEN {t} IS NULL THEN 'UNKNOWN' WHEN isnan({t}) THEN 'NORMAL'
        WHEN {t} >= {double(config.temperature_critical)} THEN 'CRITICAL'
        WHEN {t} >= {double(config.temperature_warning)} THEN 'WARNING' ELSE 'NORMAL' END"""


def temperature_score(config: HealthConfig = STREAM_PROFILE, t: str = "temperature") -> str:
    """100 outside the bands; 100 falling to 0 inside the warning band; 0 when critical."""
    warning, critical = config.temperature_warning, config.temperature_critical
    return f"""CASE WHEN isnan({t}) THEN 100
        WHEN {t} >= {double(critical)} THEN 0
        {_band(f"{t} >= {double(warning)}", f"{t} - {double(warning)}", critical - warning)}
        ELSE 100 END"""


def pressure_status(config: HealthConfig = STREAM_PROFILE, p: str = "pressure") -> str:
    c = config
    return f"""CASE WHEN {p} IS NULL THEN 'UNKNOWN' WHEN isnan({p}) THEN 'NORMAL'
        WHEN {p} <= {double(c.pressure_critical_low)} OR {p} >= {double(c.pressure_critical_high)} THEN 'CRITICAL'
        WHEN {p} <= {double(c.pressure_warning_low)} OR {p} >= {double(c.pressure_warning_high)} THEN 'WARNING'
        ELSE 'NORMAL' END"""


def pressure_score(config: HealthConfig = STREAM_PROFILE, p: str = "pressure") -> str:
    low, high = config.pressure_warning_low, config.pressure_warning_high
    bottom, top = config.pressure_critical_low, config.pressure_critical_high
    return f"""CASE WHEN isnan({p}) THEN 100
        WHEN {p} <= {double(bottom)} OR {p} >= {double(top)} THEN 0
        {_band(f"{p} <= {double(low)}", f"{double(low)} - {p}", low - bottom)}
        {_band(f"{p} >= {double(high)}", f"{p} - {double(high)}", top - high)}
        ELSE 100 END"""


def _band(condition: str, distance: str, width: float) -> str:
    """The branch for a warning band. One without width cannot be reached and is left out."""
    if width <= 0:
        return ""
    score = truncated(f"100D - (({distance}) / {double(width)}) * 100D")
    return f"WHEN {condition} THEN greatest(0, {score})"


def error_status(config: HealthConfig = STREAM_PROFILE, codes: str = "errorCodes") -> str:
    return f"""CASE WHEN {contains_any(codes, config.critical_codes)} THEN 'CRITICAL'
        WHEN {contains_any(codes, config.warning_codes)} THEN 'WARNING' ELSE 'NONE' END"""


def error_score(config: HealthConfig = STREAM_PROFILE, codes: str = "errorCodes") -> str:
    """0 with a critical code, else 25 points less per warning code, down to 0."""
    warnings = count_of(codes, config.warning_codes)
    return f"""CASE WHEN {contains_any(codes, config.critical_codes)} THEN 0
        WHEN {warnings} > 0 THEN greatest(0, 100 - 25 * ({warnings}))
        ELSE 100 END"""


def matched_codes(config: HealthConfig = STREAM_PROFILE, codes: str = "errorCodes") -> str:
    """The critical matches if there are any, else the warning matches, else nothing."""
    return f"""CASE
        WHEN {contains_any(codes, config.critical_codes)} THEN {keep_only(codes, config.critical_codes)}
        WHEN {contains_any(codes, config.warning_codes)} THEN {keep_only(codes, config.warning_codes)}
        ELSE {texts([])} END"""


def health_score(
    config: HealthConfig = STREAM_PROFILE, t: str = "temperatureScore", p: str = "pressureScore",
    e: str = "errorCodeScore",
) -> str:
    """Every weighted part is divided by 100 and cut by itself; the sum stays within 0 to 100."""
    parts = [
        quotient(f"{t} * {config.temperature_weight}", 100),
        quotient(f"{p} * {config.pressure_weight}", 100),
        quotient(f"{e} * {config.error_weight}", 100),
    ]
    return f"greatest(0, least(100, {' + '.join(parts)}))"


def severity(score: str = "healthScore", statuses: tuple[str, ...] = STATUSES) -> str:
    """From the three statuses and the score."""
    listed = ", ".join(statuses)
    return f"""CASE
        WHEN 'CRITICAL' IN ({listed}) OR {_how_many('WARNING', statuses)} >= 2 OR {score} < 40 THEN 'CRITICAL'
        WHEN 'WARNING' IN ({listed}) THEN 'WARNING' ELSE 'HEALTHY' END"""


def _how_many(status: str, statuses: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"CAST({s} = '{status}' AS INT)" for s in statuses) + ")"


def score(df: DataFrame, config: HealthConfig = STREAM_PROFILE) -> DataFrame:
    """Telemetry columns plus statuses, scores, severity and the critical flag; no shuffle."""
    return (
        df.withColumns({
            "temperatureStatus": F.expr(temperature_status(config)),
            "pressureStatus": F.expr(pressure_status(config)),
            "errorStatus": F.expr(error_status(config)),
            "temperatureScore": F.expr(temperature_score(config)),
            "pressureScore": F.expr(pressure_score(config)),
            "errorCodeScore": F.expr(error_score(config)),
        })
        .withColumn("healthScore", F.expr(health_score(config)))
        .withColumn("severity", F.expr(severity()))
        .withColumn("isCritical", F.expr("severity = 'CRITICAL'"))
    )


def evaluate(
    df: DataFrame, config: HealthConfig = STREAM_PROFILE, *, processed_at: Column | None = None,
) -> DataFrame:
    """Health columns of the stream profile beside the measured values the alerts need."""
    return score(df, config).select(
        *ORIGIN,
        F.expr(origin_id("health")).alias("eventId"),
        "equipmentId", "correlationId",
        (F.current_timestamp() if processed_at is None else processed_at).alias("timestamp"),
        "healthScore", "isCritical", "severity", *STATUSES,
        F.col("eventId").alias("sourceEventId"),
        F.lit(SCHEMA_VERSION).alias("schemaVersion"),
        "temperature", "pressure", "errorCodes",
    )


def alert_type(statuses: tuple[str, ...] = STATUSES) -> str:
    """Which dimension is critical; several, or none (two warnings), make a combined alert."""
    temperature, pressure, error = statuses
    return f"""CASE WHEN {_how_many('CRITICAL', statuses)} > 1 THEN 'COMBINED_CRITICAL'
        WHEN {temperature} = 'CRITICAL' THEN 'TEMPERATURE_CRITICAL'
        WHEN {pressure} = 'CRITICAL' THEN 'PRESSURE_CRITICAL'
        WHEN {error} = 'CRITICAL' THEN 'ERROR_CODE_CRITICAL'
        ELSE 'COMBINED_CRITICAL' END"""


def alert_message() -> str:
    """The alert text of a health row; names only the critical dimensions, lists all codes."""
    # The message texts.
    return f"""concat(
        'Equipment ', coalesce(equipmentId, 'null'), ' in CRITICAL state. Health score: ', healthScore,
        CASE WHEN temperatureStatus = 'CRITICAL' AND temperature IS NOT NULL
          THEN concat('. Temperature: ', {fixed('temperature', 1)}, '°C') ELSE '' END,
        CASE WHEN pressureStatus = 'CRITICAL' AND pressure IS NOT NULL
          THEN concat('. Pressure: ', {fixed('pressure', 2)}, ' bar') ELSE '' END,
        CASE WHEN errorStatus = 'CRITICAL' AND errorCodes IS NOT NULL
          THEN concat('. Error codes: ', {list_text('errorCodes')}) ELSE '' END)"""


def alert_columns() -> dict[str, Column]:
    """The fields of an alert record, from the columns of a health row."""
    return {
        "alertId": F.expr(origin_id("alert")),
        "equipmentId": F.col("equipmentId"),
        "correlationId": F.col("correlationId"),
        "timestamp": F.col("timestamp"),
        "alertType": F.expr(alert_type()),
        "healthScore": F.col("healthScore"),
        "message": F.expr(alert_message()),
        "temperatureValue": F.col("temperature"),
        "pressureValue": F.col("pressure"),
        "errorCodes": F.col("errorCodes"),
        "sourceEventId": F.col("sourceEventId"),
        "schemaVersion": F.lit(SCHEMA_VERSION),
    }


def alert_contract(alerts: DataFrame, config: HealthConfig = STREAM_PROFILE) -> DataFrame:
    """Alert records in the layout of the alert contract; nobody has acknowledged them yet."""
    one = {
        "TEMPERATURE_CRITICAL": (f"'{config.temperature_critical}'", "CAST(temperatureValue AS STRING)"),
        "PRESSURE_CRITICAL": (f"'{config.pressure_critical_low} to {config.pressure_critical_high}'", "CAST(pressureValue AS STRING)"),
        "ERROR_CODE_CRITICAL": ("CAST(NULL AS STRING)", "array_join(errorCodes, ',')"),
    }
    of = lambda i: "CASE alertType " + " ".join(f"WHEN '{k}' THEN {v[i]}" for k, v in one.items()) + " END"
    return alerts.select(
        *ORIGIN,
        "equipmentId",
        F.unix_millis("timestamp").alias("timestamp"),
        F.struct(
            "alertId",
            F.lit("CRITICAL").alias("severity"),
            F.concat(F.lit("Critical equipment state: "), F.lower(F.regexp_replace("alertType", "_CRITICAL$", ""))).alias("title"),
            F.col("message").alias("description"),
            F.expr(of(0)).alias("threshold"),
            F.expr(of(1)).alias("observedValue"),
            F.create_map(
                F.lit("alertType"), F.col("alertType"), F.lit("healthScore"), F.col("healthScore").cast("string"),
                F.lit("sourceEventId"), F.coalesce("sourceEventId", F.lit("")),
            ).alias("attributes"),
        ).alias("payload"),
        "correlationId",
        F.lit(ALERT_CONTRACT_VERSION).alias("schemaVersion"),
        F.lit(False).alias("acknowledged"),
    )


def alerts(health: DataFrame) -> DataFrame:
    """Alert records for health rows that are already filtered to the critical branch."""
    return health.select(*ORIGIN, *[value.alias(name) for name, value in alert_columns().items()])
