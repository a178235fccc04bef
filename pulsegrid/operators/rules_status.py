"""Health rules of the status profile: three scores, one weighted score, a severity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import STATUS_PROFILE, HealthConfig
from pulsegrid.functions.scalar import (
    contains_any, count_of, double, fixed, keep_only, quoted, quotient, texts, truncated,
)
from pulsegrid.schemas import ORIGIN

SCHEMA_VERSION = "1.0.0"


def temperature_score(config: HealthConfig = STATUS_PROFILE, t: str = "temperature") -> str:
    """100 when unknown or fine, 0 from the critical threshold on, 50 falling to 0 in between."""
    warning, critical = config.temperature_warning, config.temperature_critical
    return f"""CASE WHEN isnan({t}) THEN 100
        WHEN {t} >= {double(critical)} THEN 0
        {_band(f"{t} >= {double(warning)}", f"{t} - {double(warning)}", critical - warning)}
        ELSE 100 END"""


def pressure_score(config: HealthConfig = STATUS_PROFILE, p: str = "pressure") -> str:
    """As the temperature score, with a band on either side; the low side is looked at first."""
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
    score = truncated(f"50D * (1D - ({distance}) / {double(width)})")
    return f"WHEN {condition} THEN {score}"


def error_score(config: HealthConfig = STATUS_PROFILE, codes: str = "errorCodes") -> str:
    """0 with a critical code, else 15 points less per warning code but never under 30."""
    warnings = count_of(codes, _only_warning(config))
    return f"""CASE WHEN {contains_any(codes, config.critical_codes)} THEN 0
        WHEN {warnings} > 0 THEN greatest(30, 100 - 15 * ({warnings}))
        ELSE 100 END"""


def _only_warning(config: HealthConfig) -> tuple[str, ...]:
    return tuple(c for c in config.warning_codes if c not in config.critical_codes)


def health_score(
    config: HealthConfig = STATUS_PROFILE, t: str = "temperatureScore", p: str = "pressureScore",
    e: str = "errorCodeScore",
) -> str:
    """The weighted mean of the three scores, divided once and cut to an int."""
    weighted = f"{t} * {config.temperature_weight} + {p} * {config.pressure_weight} + {e} * {config.error_weight}"
    return quotient(weighted, config.total_weight)


def is_critical(
    config: HealthConfig = STATUS_PROFILE, t: str = "temperatureScore", p: str = "pressureScore",
    e: str = "errorCodeScore", codes: str = "errorCodes",
) -> str:
    return f"({t} = 0 OR {p} = 0 OR {e} = 0 OR {contains_any(codes, config.critical_codes)})"


def severity(score: str = "healthScore", critical: str = "isCritical") -> str:
    return f"""CASE WHEN {critical} OR {score} < 30 THEN 'CRITICAL'
        WHEN {score} < 70 THEN 'WARNING' ELSE 'HEALTHY' END"""


def violations(
    config: HealthConfig = STATUS_PROFILE, t: str = "temperature", p: str = "pressure", codes: str = "errorCodes",
) -> str:
    """The texts of what went wrong: temperature, pressure, then codes in their own order."""
    # The message texts.
    c = config
    known = (*c.critical_codes, *_only_warning(c))
    label = f"CASE WHEN {contains_any('array(e)', c.critical_codes)} THEN 'CRITICAL' ELSE 'WARNING' END"
    return f"""concat(
        CASE WHEN isnan({t}) THEN {texts([])}
          {_violation(f"{t} >=", c.temperature_critical, "CRITICAL: Temperature {}°C exceeds critical threshold {}°C", t)}
          {_violation(f"{t} >=", c.temperature_warning, "WARNING: Temperature {}°C exceeds warning threshold {}°C", t)}
          ELSE {texts([])} END,
        CASE WHEN isnan({p}) THEN {texts([])}
          {_violation(f"{p} <=", c.pressure_critical_low, "CRITICAL: Pressure {} below critical low threshold {}", p)}
          {_violation(f"{p} >=", c.pressure_critical_high, "CRITICAL: Pressure {} exceeds critical high threshold {}", p)}
          {_violation(f"{p} <=", c.pressure_warning_low, "WARNING: Pressure {} below warning low threshold {}", p)}
          {_violation(f"{p} >=", c.pressure_warning_high, "WARNING: Pressure {} exceeds warning high threshold {}", p)}
          ELSE {texts([])} END,
        CASE WHEN {contains_any(codes, known)}
          THEN transform({keep_only(codes, known)}, e -> concat({label}, ': Error code ', e, ' detected'))
          ELSE {texts([])} END)"""


def _violation(comparison: str, threshold: float, template: str, value: str) -> str:
    """A branch with its message; value and threshold are shown with two decimals."""
    before, between, after = (quoted(part) for part in template.split("{}"))
    message = f"concat({before}, {fixed(value, 2)}, {between}, {fixed(double(threshold), 2)}, {after})"
    return f"WHEN {comparison} {double(threshold)} THEN array({message})"


def score(df: DataFrame, config: HealthConfig = STATUS_PROFILE) -> DataFrame:
    """Telemetry columns plus scores, criticality, severity and violations; no shuffle."""
    return (
        df.withColumns({
            "temperatureScore": F.expr(temperature_score(config)),
            "pressureScore": F.expr(pressure_score(config)),
            "errorCodeScore": F.expr(error_score(config)),
        })
        .withColumns({"healthScore": F.expr(health_score(config)), "isCritical": F.expr(is_critical(config))})
        .withColumns({"severity": F.expr(severity()), "violations": F.expr(violations(config))})
    )


def evaluate(
    df: DataFrame, config: HealthConfig = STATUS_PROFILE, *, processed_at: Column | None = None,
) -> DataFrame:
    """Health records of the status profile next to the origin columns of their telemetry."""
    return score(df, config).select(
        *ORIGIN,
        "correlationId", "equipmentId", "equipmentType",
        F.col("timestamp").alias("telemetryTimestamp"),
        (F.current_timestamp() if processed_at is None else processed_at).alias("processedAt"),
        "healthScore", "isCritical", "severity",
        F.struct("temperatureScore", "pressureScore", "errorCodeScore", "violations").alias("breakdown"),
        F.lit(SCHEMA_VERSION).alias("schemaVersion"),
    )
