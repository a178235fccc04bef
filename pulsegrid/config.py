"""Configuration of the health rules, the ingestion step and the topics.

Everything here is a frozen value object that the operators turn into
literals, so Catalyst folds thresholds into the generated code.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# The error codes both rule profiles know by default.
CRITICAL_CODES = ("E001", "E002", "E003", "E010", "E020")
STATUS_WARNING_CODES = ("W001", "W002", "W003")
STREAM_WARNING_CODES = ("W001", "W002", "W003", "W010")


@dataclass(frozen=True)
class HealthConfig:
    """Thresholds, code lists and weights of one rule profile."""

    # The default thresholds and weights.
    temperature_warning: float = 75.0
    temperature_critical: float = 90.0
    pressure_warning_low: float = 0.8
    pressure_warning_high: float = 1.2
    pressure_critical_low: float = 0.5
    pressure_critical_high: float = 1.5
    critical_codes: tuple[str, ...] = CRITICAL_CODES
    warning_codes: tuple[str, ...] = STATUS_WARNING_CODES
    temperature_weight: int = 30
    pressure_weight: int = 30
    error_weight: int = 40

    def __post_init__(self) -> None:
        if self.total_weight == 0:
            raise ValueError("the three weights must not add up to zero")

    @property
    def total_weight(self) -> int:
        return self.temperature_weight + self.pressure_weight + self.error_weight

    def with_(self, **changes) -> HealthConfig:
        return replace(self, **changes)


STATUS_PROFILE = HealthConfig()
STREAM_PROFILE = HealthConfig(warning_codes=STREAM_WARNING_CODES)


@dataclass(frozen=True)
class TopicConfig:
    """Names, key partitions and retention of the topics (or tables) in use."""

    raw: str = "telemetry.raw"
    dead_letter: str = "telemetry.dlq"
    status: str = "equipment.status"
    status_profile_alert: str = "equipment.critical-alert"
    stream_profile_alert: str = "alerts.critical"
    acknowledgement: str = "telemetry.acks"
    audit: str = "telemetry.audit"
    status_profile_partitions: int = 6
    stream_profile_partitions: int = 12
    raw_retention_days: int = 7
    alert_retention_days: int = 30


@dataclass(frozen=True)
class IngestConfig:
    """Settings of the validate / enrich / dead-letter step."""

    service_name: str = "telemetry-ingestion"  # fixed value: part of every published event
    default_schema: str = "RawTelemetryEvent"
    default_schema_version: str = "1.0.0"
    raw_subject: str = "telemetry.raw-value"
    # True: a nullable string must be null or {"string": "..."}; False: plain text is fine too.
    strict_union: bool = True
    topics: TopicConfig = TopicConfig()


@dataclass(frozen=True)
class BridgeConfig:
    """Which payload keys hold the measurements, and how to scale them."""

    temperature_key: str = "temperature"
    pressure_key: str = "pressure"
    codes_key: str = "errorCodes"
    temperature_factor: float = 1.0
    pressure_factor: float = 1.0
    codes_separator: str = ","
