"""Health scoring: a telemetry topic to status and alert messages, for both profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation

from pulsegrid.config import STATUS_PROFILE, STREAM_PROFILE, HealthConfig, TopicConfig
from pulsegrid.operators import parse, route, rules_status, rules_stream


def status_health(
    topic: DataFrame, config: HealthConfig = STATUS_PROFILE, *, strict: bool = True,
    processed_at: Column | None = None, intake: Observation | str | None = None,
) -> DataFrame:
    """Health records of the status profile, keyed by equipment; ``intake`` counts received and dropped records."""
    telemetry = parse.usable(_counted(parse.parse_status(topic, strict=strict), intake))
    return parse.rekey(rules_status.evaluate(telemetry, config, processed_at=processed_at))


def stream_health(
    topic: DataFrame, config: HealthConfig = STREAM_PROFILE, *, processed_at: Column | None = None,
    intake: Observation | str | None = None,
) -> DataFrame:
    """Health records of the stream profile under the key of their telemetry; ``intake`` as above."""
    telemetry = parse.usable(_counted(parse.parse_stream(topic), intake))
    return rules_stream.evaluate(telemetry, config, processed_at=processed_at)


def status_messages(
    topic: DataFrame, config: HealthConfig = STATUS_PROFILE, topics: TopicConfig = TopicConfig(),
    *, strict: bool = True, processed_at: Column | None = None, intake: Observation | str | None = None,
) -> DataFrame:
    health = status_health(topic, config, strict=strict, processed_at=processed_at, intake=intake)
    return route.status_profile_messages(health, topics)


def stream_messages(
    topic: DataFrame, config: HealthConfig = STREAM_PROFILE, topics: TopicConfig = TopicConfig(),
    *, processed_at: Column | None = None, intake: Observation | str | None = None,
) -> DataFrame:
    return route.stream_profile_messages(stream_health(topic, config, processed_at=processed_at, intake=intake), topics)


def _counted(parsed: DataFrame, intake: Observation | str | None) -> DataFrame:
    return route.counted(parsed, intake) if intake else parsed
