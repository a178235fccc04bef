"""Telemetry records from JSON text, for both profiles, and the bridge from ingested events.

Numbers and times may come quoted, so leaves are read as text and cast with
``try_cast``; a leaf that cannot be read makes the whole record unusable.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import BridgeConfig
from pulsegrid.functions.scalar import is_blank, origin_id, quoted, texts
from pulsegrid.operators.validate import STRICT_JSON
from pulsegrid.schemas import ORIGIN, STATUS_TELEMETRY, STREAM_TELEMETRY

MICROS_PER = {"millis": 1_000, "seconds": 1_000_000}


def parse_status(topic: DataFrame, *, strict: bool = True, numeric_time: str = "millis") -> DataFrame:
    """Status-profile telemetry; with ``strict`` an unknown field makes a record unusable."""
    rows = _decode(topic, STATUS_TELEMETRY, with_keys=strict)
    checks = [_text_ok(name) for name in ("correlationId", "equipmentId", "equipmentType", "schemaVersion")]
    checks += _measurement_checks(numeric_time)
    checks.append("coalesce(schema_of_variant(metadata) RLIKE '^(OBJECT|VOID)', true)")
    if strict:
        checks.append(f"size(array_except(_keys, {texts(STATUS_TELEMETRY)})) = 0")
    return rows.selectExpr(
        *ORIGIN, "correlationId", "equipmentId", "equipmentType", f"{_instant(numeric_time)} AS timestamp",
        *_measurements(), "errorCodes", "metadata", "schemaVersion", f"{_all(checks)} AS parsed",
    )


def parse_stream(topic: DataFrame, *, numeric_time: str = "millis") -> DataFrame:
    """Stream-profile telemetry with its defaults; unknown fields do not matter."""
    rows = _decode(topic, STREAM_TELEMETRY)
    checks = [_text_ok(name) for name in ("eventId", "equipmentId", "correlationId")]
    checks += _measurement_checks(numeric_time)
    checks.append(f"({_is_empty('schemaVersion')} OR {_int_version()} IS NOT NULL)")
    return rows.selectExpr(
        *ORIGIN,
        f"coalesce(eventId, {origin_id('telemetry')}) AS eventId",
        "equipmentId", "correlationId",
        f"coalesce({_instant(numeric_time)}, recordTimestamp) AS timestamp",
        *_measurements(),
        f"coalesce(errorCodes, {texts([])}) AS errorCodes",
        f"coalesce({_int_version()}, 1) AS schemaVersion",
        f"{_all(checks)} AS parsed",
    )


def usable(parsed: DataFrame) -> DataFrame:
    """Drop what could not be read; the processors write no dead letters."""
    return parsed.filter("parsed").drop("parsed")


def with_defaults(telemetry: DataFrame) -> DataFrame:
    """Status-profile telemetry with absent codes, metadata and version filled in."""
    return telemetry.withColumns({
        "errorCodes": F.coalesce("errorCodes", F.array().cast("array<string>")),
        "metadata": F.coalesce("metadata", F.parse_json(F.lit("{}"))),
        "schemaVersion": F.coalesce("schemaVersion", F.lit("1.0.0")),
    })


def rekey(df: DataFrame) -> DataFrame:
    """Key by equipment. No shuffle: the key only matters where the rows are written."""
    return df.withColumn("key", F.col("equipmentId"))


def bridge(enriched: DataFrame, config: BridgeConfig = BridgeConfig()) -> DataFrame:
    """Measurements out of the payload map of enriched events, as telemetry of both profiles."""
    payload = F.col("payload")
    codes = payload[config.codes_key]
    measure = lambda key, factor: payload[key].try_cast("double") * F.lit(factor)
    empty = F.array().cast("array<string>")
    return enriched.select(
        *ORIGIN,
        F.expr(origin_id("telemetry")).alias("eventId"),
        "equipmentId", "correlationId",
        F.lit(None).cast("string").alias("equipmentType"),
        # A valid long may lie outside the range of timestamps; that gives null.
        F.timestamp_micros(F.try_multiply("timestamp", F.lit(1000).cast("long"))).alias("timestamp"),
        measure(config.temperature_key, config.temperature_factor).alias("temperature"),
        measure(config.pressure_key, config.pressure_factor).alias("pressure"),
        F.when(codes.rlike(r"\S"), F.transform(
            F.split(codes, re.escape(config.codes_separator)), lambda c: F.regexp_replace(c, r"^\s+|\s+$", ""),
        )).otherwise(empty).alias("errorCodes"),
        "schemaVersion",
    )


def _decode(topic: DataFrame, names: tuple[str, ...], *, with_keys: bool = False) -> DataFrame:
    types = {"errorCodes": "array<string>", "metadata": "variant"}
    layout = ", ".join(f"`{n}` {types.get(n, 'string')}" for n in names) + ", _corrupt string"
    origin = ["key", "topic", "partition", "offset", F.col("timestamp").alias("recordTimestamp"), "value"]
    keys = [F.json_object_keys("value").alias("_keys")] if with_keys else []
    # inline() keeps the decode in one place: a later filter on a decoded field would
    # otherwise be pushed below a projection and decode the text a second time.
    return topic.select(*origin, *keys, F.inline(F.array(F.from_json("value", layout, STRICT_JSON))))


def _all(checks: list[str]) -> str:
    # Blank text decodes to nothing and other text that is no object to _corrupt.
    return "coalesce(" + " AND ".join([f"NOT {is_blank('value')}", "_corrupt IS NULL", *checks]) + ", false)"


def _measurements() -> list[str]:
    return [f"try_cast({name} AS DOUBLE) AS {name}" for name in ("temperature", "pressure")]


def _measurement_checks(numeric_time: str) -> list[str]:
    numbers = [f"({_is_empty(n)} OR try_cast({n} AS DOUBLE) IS NOT NULL)" for n in ("temperature", "pressure")]
    return [f"({_is_empty('timestamp')} OR {_instant(numeric_time)} IS NOT NULL)", *numbers, _codes_ok()]


def _is_empty(name: str) -> str:
    return f"({name} IS NULL OR trim({name}) = '')"


def _instant(numeric_time: str) -> str:
    """ISO text, or an epoch number in the given unit (quoted or not)."""
    # The cast alone would take dates and local times as well; the marks of an instant are at
    # fixed places, which is cheaper to look at than a pattern. Out-of-range numbers give null.
    is_iso = """substring(timestamp, 11, 1) IN ('T', 't') AND substring(timestamp, 5, 1) = '-'
        AND substring(timestamp, 17, 1) = ':' AND (right(timestamp, 1) IN ('Z', 'z')
        OR substring(timestamp, -6, 1) IN ('+', '-') OR substring(timestamp, -5, 1) IN ('+', '-'))"""
    micros = f"try_cast(try_cast(timestamp AS DECIMAL(30,9)) * {MICROS_PER[numeric_time]} AS BIGINT)"
    return f"CASE WHEN {is_iso} THEN try_cast(timestamp AS TIMESTAMP) ELSE timestamp_micros({micros}) END"


def _int_version() -> str:
    """An int, a quoted int, or a number that is cut to an int."""
    # Only a version that is no plain int is looked at again: 1.0 will do, "1.0" will not.
    return f"""coalesce(try_cast(schemaVersion AS INT), CASE WHEN schemaVersion IS NOT NULL
        AND {_kind_of('schemaVersion')} RLIKE '^(BIGINT|DECIMAL|DOUBLE|FLOAT)'
        THEN try_cast(try_cast(schemaVersion AS DOUBLE) AS INT) END)"""


def _kind_of(name: str) -> str:
    return f"schema_of_variant(try_variant_get(try_parse_json(value), '$.{name}', 'variant'))"


def _text_ok(name: str) -> str:
    """A text leaf must hold a scalar; an object or array would arrive as its JSON text.

    Text may start with a bracket as well, so only then the type is looked up.
    """
    return f"""CASE WHEN startswith({name}, '{{') OR startswith({name}, '[')
        THEN NOT {_kind_of(name)} RLIKE '^(OBJECT|ARRAY)' ELSE true END"""


def _codes_ok() -> str:
    return """CASE WHEN array_join(errorCodes, ' ') RLIKE '[\\\\[{]' THEN NOT coalesce(
        exists(try_variant_get(try_parse_json(value), '$.errorCodes', 'array<variant>'),
          c -> schema_of_variant(c) RLIKE '^(OBJECT|ARRAY)'), false) ELSE true END"""
