"""Column layouts: the topic envelope, the event shapes and the versioned contracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from pulsegrid.contracts import Node, read_contract

ENVELOPE = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

# The columns that say where a record came from; every operator keeps them.
ORIGIN = ("key", "topic", "partition", "offset", "recordTimestamp")

# Field names and their order in the records and contracts, here and below.
STATUS_TELEMETRY = (
    "correlationId", "equipmentId", "equipmentType", "timestamp", "temperature",
    "pressure", "errorCodes", "metadata", "schemaVersion",
)
STREAM_TELEMETRY = (
    "eventId", "equipmentId", "correlationId", "timestamp", "temperature",
    "pressure", "errorCodes", "schemaVersion",
)

STATUS_HEALTH = (
    "correlationId", "equipmentId", "equipmentType", "telemetryTimestamp", "processedAt",
    "healthScore", "isCritical", "severity", "breakdown", "schemaVersion",
)
STREAM_HEALTH = (
    "eventId", "equipmentId", "correlationId", "timestamp", "healthScore", "isCritical",
    "severity", "temperatureStatus", "pressureStatus", "errorStatus", "sourceEventId",
    "schemaVersion",
)
STREAM_ALERT = (
    "alertId", "equipmentId", "correlationId", "timestamp", "alertType", "healthScore",
    "message", "temperatureValue", "pressureValue", "errorCodes", "sourceEventId",
    "schemaVersion",
)

# The domains of the enumerated contract fields.
AUDIT_ACTIONS = (
    "INGEST", "VALIDATE", "TRANSFORM", "EMIT_STATUS", "EMIT_ALERT", "DEAD_LETTER",
    "REPLAY", "SCHEMA_REGISTER", "ACKNOWLEDGE",
)
AUDIT_OUTCOMES = ("SUCCESS", "FAILURE", "SKIPPED")
FAILURE_CODES = ("SCHEMA_VALIDATION", "DESERIALIZATION", "PROCESSING_ERROR", "TIMEOUT", "UNKNOWN")

DEAD_LETTER_PAYLOAD = T.StructType([
    T.StructField("originalTopic", T.StringType()),
    T.StructField("originalSchema", T.StringType()),
    T.StructField("originalSchemaVersion", T.StringType()),
    T.StructField("failureReason", T.StringType()),
    T.StructField("failureCode", T.StringType()),
    T.StructField("originalPayload", T.StringType()),
    T.StructField("attemptCount", T.IntegerType()),
])
DEAD_LETTER = T.StructType([
    T.StructField("equipmentId", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("correlationId", T.StringType()),
    T.StructField("schemaVersion", T.StringType()),
    T.StructField("payload", DEAD_LETTER_PAYLOAD),
    T.StructField("errorMetadata", T.StructType([
        T.StructField("source", T.StringType()),
        T.StructField("errors", T.ArrayType(T.StringType())),
        T.StructField("deadLetteredAt", T.StringType()),
    ])),
])
RAW_EVENT = T.StructType([
    T.StructField("equipmentId", T.StringType()),
    T.StructField("timestamp", T.LongType()),
    T.StructField("payload", T.MapType(T.StringType(), T.StringType())),
    T.StructField("correlationId", T.StringType()),
    T.StructField("schemaVersion", T.StringType()),
    T.StructField("sourceSystem", T.StringType()),
    T.StructField("metricName", T.StringType()),
    T.StructField("unit", T.StringType()),
])
ENRICHED = T.StructType([
    *RAW_EVENT.fields,
    T.StructField("ingestionMetadata", T.StructType([
        T.StructField("ingestedAt", T.StringType()),
        T.StructField("ingestionService", T.StringType()),
        T.StructField("ingestionId", T.StringType()),
        T.StructField("validated", T.BooleanType()),
    ])),
])


@dataclass(frozen=True)
class Contract:
    """A versioned record contract: field names with their kinds, in order.

    Kinds that telemetry contracts use are texts (``string``, ``long``, ``map<string>`` and ``optional
    string``) and have checks of their own; any other type is a tree, whose check is compiled.
    """

    name: str
    fields: tuple[tuple[str, str | Node], ...]

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.fields)

    @staticmethod
    def from_avro_json(text: str) -> Contract:
        """Read an Avro record schema; raises ``UnreadableContract`` if it is none."""
        tree = read_contract(text)
        return Contract(tree.name.rsplit(".", 1)[-1], tuple((name, _kind(node)) for name, node in tree.fields))


def _kind(node: Node) -> str | Node:
    if node.kind in ("string", "long"):
        return node.kind
    return node.text if node.text in ("map<string>", "optional string") else node


# The bundled contract.
RAW_CONTRACT = Contract("RawTelemetryEvent", (
    ("equipmentId", "string"),
    ("timestamp", "long"),
    ("payload", "map<string>"),
    ("correlationId", "string"),
    ("schemaVersion", "string"),
    ("sourceSystem", "string"),
    ("metricName", "optional string"),
    ("unit", "optional string"),
))
